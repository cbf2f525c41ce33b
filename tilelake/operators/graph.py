"""Connected components of edge tables, and tables kept in the shared folder between rounds."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SMALL = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; where it is unset and all runs in this
    process, one of this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tilelake-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Writes df once as Parquet in the shared folder and reads it back, which cuts lineage and survives lost executors."""
    path = f"{_own_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stored-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    with contextlib.suppress(Exception):
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dropped(df: DataFrame) -> None:
    """Deletes the files of a ``stored`` table that nothing reads any more."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, name)


def clear(spark: SparkSession) -> None:
    """Deletes all stored tables of this application; to be called when no result that reads them is needed any more."""
    _delete(spark, _own_dir(spark))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table by alternating large-star and small-star steps.

    Returns (node, label), label the smallest node of the component, for nodes that have an edge. Every step is a
    grouped minimum and a join of rows, none gathers a component, and each round is kept in the shared folder. Nodes with
    more than a thousandth of the edges, of which there are 2,000 at most, join by broadcast, so that no task gets all
    neighbours of one (in graphs of over ``SMALL`` edges; in smaller ones a task holds all of them with ease).
    """
    e = stored(edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u <> v").distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        many = mark[0] // 1000 if mark[0] > SMALL else None
        both = e.union(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = _with_least(both.where("v > u"), least, many).select(F.col("m").alias("v"), F.col("v").alias("u")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        joined = _with_least(large, least, many)
        small = joined.select(F.col("m").alias("v"), F.col("v").alias("u")).union(joined.select(F.col("m").alias("v"), "u")).where("u <> v").distinct()
        new = stored(small, "edges")
        dropped(e)
        e, last, mark = new, mark, _mark(new)
        if mark == last:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first())


def _with_least(rows: DataFrame, least: DataFrame, many: int | None) -> DataFrame:
    """rows (v, u) with m of their u; least: (u, m, n), n the number of rows of u."""
    if many is None:
        return rows.join(least.select("u", "m"), "u").select("v", "u", "m")
    hot = F.broadcast(least.where(F.col("n") > many).select(F.col("u").alias("hu"), F.col("m").alias("hm")))
    met = rows.join(hot, F.col("u") == F.col("hu"), "left")
    cold = met.where("hu is null").select("v", "u").join(least.where(F.col("n") <= many).select("u", "m"), "u").select("v", "u", "m")
    return cold.union(met.where("hu is not null").select("v", "u", F.col("hm").alias("m")))


def by_component(parted: DataFrame, f, schema: str, rows: int = 4_000, keys: tuple[str, ...] = ("_part",), carry: tuple[str, ...] = ()) -> DataFrame:
    """Applies f, from pandas frame to pandas frame, to each component (_part, or equal keys) of a stored or cheap table.

    Components are dealt by a hash into groups of about ``rows`` rows, since a Spark group for each of millions of small
    components would cost more than f. Columns to carry are the same in all rows of a component and put beside f's.
    """
    import pandas as pd

    names = [f.name for f in T._parse_datatype_string(schema).fields]
    groups = max(1, -(-parted.count() // rows))

    def run(t: pd.DataFrame) -> pd.DataFrame:
        out = [f(x).assign(**{c: x[c].iloc[0] for c in carry}) for _, x in t.groupby(list(keys), sort=False, dropna=False)]
        return pd.concat(out, ignore_index=True)[names] if out else pd.DataFrame(columns=names)

    # by number, since partitions small in bytes would be put together, though f is slow
    dealt = parted.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(groups)))
    return dealt.repartition(min(groups, 100_000), "_group").groupBy("_group").applyInPandas(run, schema)
