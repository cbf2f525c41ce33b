"""A Merkle manifest of a dataset: leaves of rows, trees of eight of each group, one root, and a proof for every row.

A leaf is the hash of a row's fields. Leaves are ranked within their group by a range sort whose last key is the place
of the row, so that copies of one row are split like any others; ranks come from counts by partition, not from a window
over a group. Then blocks of ``FAN ** DEEP`` consecutive nodes are folded by tasks, in rounds, until ``TOP`` nodes are
left; should more groups than that be left, each with its one node, they become one sequence and go on. The driver
builds the tree above, at most ``TOP`` digests, and broadcasts it; tasks look up the path from their block to the root
in it, finish the proof of each row and fold the row as it is now.

Memory: a block is ``FAN ** DEEP`` rows of some 200 bytes; the driver and each broadcast hold up to 8/7 ``TOP`` digests
of 64 bytes and the names of the groups among them.

Defined cases: a null field counts as ``-``, an empty one as ``0:``; null groups come first; rows of equal id follow
their leaf, and equal leaves the place of the row (which changes nothing in any row's values); null ids come first and
are never tampered with; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import stored

#: Children of a node, levels that a block folds, and nodes that the driver's tree begins with at most.
FAN, DEEP, TOP = 8, 4, 1 << 17
#: Rows of a partition of the sort.
SORTED = 1 << 16
PATH = "array<struct<left:string,right:string>>"


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(name: str | Column) -> Column:
    """A value with its length in bytes; ``-`` for null."""
    value = (F.col(name) if isinstance(name, str) else name).cast("string")
    return F.coalesce(F.concat(F.octet_length(value), F.lit(":"), value), F.lit("-"))


def leaf(*names: str | Column) -> Column:
    return F.sha2(F.concat(*map(field, names)), 256)


def levels(nodes: list[str], up_to: int | None = None, fan: int = FAN) -> list[list[str]]:
    """The levels from these nodes up to one node, or up to so many levels above them."""
    out = [nodes]
    while (len(out[-1]) > 1) if up_to is None else (len(out) <= up_to):
        out.append([H(*out[-1][i : i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def depth(n: int, fan: int = FAN) -> int:
    """Levels that reduce a sequence of n nodes to one."""
    k = 0
    while n > 1:
        n, k = -(-n // fan), k + 1
    return k


def path(tree: list[list[str]], i: int, fan: int = FAN) -> list[tuple[str, str]]:
    """What stands left and right of node i and of each node above it, within their runs."""
    out = []
    for level in tree[:-1]:
        a = i // fan * fan
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + fan])))
        i //= fan
    return out


def folded(digest: str, steps: Iterable[tuple[str, str]]) -> str:
    for left, right in steps:
        digest = H(left, digest, right)
    return digest


def ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows with pos, their rank within ``g`` by these columns, and n, the rows of their group.

    A range sort deals the rows, ties by their place; a partition's rows of a group are ranked there, and counts by
    partition and group, summed along the partitions, give what stands before them.
    """
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    parts = max(1, -(-rows.count() // SORTED))
    dealt = stored(rows.repartitionByRange(parts, "g", *by, "_row").withColumn("_part", F.spark_partition_id()), "sorted")
    counts = dealt.groupBy("_part", "g").agg(F.count("*").alias("_c"))
    before = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "g", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(Window.partitionBy("g")).alias("n"))
    here = F.row_number().over(Window.partitionBy("_part", "g").orderBy(*by, "_row")) - 1
    return dealt.withColumn("_here", here).join(counts, ["_part", "g"]).withColumn("pos", F.col("_before") + F.col("_here")).drop("_part", "_row", "_here", "_before")


class Tree:
    """Rounds of blocks over nodes (g, pos, n, digest, others), and the driver's tree on top of them.

    ``above`` adds to a table of nodes (g, pos) their path to the root, the subroot and the root.
    """

    def __init__(self, nodes: DataFrame, fan: int = FAN, deep: int = DEEP, top: int = TOP):
        self.fan, self.deep, self.rounds = fan, deep, []
        self.spark = nodes.sparkSession
        while True:
            blocks = self._blocks(nodes)
            self.rounds.append(("blocks", blocks))
            nodes = stored(blocks.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / fan**deep).cast("long").alias("n"), self._digest()(F.col("kids.digest"), F.col("n")).alias("digest")), "nodes")
            left = nodes.count()
            if left <= top:
                break
            if not nodes.where("n > 1").limit(1).count():  # a node a group: the groups become one sequence
                nodes = ranked(nodes.select(F.lit("").alias("g"), F.col("g").alias("key"), "digest"), ["key"])
                nodes = stored(nodes, "subroots")
                self.rounds.append(("subroots", nodes))
        self.top = self.spark.sparkContext.broadcast(self._built(nodes.select("g", "pos", "digest").collect()))

    def _blocks(self, nodes: DataFrame) -> DataFrame:
        kid = F.struct("pos", *[c for c in nodes.columns if c not in ("g", "pos", "n")])
        block = F.floor(F.col("pos") / self.fan**self.deep).cast("long").alias("block")
        return stored(nodes.groupBy("g", block).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(kid)).alias("kids")), "blocks")

    def _digest(self):
        fan, deep = self.fan, self.deep

        @F.pandas_udf("string")
        def run(kids: pd.Series, n: pd.Series) -> pd.Series:
            return pd.Series([levels(list(k), min(deep, depth(int(m), fan)), fan)[-1][0] for k, m in zip(kids, n)], dtype=object)

        return run

    def _built(self, rows: list) -> dict:
        """By group the levels from its nodes to its subroot; the levels above the subroots, and the groups' places there."""
        by: dict[str, list] = {}
        for r in rows:
            by.setdefault(r.g, []).append((r.pos, r.digest))
        trees = {g: levels([d for _, d in sorted(v)], fan=self.fan) for g, v in by.items()}
        names = sorted(trees, key=lambda g: g.encode())
        return {"trees": trees, "place": {g: i for i, g in enumerate(names)}, "above": levels([trees[g][-1][0] for g in names], fan=self.fan) if names else []}

    def above(self, nodes: DataFrame) -> DataFrame:
        """The nodes of the highest round with up (path, subroot, root), from the broadcast tree."""
        top, fan = self.top, self.fan

        @F.pandas_udf(f"path {PATH}, subroot string, root string")
        def run(g: pd.Series, pos: pd.Series) -> pd.DataFrame:
            t, out = top.value, []
            for name, i in zip(g, pos):
                own = t["trees"][name]
                steps = path(own, int(i), fan) + path(t["above"], t["place"][name], fan)
                out.append(([{"left": a, "right": b} for a, b in steps], own[-1][0], t["above"][-1][0]))
            return pd.DataFrame(out, columns=["path", "subroot", "root"])

        return nodes.withColumn("up", run("g", "pos"))

    def descended(self) -> DataFrame:
        """The blocks of leaves with up of their own node."""
        known = None
        for kind, table in reversed(self.rounds[1:]):
            if kind == "blocks":
                known = stored(self._inside(self._joined(table, known)), "paths")
            else:  # each node of this sequence is the subroot of a group
                met = table.join(known, ["g", "pos"])
                known = met.select(F.col("key").alias("g"), F.lit(0).cast("long").alias("pos"), F.struct(F.col("up.path").alias("path"), F.col("digest").alias("subroot"), F.col("up.root").alias("root")).alias("up"))
        return self._joined(self.rounds[0][1], known)

    def _joined(self, blocks: DataFrame, known: DataFrame | None) -> DataFrame:
        named = blocks.withColumnRenamed("block", "pos")
        return self.above(named) if known is None else named.join(known, ["g", "pos"])

    def _inside(self, blocks: DataFrame) -> DataFrame:
        """(g, pos, up) of the children of blocks with up."""
        fan, deep = self.fan, self.deep

        @F.pandas_udf(f"array<struct<pos:long,path:{PATH}>>")
        def run(kids: pd.Series, pos: pd.Series, n: pd.Series) -> pd.Series:
            out = []
            for k, first, m in zip(kids, pos, n):
                tree = levels(list(k), min(deep, depth(int(m), fan)), fan)
                out.append([{"pos": int(first) * fan**deep + i, "path": [{"left": a, "right": b} for a, b in path(tree, i, fan)]} for i in range(len(k))])
            return pd.Series(out, dtype=object)

        met = blocks.select("g", "up", F.explode(run(F.col("kids.digest"), "pos", "n")).alias("k"))
        return met.select("g", "k.pos", F.struct(F.concat("k.path", "up.path").alias("path"), "up.subroot", "up.root").alias("up"))


def manifest(docs: DataFrame, id_col: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), text: str = "text", every: int = 3, fan: int = FAN, deep: int = DEEP, top: int = TOP) -> DataFrame:
    """A row for each row of docs: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The fold starts from the row as it is "now": where ``every`` divides the CRC-32 of the id, the letters A-Z of its
    text in lower case, else the row itself.
    """
    key = F.col(id_col).cast("string")
    hit = F.coalesce(F.crc32(key) % every == 0, F.lit(False))
    lowered = F.translate(F.col(text).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"), leaf(*fields).alias("digest"),
        F.when(hit, leaf(*[lowered if f == text else f for f in fields])).alias("tampered"),
    )
    tree = Tree(ranked(own, ["id", "digest"]), fan, deep, top)
    met = tree.descended().select("n", "up", "kids")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row, kids = b.slice(i, 1), pa.RecordBatch.from_struct_array(b.column(2)[i].values)
                n, up = row.column(0)[0].as_py(), row.column(1)[0].as_py()
                rest = [(s["left"], s["right"]) for s in up["path"]]
                ahead = "".join(a + z for a, z in rest)
                at = {c: kids.column(c) for c in ("id", "digest", "tampered")}
                digests, tampered = at["digest"].to_pylist(), at["tampered"].to_pylist()
                inner = levels(digests, min(deep, depth(n, fan)), fan)
                proofs, roots = [], []
                for k, (d, t) in enumerate(zip(digests, tampered)):
                    steps = path(inner, k, fan)
                    proofs.append(H(*(a + z for a, z in steps), ahead))
                    roots.append(folded(folded(t or d, steps), rest))
                m = len(digests)
                cols = [at["digest"], pa.array([up["subroot"]] * m), pa.array([up["root"]] * m), pa.array(proofs), pa.array(roots), pa.array([r == up["root"] for r in roots])]
                yield pa.RecordBatch.from_arrays([at["id"], *cols], names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    rest = T._parse_datatype_string("leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return met.mapInArrow(run, T.StructType([T.StructField("id", own.schema["id"].dataType), *rest.fields])).withColumnRenamed("id", id_col)
