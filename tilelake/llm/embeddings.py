"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors of a label are one class. Classes are turned onto the principal axes of all of them, scaled to unit
length, sorted along the leading axes and cut into tiles of at most ``TILE`` vectors. Two tiles are compared only if
they meet in a cell of the leading axes and the boxes around their leading coordinates come within the reach that the
threshold allows. In a pair of tiles the
products of leading axes are summed first; what the other axes can add is bounded by the product of the two suffix
norms, and a pair of vectors is dropped once its cosine cannot reach the threshold. What remains is decided in double
precision on the vectors as given. What travels are the vectors as given, in their own precision, a tile once to each run of up
to eight neighbouring partners, where they are turned again. A tile pair sends on link counts and a spanning forest, never its pairs.

Defined cases: rows with a null label or vector, a vector that is empty, zero, or holds a null or non-finite component
link with nothing and are kept; only vectors of equal length are compared; a repeated row is one more vector, linked
to its copies; a null vec_id is a component of its own unless it links; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import components, stored

THRESHOLD, TILE, BOX, CLOSE = 0.98, 512, 8, 1e-9
#: Tiles meet in cells of so many leading axes, of this width at least; a run is up to 2 ** RUN neighbouring tiles.
AXES, CELL, RUN = 3, 0.25, 3


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """A column of float arrays of one length as rows of doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def axes_of(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes, strongest first, by vector length: second moments are summed in tasks, then by Spark."""

    def run(rows):
        sums: dict[int, np.ndarray] = {}
        for b in rows:
            dims = b.column(0).to_numpy()
            for d in np.unique(dims):
                x = unit(matrix(b.column(1).filter(pa.array(dims == d)), int(d)))
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, s in sums.items():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(s[i, j])], names=["dim", "i", "j", "s"])

    t = classes.select("dim", "vector").mapInArrow(run, "dim int, i int, j int, s double").groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    out = {}
    for d, g in t.groupby("dim"):
        m = np.zeros((d, d))
        m[g.i, g.j] = g.s
        m[g.j, g.i] = g.s
        out[int(d)] = np.ascontiguousarray(np.linalg.eigh(m)[1][:, ::-1])
    return out


def tiles(classes: DataFrame, shared, tile: int = TILE, threshold: float = THRESHOLD, single: bool = False) -> DataFrame:
    """One row per tile: tile, label, dim, lo and hi of its leading coordinates, and its classes and vectors as bytes, of
    single precision if the vectors came so. shared: the broadcast axes."""
    spark = classes.sparkSession
    kind = classes.schema["label"].dataType.simpleString()
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) or 1e-6

    def turned(b) -> list:
        dims, out = b.column("dim").to_numpy(), [None] * b.num_rows
        for d in np.unique(dims):
            rows = np.flatnonzero(dims == d)
            for r, v in zip(rows, unit(matrix(b.column("vector").take(pa.array(rows)), int(d))) @ shared.value[int(d)]):
                out[r] = v
        return out

    def lead(rows):
        for b in rows:
            first = np.array([[*v[:3], 0, 0][:3] for v in turned(b)]).reshape(-1, 3)
            cell = np.floor(first[:, :2] / reach).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell[:, 0]), pa.array(cell[:, 1]), pa.array(first[:, 2])], names=[*b.schema.names, "c1", "c2", "c3"])

    def cut(rows):
        from pyspark import TaskContext

        made, part = 0, TaskContext.get().partitionId()
        held: list = []

        def put(items):
            nonlocal made
            full = np.stack([v for _, _, v, _ in items])
            cid, label, _, _ = items[0]
            lead_ = np.pad(full[:, :BOX], ((0, 0), (0, max(0, BOX - full.shape[1]))))
            made += 1
            return {
                "tile": (part << 32) | made, "label": label, "dim": full.shape[1], "lo": lead_.min(axis=0).tolist(), "hi": lead_.max(axis=0).tolist(),
                "classes": np.array([i[0] for i in items], np.int64).tobytes(), "sizes": np.array([i[3][0] for i in items], np.int64).tobytes(), "given": np.stack([i[3][1] for i in items]).astype(np.float32 if single else np.float64).tobytes(),
            }

        out = []
        for b in rows:
            vectors = b.column("vector").to_pylist()
            for cid, label, n, v, given in zip(b.column("cid").to_pylist(), b.column("label").to_pylist(), b.column("n").to_pylist(), turned(b), vectors):
                if held and (held[0][1] != label or len(held[0][2]) != len(v) or len(held) == tile):
                    out.append(put(held))
                    held.clear()
                held.append((cid, label, v, (n, np.array(given, np.float64))))
            if len(out) >= 16:
                yield from pa.Table.from_pylist(out, schema).to_batches()
                out = []
        if held:
            out.append(put(held))
        if out:
            yield from pa.Table.from_pylist(out, schema).to_batches()

    text = f"tile long, label {kind}, dim int, lo array<double>, hi array<double>, classes binary, sizes binary, given binary"
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(spark.createDataFrame([], text).schema)
    parts = max(1, -(-classes.count() // (tile * 16)))
    placed = classes.mapInArrow(lead, T.StructType([*classes.schema, T.StructField("c1", T.IntegerType()), T.StructField("c2", T.IntegerType()), T.StructField("c3", T.DoubleType())]))
    key = ["label", "dim", "c1", "c2", "c3", "cid"]
    return stored(placed.repartitionByRange(parts, *key).sortWithinPartitions(*key).mapInArrow(cut, text), "tiles")


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's component, of n nodes under edges a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def linked(x: np.ndarray, y: np.ndarray, gx: np.ndarray, gy: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and y at a cosine of threshold or more; x, y turned to the principal axes, gx, gy as given."""
    d, bar = x.shape[1], threshold - CLOSE
    steps = [s for s in (8, 16, 32) if s < d] + [d]
    left = [np.sqrt(np.maximum(0, (v * v)[:, ::-1].cumsum(axis=1)[:, ::-1])) for v in (x, y)]
    left = [np.concatenate([v, np.zeros((len(v), 1))], axis=1) for v in left]
    at = steps[0]
    product = x[:, :at] @ y[:, :at].T
    i, j = np.nonzero(product + left[0][:, at, None] * left[1][None, :, at] >= bar)
    product = product[i, j]
    for to in steps[1:]:
        parts = []
        for lo in range(0, len(i), 1 << 16):
            a, b = i[lo : lo + (1 << 16)], j[lo : lo + (1 << 16)]
            parts.append(np.einsum("ij,ij->i", x[a, at:to], y[b, at:to]))
        product = product + np.concatenate(parts) if parts else product
        on = product + left[0][i, to] * left[1][j, to] >= bar
        i, j, product, at = i[on], j[on], product[on], to
    near = np.flatnonzero(np.abs(product - threshold) <= CLOSE)
    if len(near):
        a, b = gx[i[near]], gy[j[near]]
        product[near] = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
    on = product >= threshold
    return i[on], j[on]


def compared(group: pa.Table, axes: dict[int, np.ndarray], threshold: float, single: bool = False) -> pa.Table:
    """(cid, links, root) for the classes that have a link between the group's tile p and another tile of the group, or
    within p where the group says so; root by pair of tiles."""

    def side(r):
        given = np.frombuffer(r["given"], np.float32 if single else np.float64).reshape(-1, r["dim"]).astype(np.float64)
        return np.frombuffer(r["classes"], np.int64), np.frombuffer(r["sizes"], np.int64), unit(given) @ axes[r["dim"]], given

    def pair(x, y):
        i, j = linked(x[2], y[2], x[3], y[3], threshold)
        if y is x:
            i, j = i[i < j], j[i < j]
            ids, j_at = x[0], j
        else:
            ids, j_at = np.concatenate([x[0], y[0]]), j + len(x[0])
        links = np.bincount(i, y[1][j], len(ids)) + np.bincount(j_at, x[1][i], len(ids))
        root = forest(i, j_at, len(ids))
        on = np.flatnonzero(links)
        return pa.table({"cid": ids[on], "links": links[on].astype(np.int64), "root": ids[root[on]]})

    own = group.column("p")[0].as_py()
    place = group.column("tile").to_pylist().index(own)
    x = side(group.slice(place, 1).to_pylist()[0])
    made = [pair(x, x)] if group.column("itself")[0].as_py() else []
    for k in range(group.num_rows):  # one partner's vectors in memory at a time
        if k != place:
            made.append(pair(x, side(group.slice(k, 1).to_pylist()[0])))
    return pa.concat_tables(made)


def meeting(boxes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(p, q): tiles of a label, p = q or p < q, whose boxes of leading coordinates come within the reach of threshold.

    They meet in cells of the first ``AXES`` coordinates, p in all that its box with that reach touches, q in all that
    its box touches, and count in the first cell they share. Coordinates lie in -1 to 1, so a tile is in at most
    (2 / ``CELL`` + 2) cells an axis, and a small tile in one or a few."""
    square = 2 - 2 * threshold + 1e-6
    reach = float(np.sqrt(square))
    cell = max(CELL, reach)

    def celled(by: float) -> DataFrame:
        out = boxes
        for k in range(AXES):
            first, last = F.floor((F.col("lo")[k] - by) / cell), F.floor((F.col("hi")[k] + by) / cell)
            out = out.withColumn(f"f{k}", first).withColumn(f"c{k}", F.explode(F.sequence(first, last)))
        return out

    same = [f"a.{c} = b.{c}" for c in ("label", "dim", *(f"c{k}" for k in range(AXES)))]
    once = [f"a.c{k} = greatest(a.f{k}, b.f{k})" for k in range(AXES)]
    gap = " + ".join(f"pow(greatest(0D, a.lo[{k}] - b.hi[{k}], b.lo[{k}] - a.hi[{k}]), 2)" for k in range(BOX))
    near = " and ".join([*same, *once, "a.tile <= b.tile", f"{gap} <= {square}"])
    return celled(reach).alias("a").join(celled(0.0).alias("b"), F.expr(near)).select(F.col("a.tile").alias("p"), F.col("b.tile").alias("q"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(id, n_links, component_id, kept): one row per vector."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    good = F.expr("label is not null and coalesce(size(vector), 0) > 0 and forall(vector, v -> v is not null and not isnan(v) and abs(v) < double('infinity')) and exists(vector, v -> v <> 0)")
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    classes = rows.where("good").groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")), "classes")
    shared = vectors.sparkSession.sparkContext.broadcast(axes_of(classes))
    single = "array<float>" == vectors.schema[vector_col].dataType.simpleString()
    cut = tiles(classes.select("cid", "label", "dim", "vector", "n"), shared, tile, threshold, single)
    pairs = meeting(cut.select("tile", "label", "dim", "lo", "hi"), threshold)
    # a tile goes once to each run of partners that are neighbours in the order of tiles, not once to each
    runs = pairs.groupBy("p", F.shiftright("q", RUN).alias("run")).agg(F.collect_set("q").alias("qs"))
    sides = runs.select("p", "run", F.array_contains("qs", F.col("p")).alias("itself"), F.explode(F.array_union(F.array("p"), "qs")).alias("tile"))
    found = sides.join(cut.select("tile", "dim", "classes", "sizes", "given"), "tile")
    found = stored(found.groupBy("p", "run").applyInArrow(lambda t: compared(t, shared.value, threshold, single), "cid long, links long, root long"), "links")
    label = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    out = classes.join(links, "cid", "left").join(label.withColumnRenamed("node", "cid").withColumnRenamed("label", "root"), "cid", "left")
    out = out.select(F.col("label").alias("c_label"), F.col("vector").alias("c_vector"), "least", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("root"))
    least = out.groupBy("root").agg(F.min("least").alias("component"))
    out = out.join(least, "root")
    joined = rows.where("good").join(out, (F.col("label") == F.col("c_label")) & (F.col("vector") == F.col("c_vector"))).select("id", (F.col("links") + F.col("n") - 1).alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
