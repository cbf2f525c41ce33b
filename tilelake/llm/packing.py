"""Best-fit packing by the sum-of-squares rule.

Each document becomes pieces of at most ``capacity`` tokens; only longer ones are cut, their first piece takes the
remainder. A piece goes where the sum over gaps of the squared number of open sequences with that gap becomes
smallest, equal sums to the tighter fit; a new sequence is begun where no open one has room (with pieces in falling
order this takes fewer sequences than beginning one whenever that lowers the sum). Full pieces are sequences of their own. Pieces are dealt by a hash into
shards of about ``SHARD`` pieces, each packed by one task from the longest down, so that no task grows with the
input; a shard leaves a few open sequences, out of tens of thousands.

Defined cases: a null or empty text is one piece with the end id alone; repeated rows are packed as often as they
come; an empty table gives no rows; other columns are ignored. A null doc_id is kept as null. A very long text is
encoded whole, by parts that end at white space, and only its pieces' ids are kept. Pieces of equal length are placed in
the order of their shard; which of them lies where is not defined, how many sequences there are does not depend on it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import slices, stored
from .tokens import GROUP, encoder, tokenizer_path

CAPACITY, SHARD = 2048, 50_000


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; the first takes what is over."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n else []


def sum_of_squares(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and place of every size, all in 1..capacity, taken from the largest down."""
    order = np.argsort(-sizes, kind="stable")
    bins, places = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_with = np.zeros(capacity + 1, np.int64)  # by gap
    which: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in order:
        s = int(sizes[i])
        gap = capacity
        have = np.flatnonzero(open_with[s:capacity])
        if len(have):
            change = 2 - 2 * open_with[s + have] + 2 * open_with[have]
            if have[0] == 0:
                change[0] = 1 - 2 * open_with[s]
            gap = s + int(have[np.argmin(change)])
        if gap == capacity:
            b, made = made, made + 1
        else:
            b = which[gap].pop()
            open_with[gap] -= 1
        if gap > s:
            which[gap - s].append(b)
            open_with[gap - s] += 1
        bins[i], places[i] = b, capacity - gap
    return bins, places


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece."""
    path = path or tokenizer_path()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        encode = encoder(path)
        for b in rows:
            for lo, hi in slices(b.column(1), GROUP):
                ids, off = encode(b.column(1).slice(lo, hi - lo).to_pylist())
                data = ids.astype("<u4").tobytes()
                rows_, out = [], []
                for r, (a, z) in enumerate(zip(off[:-1], off[1:])):
                    for k, (s, n) in enumerate(cut(int(z - a), capacity)):
                        rows_.append(lo + r)
                        out.append((k, s, n, zlib.crc32(data[4 * (a + s) : 4 * (a + s + n)])))
                cols = np.array(out, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows_, pa.int64())), pa.array(cols[:, 0].astype(np.int32)), *(pa.array(cols[:, j].copy()) for j in (1, 2, 3))], names=["id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None, shard: int = SHARD) -> DataFrame:
    """Pieces with sequence_id and offset: every sequence holds at most ``capacity`` tokens without gaps."""
    found = stored(pieces(docs, id_col, text_col, capacity, path), "pieces")
    shards = max(1, -(-found.count() // shard))
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(shards)))
    schema = T.StructType([*found.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def pack(t: pa.Table) -> pa.Table:
        bins, places = sum_of_squares(t.column("length").to_numpy(), capacity)
        base = t.column("shard")[0].as_py() << 32
        return t.drop_columns(["shard"]).append_column("sequence_id", pa.array(bins + base)).append_column("offset", pa.array(places))

    return dealt.groupBy("shard").applyInArrow(pack, schema).withColumnRenamed("id", id_col)
