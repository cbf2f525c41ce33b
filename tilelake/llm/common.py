"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.graph import components, dropped, shared_dir, stored  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_mb(df: DataFrame, col: str) -> float:
    """Megabytes of UTF-8 in a column: one small aggregate, from which partition counts follow."""
    return (df.agg(F.sum(F.octet_length(col)).alias("b")).first().b or 0) / 1e6


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and len + 1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def slices(col: pa.Array, most: int = 1 << 20):
    """Row ranges of about ``most`` bytes of text or one row."""
    off = string_bytes(col)[1]
    lo = 0
    while lo < len(off) - 1:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def split_words(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that ``is_word`` (a table of 256 flags) accepts, never across texts.

    Returns first bytes, ends, and len(off) positions in them at which each text begins.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    starts = inside[1:-1] & ~inside[:-2]
    cuts = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
    starts[cuts] |= inside[1:-1][cuts]
    ends = inside[1:-1] & ~inside[2:]
    ends[cuts - 1] |= inside[1:-1][cuts - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(first, off)


def lower_table() -> np.ndarray:
    to = np.arange(256, dtype=np.uint8)
    to[65:91] += 32
    return to


_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, at_a_time: int = 1 << 21) -> np.ndarray:
    """64-bit hashes of words given by their bytes: sums of mixed (byte, place in the word), mixed with the length.

    Words of equal bytes have equal hashes wherever they stand.
    """
    out = np.zeros(len(first), np.uint64)
    lo = 0
    while lo < len(first):
        hi = max(lo + 1, int(np.searchsorted(last, first[lo] + at_a_time, "right")))
        a, n = first[lo:hi] - first[lo], last[lo:hi] - first[lo:hi]
        part = data[first[lo] : last[hi - 1]]
        begin = np.zeros(len(part), np.int32)
        begin[a[1:]] = np.diff(a)
        place = np.arange(len(part), dtype=np.int32) - np.cumsum(begin, dtype=np.int32)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(mixed((place.astype(np.uint64) << np.uint64(8)) | part), out=sums[1:])
        out[lo:hi] = mixed(sums[a + n] - sums[a] + n.astype(np.uint64) * _BASE)
        lo = hi
    return out


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k words in a row; shorter than h by k - 1."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = mixed(out * _BASE + h[i : len(h) - k + 1 + i])
    return out
