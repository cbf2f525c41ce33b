"""Benchmark decontamination by winnowing.

Of every ``WINDOW - K + 1`` consecutive hashes of ``K`` words the smallest is kept, on either side, so texts that
share ``WINDOW`` consecutive words share a kept hash. Training and benchmark fingerprints are joined, and each hit is
extended word by word along its diagonal; runs of ``WINDOW`` equal words or more count. Items of fewer words are
looked up whole, under their own length.

The benchmark is the bounded side: its size is measured, and it is broadcast in blocks of at most ``BLOCK_MB`` of
text. One block, the usual case, takes one pass over the documents without a shuffle; a larger benchmark takes a pass
a block, stored before the next block is broadcast, and its hits are merged by document. Nothing else is capped:
fingerprints and hits of all documents count.

A text is worked through whole, by the megabyte or by itself if longer. Equal hashes within the words that choose a
fingerprint (ties) are all kept. A word that a text repeats without end meets a repeated one of an item on as many
diagonals as they have words together; each diagonal is followed once, and pairs are held ``PAIRS`` at a time.

Defined cases: null or word-less texts have no words and hit nothing; null item ids hit words but are not listed;
repeated rows are judged row by row; an empty benchmark leaves all documents clean; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import dropped, gram_hashes, lower_table, slices, split_words, stored, string_bytes, text_mb, word_hashes

K, WINDOW, BLOCK_MB = 5, 10, 32
#: Pairs of equal fingerprints that are held at a time.
PAIRS = 1 << 18
IS_WORD = np.zeros(256, bool)
for _a, _z in ((48, 58), (65, 91), (97, 123), (128, 256)):
    IS_WORD[_a:_z] = True
LOWER = lower_table()


def words(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, end to end, and the offsets of its rows in them."""
    data, off = string_bytes(col)
    first, last, at = split_words(data, off, IS_WORD)
    return word_hashes(LOWER[data], first, last), at


def winnowed(h: np.ndarray, at: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the kept k-grams of texts that lie end to end in h; all equal smallest ones are kept."""
    g, w = gram_hashes(h, k), window - k + 1
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = g[:n].copy()
    for j in range(1, w):
        np.minimum(least, g[j : j + n], out=least)
    whole = np.ones(n, bool)  # windows that don't cross into the next text
    for j in range(1, window):
        cross = at[1:-1] - j
        whole[cross[(cross >= 0) & (cross < n)]] = False
    keep = np.zeros(len(g), bool)
    for j in range(w):
        keep[j : j + n] |= whole & (g[j : j + n] == least)
    places = np.flatnonzero(keep)
    return places, g[places]


class Benchmark:
    """A block of items as arrays: words, kept fingerprints with their places, and the short items by length."""

    def __init__(self, ids: list, texts: list, k: int = K, window: int = WINDOW):
        self.k, self.window = k, window
        self.ids = ["" if i is None else str(i) for i in ids]
        self.listed = np.array([i is not None for i in ids], bool)
        self.h, self.at = words(pa.array(texts, pa.string()))
        n = np.diff(self.at)
        places, g = winnowed(self.h, self.at, k, window)
        self.seeds = self._sorted(g, places)
        self.short = {}
        for size in np.unique(n[(n > 0) & (n < window)]):
            own = self.at[:-1][n == size]
            self.short[int(size)] = self._sorted(gram_hashes(self.h, int(size))[own], own)

    @staticmethod
    def _sorted(g: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes, where each one's places begin, and the places."""
        order = np.argsort(g, kind="stable")
        keys, first = np.unique(g[order], return_index=True)
        return keys, np.append(first, len(g)), places[order]

    @staticmethod
    def _met(table: tuple, g: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joins fingerprints: pairs (place in the documents, place in the items) of equal hashes."""
        keys, first, own = table
        if not len(keys) or not len(g):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        i = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
        hit = keys[i] == g
        i, places = i[hit], places[hit]
        n = first[i + 1] - first[i]
        ends = np.cumsum(n)
        return np.repeat(places, n), own[np.arange(n.sum()) + np.repeat(first[i] - (ends - n), n)]

    def hits(self, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, first word, end) of every run of equal words that holds a window, places in h."""
        found = []
        keys = self._diagonals(h, at)
        for part in np.array_split(keys, max(1, keys.shape[1] // 20_000), axis=1) if keys.shape[1] else ():
            found.append(self._extended(h, at, *part))
        for size, table in self.short.items():
            g = gram_hashes(h, size)
            p, q = self._met(table, g, np.arange(len(g)))
            doc, item = np.searchsorted(at, p, "right") - 1, np.searchsorted(self.at, q, "right") - 1
            same = p + size <= at[doc + 1]
            for j in range(size):
                same[same] = h[p[same] + j] == self.h[q[same] + j]
            found.append((doc[same], item[same], p[same], p[same] + size))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4

    def _diagonals(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distinct (document, item, diagonal) of equal fingerprints, rows of an array. One that occurs often on both sides
        meets in very many pairs on few diagonals, so pairs are made ``PAIRS`` at a time."""
        places, g = winnowed(h, at, self.k, self.window)
        keys, first, own = self.seeds
        if not len(keys) or not len(g):
            return np.zeros((3, 0), np.int64)
        i = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
        hit = keys[i] == g
        i, places = i[hit], places[hit]
        n = first[i + 1] - first[i]
        ends = np.cumsum(n)
        items, span = len(self.at), len(h) + len(self.h)
        codes, lo = [np.zeros(0, np.int64)], 0
        while lo < len(i):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, "right")))
            m = n[lo:hi]
            p = np.repeat(places[lo:hi], m)
            q = own[np.arange(len(p)) + np.repeat(first[i[lo:hi]] - (np.cumsum(m) - m), m)]
            doc, item = np.searchsorted(at, p, "right") - 1, np.searchsorted(self.at, q, "right") - 1
            codes.append(np.unique((doc * items + item) * span + (p - q + len(self.h))))
            lo = hi
        codes = np.unique(np.concatenate(codes))
        return np.stack([codes // span // items, codes // span % items, codes % span - len(self.h)])

    def _extended(self, h, at, doc, item, diagonal):
        """Runs of window or more equal words on diagonals; place in the documents = place in the items + diagonal."""
        lo = np.maximum(self.at[item], at[doc] - diagonal)
        n = np.maximum(0, np.minimum(self.at[item + 1], at[doc + 1] - diagonal) - lo)
        ends = np.cumsum(n)
        own = np.arange(n.sum()) + np.repeat(lo - (ends - n), n)  # places in the items
        same = np.zeros(len(own) + 1, bool)
        same[:-1] = self.h[own] == h[own + np.repeat(diagonal, n)]
        edge = np.zeros(len(own) + 1, bool)
        edge[ends] = True
        edge[0] = True
        begin = np.flatnonzero(same & (edge | ~np.concatenate([[False], same[:-1]])))
        close = np.flatnonzero(~same | edge)
        stop = close[np.searchsorted(close, begin, "right")] if len(begin) else begin
        long = stop - begin >= self.window
        begin, stop = begin[long], stop[long]
        i = np.searchsorted(ends, begin, "right")
        first = own[begin] + diagonal[i]
        return doc[i], item[i], first, first + stop - begin


def covered(n_words: int, first: np.ndarray, end: np.ndarray) -> int:
    """Words inside any of the runs."""
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, end, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_mb: float = BLOCK_MB):
    """The benchmark in parts of about block_mb of text, each collected for a broadcast by itself."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    n = max(1, -(-int(text_mb(items, "text") * 1000) // int(block_mb * 1000)))
    for i in range(n):
        rows = (items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i) if n > 1 else items).collect()
        yield n, Benchmark([r.id for r in rows], [r.text for r in rows])


def find(docs: DataFrame, block, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n_words, first, end, items) of every document against one broadcast block of the benchmark."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        own = block.value
        for b in rows:
            for lo, hi in slices(b.column(1)):
                h, at = words(b.column(1)[lo:hi])
                doc, item, first, end = own.hits(h, at)
                order = np.argsort(doc, kind="stable")
                doc, item, first, end = doc[order], item[order], first[order], end[order]
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                out = {"first": [], "end": [], "items": []}
                for r in range(hi - lo):
                    a, z = cut[r], cut[r + 1]
                    out["first"].append((first[a:z] - at[r]).tolist())
                    out["end"].append((end[a:z] - at[r]).tolist())
                    out["items"].append([own.ids[i] for i in np.unique(item[a:z]) if own.listed[i]] if z > a else [])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], b.column(2)[lo:hi], pa.array(np.diff(at)), pa.array(out["first"], pa.list_(pa.int64())), pa.array(out["end"], pa.list_(pa.int64())), pa.array(out["items"], pa.list_(pa.string()))],
                    names=["id", "text_hash", "n_words", "first", "end", "items"],
                )

    cols = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return cols.mapInArrow(run, f"id {kind}, text_hash long, n_words long, first array<long>, end array<long>, items array<string>")


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_mb: float = BLOCK_MB) -> DataFrame:
    """(id, n_words, first, end, items): each document's runs of words (from first to before end) and items hit."""
    parts = []
    for n, block in blocks(benchmark, item_col, item_text, block_mb):
        held = docs.sparkSession.sparkContext.broadcast(block)
        part = find(docs, held, id_col, text_col)
        if n == 1:
            return part.drop("text_hash")
        parts.append(stored(part, "hits"))  # one block at a time is in the executors' memory
        held.unpersist()
    found = parts[0].select("id", "text_hash", "n_words")
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    merged = every.where("size(first) > 0").groupBy(F.col("id").alias("m_id"), F.col("text_hash").alias("m_hash")).agg(*[F.flatten(F.collect_set(c)).alias(c) if c == "items" else F.flatten(F.collect_list(c)).alias(c) for c in ("first", "end", "items")])
    empty = [F.coalesce(c, F.array().cast(k)).alias(c) for c, k in (("first", "array<bigint>"), ("end", "array<bigint>"), ("items", "array<string>"))]
    return found.join(merged, F.col("id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")), "left").select("id", "n_words", *empty)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        for b in rows:
            out = []
            for n, first, end, items in zip(*(b.column(c).to_pylist() for c in ("n_words", "first", "end", "items"))):
                items = sorted(set(items))
                out.append((covered(n, np.array(first, np.int64), np.array(end, np.int64)) if first else 0, len(items), hashlib.sha256(",".join(items).encode()).hexdigest()))
            n_hit = pa.array([x[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_words"), n_hit, pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.string()), pa.array([x[0] > 0 for x in out], pa.bool_())], names=["id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    found = hits(docs, benchmark, id_col, text_col, **kw)
    return found.mapInArrow(run, f"id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean").withColumnRenamed("id", id_col)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_mb: float = BLOCK_MB) -> DataFrame:
    """docs without the documents that a benchmark window occurs in, all columns as they were; a pass a block."""
    place = docs.columns.index(text_col)

    def against(block):
        def run(rows):
            for b in rows:
                col = b.column(place)
                keep = np.ones(b.num_rows, bool)
                for lo, hi in slices(col):
                    keep[lo + np.unique(block.value.hits(*words(col[lo:hi]))[0])] = False
                yield b.filter(pa.array(keep))

        return run

    schema, before = docs.schema, None
    for n, block in blocks(benchmark, item_col, item_text, block_mb):
        held = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.mapInArrow(against(held), schema)
        if n > 1:  # one block at a time is in the executors' memory
            docs = stored(docs, "clean")
            held.unpersist()
            if before is not None:
                dropped(before)
            before = docs
    return docs
