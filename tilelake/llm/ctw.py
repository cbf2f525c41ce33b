"""Language-model scoring by context-tree weighting over bytes.

A text is its lower-cased words, one space between them, and an end byte. Each byte is eight binary decisions; every
decision has a tree of contexts, the last 0..DEPTH bytes. A node mixes, half and half, its own Krichevsky-Trofimov
estimate and the product of its children's; with the training counts fixed, the weights follow bottom-up, and the
probability of a decision is the mixture along its path. A context that training never reached gives one half, as the
tree of no data does. The probabilities of both outcomes add up to one at every node.

As Spark jobs: documents are dealt into blocks of about ``BLOCK_MB``. A block sends its distinct (context, byte)
grams, with training counts, to the partitions that own their last ``ROOT`` context bytes. Those build the subtrees and
send up one sum per node above them; the top of the tree, at most 65,793 contexts, is mixed on the driver and
broadcast. Each partition then answers the blocks' grams with log probabilities, and blocks score their documents. The
counts of words for the unigram base take the same way. Nothing unbounded is broadcast or collected; the grams sent
grow with the corpus.

Words are counted by 64-bit hashes of their bytes (for V distinct words two of them meet with odds of V^2 / 2^65).

Defined cases: null and empty texts are the end alone; a very long text is scored whole, in slices of a megabyte; equal
scores need no order; repeated rows train and score as often as they come; with no
training rows every decision has probability one half; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import lower_table, slices, split_words, stored, string_bytes, text_mb, word_hashes

DEPTH, ROOT, BLOCK_MB = 6, 3, 20
END, SPACE = 10, 32
STEP = 1 << 20
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
LOWER = lower_table()
_SMALL = np.concatenate([[0.0], np.array([math.lgamma(i / 2) for i in range(1, 8192)])])


def lgamma_half(twice: np.ndarray) -> np.ndarray:
    """log Gamma(twice / 2) for whole numbers twice >= 1."""
    out = _SMALL[np.minimum(twice, 8191)]
    big = twice > 8191
    if big.any():
        x = twice[big] / 2.0
        out[big] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return out


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return lgamma_half(2 * n0 + 1) + lgamma_half(2 * n1 + 1) - lgamma_half(2 * (n0 + n1) + 2) - math.log(math.pi)


def stream(col: pa.Array, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts with ``depth`` end bytes before each; where each begins (its last padding passed) and
    ends; hashes of all words; offsets of the texts in them."""
    data, off = string_bytes(col)
    first, last, at = split_words(data, off, NOT_SPACE)
    data = LOWER[data]
    hashes = word_hashes(data, first, last)
    keep = NOT_SPACE[data]
    inner = np.ones(len(first), bool)
    inner[at[:-1][at[:-1] < at[1:]]] = False
    gap = first[inner] - 1
    keep[gap] = True
    data[gap] = SPACE
    kept = np.concatenate([[0], np.cumsum(keep)])[off]
    sizes = np.diff(kept)
    begin = np.cumsum(sizes + depth + 1) - sizes - 1
    out = np.full(int(sizes.sum()) + len(sizes) * (depth + 1), END, np.uint8)
    out[np.arange(kept[-1]) + np.repeat(begin - kept[:-1], sizes)] = data[keep]
    return out, begin, begin + sizes + 1, hashes, at


def grams(x: np.ndarray, lo: int, hi: int, depth: int = DEPTH) -> np.ndarray:
    """Keys of places lo..hi of a stream: the last byte before it on top, then those before, then the byte itself."""
    key = x[lo:hi].astype(np.uint64)
    for j in range(1, depth + 1):
        key |= x[lo - j : hi - j].astype(np.uint64) << np.uint64(8 * (depth - j + 1))
    return key


def counted(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of n (1 each if none)."""
    if n is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


def squeezed(a: np.ndarray, sorted_keys: bool = False) -> bytes:
    """An array as compressed byte planes, sorted keys as differences."""
    if sorted_keys and len(a):
        a = np.concatenate([a[:1], np.diff(a)])
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(len(a), -1).T.tobytes())


def restored(b: bytes, kind, sorted_keys: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(kind).itemsize
    a = np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(a, dtype=kind) if sorted_keys else a


def places(x: np.ndarray, begin: np.ndarray, end: np.ndarray, mark: np.ndarray, step: int = STEP):
    """(lo, hi, which): slices of a stream and the mark of the document of each place, -1 for padding."""
    which = np.repeat(np.stack([np.full(len(mark), -1, mark.dtype), mark], axis=1).ravel(), np.diff(np.stack([begin, end], axis=1).ravel(), prepend=0))
    first = int(begin[0]) if len(begin) else 0
    for lo in range(first, len(x), step):
        hi = min(len(x), lo + step)
        yield lo, hi, which[lo:hi]


def streams(t: pa.Table, depth: int):
    """Streams of about a megabyte of a block's documents, with their rows."""
    text = t.column("text").combine_chunks()
    for lo, hi in slices(text, STEP):
        yield lo, hi, *stream(text[lo:hi], depth)


class Subtrees:
    """All nodes from depth ``root`` down over distinct grams and their training counts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int = DEPTH, root: int = ROOT):
        self.depth, self.root, self.keys = depth, root, keys
        self.at: dict[int, np.ndarray] = {depth: np.arange(len(keys))}  # rows of each depth for the rows of keys
        self.nodes: dict[tuple[int, int], tuple] = {}
        k, below, up = keys, None, None
        for d in range(depth, root - 1, -1):
            if d < depth:
                shorter = ((k >> np.uint64(16)) << np.uint64(8)) | (k & np.uint64(255))
                k, up = np.unique(shorter, return_inverse=True)
                n = np.bincount(up, n, len(k)).astype(np.int64)
                self.at[d] = up[self.at[d + 1]]
            now = {}
            for j in range(8):
                node = k >> np.uint64(8 - j)
                begin = np.concatenate([[True], node[1:] != node[:-1]]) if len(k) else np.zeros(0, bool)
                group = np.cumsum(begin) - 1
                bit = ((k >> np.uint64(7 - j)) & np.uint64(1)).astype(bool)
                first = np.flatnonzero(begin)
                n1 = np.bincount(group[bit], n[bit], len(first)).astype(np.int64)
                n0 = np.bincount(group[~bit], n[~bit], len(first)).astype(np.int64)
                own = log_kt(n0, n1)
                if d == depth:
                    total, weight = own, None
                else:
                    rows, logs = below[j]
                    children = np.bincount(group[up[rows]], logs, len(first))
                    total = np.logaddexp(own, children) - math.log(2)
                    weight = 1 / (1 + np.exp(np.clip(children - own, -700, 700)))
                now[j] = (first, total)
                self.nodes[d, j] = (group, n0, n1, weight)
            below = now
        self.top_rows, self.top_keys = below, k

    def above(self) -> tuple[np.ndarray, ...]:
        """(context of root - 1 bytes, node number 1..255, n0, n1, summed logs) for what stands above the roots."""
        out = []
        for j in range(8):
            rows, logs = self.top_rows[j]
            _, n0, n1, _ = self.nodes[self.root, j]
            k = self.top_keys[rows]
            node = ((k & np.uint64(255)) >> np.uint64(8 - j)) | np.uint64(1 << j)
            key, where = np.unique(((k >> np.uint64(16)) << np.uint64(8)) | node, return_inverse=True)
            out.append((key, *(np.bincount(where, v, len(key)) for v in (n0, n1, logs))))
        return tuple(np.concatenate(x) for x in zip(*out))

    def log_probabilities(self, top: "Top") -> np.ndarray:
        """log10 of the probability of each gram's byte after its context."""
        out = np.zeros(len(self.keys))
        for j in range(8):
            bit = ((self.keys >> np.uint64(7 - j)) & np.uint64(1)).astype(bool)
            p = None
            for d in range(self.depth, self.root - 1, -1):
                group, n0, n1, weight = self.nodes[d, j]
                g = group[self.at[d]]
                n = n0[g] + n1[g]
                own = (np.where(bit, n1[g], n0[g]) + 0.5) / (n + 1)
                p = own if p is None else weight[g] * own + (1 - weight[g]) * p
            node = ((self.keys & np.uint64(255)) >> np.uint64(8 - j)) | np.uint64(1 << j)
            out += np.log10(top.mixed(self.keys >> np.uint64(8 * (self.depth - self.root + 2)), node, bit, p))
        return out


class Top:
    """The nodes of depth root - 1 and less, from sums that the subtrees send up."""

    def __init__(self, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, logs: np.ndarray, root: int = ROOT):
        self.levels = []
        for d in range(root - 1, -1, -1):
            own = log_kt(n0, n1)
            self.levels.append((keys, n0, n1, 1 / (1 + np.exp(np.clip(logs - own, -700, 700)))))
            total = np.logaddexp(own, logs) - math.log(2)
            if d:
                shorter = ((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255))
                keys, where = np.unique(shorter, return_inverse=True)
                n0, n1 = (np.bincount(where, v, len(keys)).astype(np.int64) for v in (n0, n1))
                logs = np.bincount(where, total, len(keys))

    def mixed(self, context: np.ndarray, node: np.ndarray, bit: np.ndarray, p: np.ndarray) -> np.ndarray:
        """context: root - 1 bytes; p: of the node below."""
        for keys, n0, n1, weight in self.levels:
            k = (context << np.uint64(8)) | node
            if len(keys):
                i = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                there = keys[i] == k
                a, b, w = np.where(there, n0[i], 0), np.where(there, n1[i], 0), np.where(there, weight[i], 0.5)
            else:
                a, b, w = np.zeros(len(k)), np.zeros(len(k)), 0.5
            own = (np.where(bit, b, a) + 0.5) / (a + b + 1)
            p = w * own + (1 - w) * p
            context = context >> np.uint64(8)
        return p


def owner(keys: np.ndarray, parts: int, depth: int, root: int = ROOT) -> np.ndarray:
    """The partition that holds a gram's last ``root`` context bytes."""
    from .common import mixed

    return (mixed(keys >> np.uint64(8 * (depth - root + 1))) % np.uint64(parts)).astype(np.int64)


def _send(block: int, kind: int, keys: np.ndarray, n: np.ndarray, to: np.ndarray, parts: int):
    order = np.argsort(to, kind="stable")
    cut = np.searchsorted(to[order], np.arange(parts + 1))
    for g in range(parts):
        own = order[cut[g] : cut[g + 1]]
        if len(own):
            yield {"part": g, "block": block, "kind": kind, "keys": squeezed(keys[own], True), "n": squeezed(n[own].astype(np.uint32))}


def scores(docs: DataFrame, is_training, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, block_mb: float = BLOCK_MB) -> DataFrame:
    """(id, training, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) of every document.

    is_training: a Boolean column of docs. score and base_score are log10 probabilities of the whole token sequence.
    """
    if not ROOT <= depth <= 7:
        raise ValueError(f"depth must lie in {ROOT}..7")
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(is_training, F.lit(False)).alias("training"))
    parts = max(1, round(text_mb(rows, "text") / block_mb))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(parts)).cast("int"))

    def gather(t: pa.Table) -> pa.Table:
        """A block's distinct grams and words with their training counts, for the partitions that own them."""
        training = t.column("training").combine_chunks().to_numpy(zero_copy_only=False)
        held: tuple = ([], []), ([], [])

        def keep(which: int, trained: np.ndarray, other: np.ndarray) -> None:
            a, n = counted(trained)
            b = counted(other)[0]
            held[which][0].extend([a, b])
            held[which][1].extend([n, np.zeros(len(b), np.int64)])
            if len(held[which][0]) >= 16:  # so that few slices are held at a time
                a, n = counted(*map(np.concatenate, held[which]))
                held[which][0][:], held[which][1][:] = [a], [n]

        for first, last, x, begin, end, hashes, at in streams(t, depth):
            for lo, hi, mark in places(x, begin, end, training[first:last].astype(np.int8)):
                key = grams(x, lo, hi, depth)
                keep(0, key[mark == 1], key[mark == 0])
            trained = np.repeat(training[first:last], np.diff(at))
            keep(1, hashes[trained], hashes[~trained])
        block, out = t.column("block")[0].as_py(), []
        for kind, (keys, n) in enumerate(held):
            keys, n = counted(np.concatenate(keys), np.concatenate(n))
            out += _send(block, kind, keys, n, (keys % np.uint64(parts)).astype(np.int64) if kind else owner(keys, parts, depth), parts)
        return pa.Table.from_pylist(out, pa.schema([("part", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())]))

    sent = stored(rows.groupBy("block").applyInArrow(gather, "part int, block int, kind int, keys binary, n binary"), "grams")

    def merged(t: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
        keys = [restored(b, np.uint64, True) for b in t.column("keys").to_pylist()]
        n = [restored(b, np.uint32).astype(np.int64) for b in t.column("n").to_pylist()]
        return keys, *counted(np.concatenate(keys), np.concatenate(n))

    def sums(t: pa.Table) -> pa.Table:
        """What a partition sends to the top: nodes' sums; of words their number and occurrences."""
        _, keys, n = merged(t)
        if t.column("kind")[0].as_py():
            cols = (np.array([0], np.int64), *(np.array([v], np.float64) for v in (n.sum(), (n > 0).sum(), 0)))
            return pa.table({"kind": pa.array([1], pa.int32()), "key": cols[0], "n0": cols[1], "n1": cols[2], "logs": cols[3]})
        key, n0, n1, logs = Subtrees(keys, n, depth).above()
        return pa.table({"kind": pa.array(np.zeros(len(key), np.int32)), "key": key.astype(np.int64), "n0": n0.astype(float), "n1": n1.astype(float), "logs": logs})

    tops = sent.groupBy("part", "kind").applyInArrow(sums, "kind int, key long, n0 double, n1 double, logs double").groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "logs")]).toArrow()
    of = np.array(tops.column("kind"), np.int64)
    key, n0, n1, logs = (np.array(tops.column(c)) for c in ("key", "n0", "n1", "logs"))
    words, distinct = (int(n0[of == 1].sum()), int(n1[of == 1].sum()))
    own = np.flatnonzero(of == 0)
    own = own[np.argsort(key[own])]
    top = spark.sparkContext.broadcast(Top(key[own].astype(np.uint64), n0[own].astype(np.int64), n1[own].astype(np.int64), logs[own]))

    def answer(t: pa.Table) -> pa.Table:
        """Log probabilities of the grams that each block sent, counts of its words."""
        of_kind = t.column("kind")[0].as_py()
        sets, keys, n = merged(t)
        value = n if of_kind else Subtrees(keys, n, depth).log_probabilities(top.value).astype(np.float32)
        values = [squeezed(value[np.searchsorted(keys, k)]) for k in sets]
        return pa.table({"block": t.column("block"), "kind": t.column("kind"), "keys": t.column("keys"), "value": pa.array(values, pa.binary())})

    answers = sent.groupBy("part", "kind").applyInArrow(answer, "block int, kind int, keys binary, value binary")
    train_docs = rows.agg(F.sum(F.col("training").cast("long")).alias("n")).first().n or 0
    total, vocabulary = words + train_docs, distinct + (train_docs > 0)
    denominator = total + 0.1 * (vocabulary + 1)

    def score(t: pa.Table, a: pa.Table) -> pa.Table:
        table = {}
        for k in (0, 1):
            mine = [i for i, v in enumerate(a.column("kind").to_pylist()) if v == k]
            if mine:
                keys = np.concatenate([restored(a.column("keys")[i].as_py(), np.uint64, True) for i in mine])
                value = np.concatenate([restored(a.column("value")[i].as_py(), np.int64 if k else np.float32) for i in mine])
                order = np.argsort(keys)
                table[k] = keys[order], value[order].astype(np.float64)
        cols: list = [[] for _ in range(5)]
        for first, last, x, begin, end, hashes, at in streams(t, depth):
            n, out = last - first, np.zeros(last - first)
            for lo, hi, which in places(x, begin, end, np.arange(n)):
                key = grams(x, lo, hi, depth)[which >= 0]
                which = which[which >= 0]
                order = np.argsort(key)
                out += np.bincount(which[order], table[0][1][np.searchsorted(table[0][0], key[order])], n)
            count = table[1][1][np.searchsorted(table[1][0], hashes)] if len(hashes) else np.zeros(0)
            logs = np.concatenate([[0], np.cumsum(np.log10((count + 0.1) / denominator))])
            known = np.concatenate([[0], np.cumsum(count > 0)])
            base = logs[at[1:]] - logs[at[:-1]] + math.log10((train_docs + 0.1) / denominator)
            for c, v in zip(cols, (np.diff(at) + 1, known[at[1:]] - known[at[:-1]] + (train_docs > 0), base, out, end - begin)):
                c.append(v)
        n_tokens, n_known, base, out, size = map(np.concatenate, cols)
        return pa.table({
            "id": t.column("id"), "training": t.column("training"), "n_tokens": n_tokens.astype(np.int64), "n_known": n_known.astype(np.int64), "train_tokens": np.full(len(size), total, np.int64),
            "base_score": base, "score": out, "n_bytes": size.astype(np.int64), "bits_per_byte": -out / math.log10(2) / size,
        })

    schema = f"id {kind}, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)


def held_out(id_col, modulus: int, remainder: int):
    """A Boolean column: crc32 of the id as text has this remainder. Null ids are held out of neither: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
