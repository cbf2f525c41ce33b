"""Language identification by a linear-chain conditional random field over words.

Words are runs of letters and their marks, lower-cased; a run of over ``RUN`` bytes, as in scripts without spaces, counts
as several words in a row. A word's features are its first and last 1 to 4 bytes, all its byte n-grams of 2 to 4,
itself, and the language in whose learned lexicon it stands; transitions between languages are learned too. The field
is fitted by gradient ascent on the conditional likelihood, with forward-backward for the expectations, on a sample of
at most ``PER_LANGUAGE`` distinct texts of each language, of each long text a piece of ``LONGEST`` characters, and
``WORDS`` words of each language; half of the training sequences are put together from pieces of several languages, so
that switches are learned as well.

Every word of every text is labelled by its exact posterior. Long documents are cut into chunks whose transfer matrices
are multiplied first, so that numpy works on all chunks of a batch at once and the result is that of one pass over the
document. A document's language is the one of the largest mean posterior, its score.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text if nothing is labelled to
learn from; equal scores go to the language of least name; repeated rows are labelled alike; an empty table gives no
rows; the columns of the input other than the text never enter a prediction.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import mixed, slices, split_words, string_bytes, word_hashes

PER_LANGUAGE, LONGEST, WORDS, SEQUENCE = 400, 20_000, 30_000, 32
BUCKETS, CHUNK, RUN, ROUNDS = 1 << 17, 128, 48, 40
UND = "und"
IN_WORD = np.ones(256, bool)
IN_WORD[32] = False


def words(col: pa.Array) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes of a text column, words' first bytes and ends, their hashes, and the offsets of rows in them."""
    data, off = string_bytes(pc.replace_substring_regex(pc.utf8_lower(col.cast(pa.large_string())), r"[^\p{L}\p{M}]+", " "))
    first, last, at = split_words(data, off, IN_WORD)
    parts = -(-(last - first) // RUN)
    if (parts > 1).any():  # cut long runs, between characters
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        cut = np.repeat(first, parts) + nth * RUN
        for _ in range(3):
            cut -= (nth > 0) & ((data[cut] & 192) == 128)
        end = np.append(cut[1:], 0)
        final = np.cumsum(parts) - 1
        end[final] = last
        at = np.concatenate([[0], np.cumsum(parts)])[at]
        first, last = cut, end
    return data, first, last, word_hashes(data, first, last), at


def features(data: np.ndarray, first: np.ndarray, last: np.ndarray, hashes: np.ndarray):
    """(which, starts, buckets): the words that have features of a kind, where each one's begin among the buckets, and
    those. First come affixes and n-grams; last is the word itself."""
    size = last - first

    def hashed(kind: int, start: np.ndarray, length: int) -> np.ndarray:
        key = np.full(len(start), kind, np.uint64)
        for j in range(length):
            key = (key << np.uint64(8)) | data[start + j]
        return (mixed(key) & np.uint64(BUCKETS - 1)).astype(np.int64)

    for n in range(1, 5):
        which = np.flatnonzero(size >= n)
        if not len(which):
            break
        one = np.arange(len(which))
        yield which, one, hashed(16 + n, first[which], n)
        yield which, one, hashed(32 + n, last[which] - n, n)
        if n > 1:
            count = size[which] - n + 1
            starts = np.cumsum(count) - count
            place = np.arange(int(count.sum())) + np.repeat(first[which] - starts, count)
            yield which, starts, hashed(48 + n, place, n)
    yield np.arange(len(size)), np.arange(len(size)), (mixed(hashes ^ np.uint64(7)) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclasses.dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # buckets x labels
    lexicon: np.ndarray  # hashes of words, sorted
    lexicon_of: np.ndarray  # the label of each
    of_lexicon: np.ndarray  # labels x labels
    moves: np.ndarray  # labels x labels
    start: np.ndarray

    def listed(self, hashes: np.ndarray) -> np.ndarray:
        """The label in whose lexicon each word stands, -1 for none."""
        if not len(self.lexicon):
            return np.full(len(hashes), -1)
        i = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[i] == hashes, self.lexicon_of[i], -1)

    def emissions(self, data, first, last, hashes) -> np.ndarray:
        """Log scores of each word, of distinct words once."""
        _, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        out = np.zeros((len(one), len(self.labels)), np.float32)
        for which, starts, b in features(data, first[one], last[one], hashes[one]):
            out[which] += self.weights[b] if len(b) == len(which) else np.add.reduceat(self.weights[b], starts)
        listed = self.listed(hashes[one])
        out[listed >= 0] += self.of_lexicon[listed[listed >= 0]]
        return out[back]

    def posteriors(self, scores: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Posterior of every label of every word; documents end to end, at their offsets."""
        k, n = len(self.labels), len(scores)
        e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64) if n else np.zeros((0, k))
        move = np.exp(self.moves - self.moves.max())
        begin = np.exp(self.start - self.start.max())
        sizes = np.diff(at)
        parts = -(-sizes // CHUNK)
        doc = np.repeat(np.arange(len(sizes)), parts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        chunk_at = at[doc] + nth * CHUNK
        chunk_n = np.minimum(CHUNK, at[doc + 1] - chunk_at)
        order = np.argsort(-chunk_n, kind="stable")
        a, live = chunk_at[order], [int((chunk_n > t).sum()) for t in range(int(chunk_n.max(initial=0)))]
        # transfer matrices: from the label before a chunk to that of its last word
        m = np.broadcast_to(np.eye(k), (len(a), k, k)).copy()
        for t, c in enumerate(live):
            x = (m[:c].reshape(-1, k) @ move).reshape(c, k, k) * e[a[:c] + t][:, None, :]
            m[:c] = x / x.max(axis=(1, 2), keepdims=True)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        m = m[back]
        # along each document, the vectors at the chunks' borders
        first_chunk = np.cumsum(parts) - parts
        by_parts = np.argsort(-parts, kind="stable")
        before, after = np.ones((len(doc), k)), np.ones((len(doc), k))
        for t in range(int(parts.max(initial=0))):
            c = int((parts > t).sum())
            i = first_chunk[by_parts[:c]] + t
            if t:
                v = np.einsum("ij,ijk->ik", before[i - 1], m[i - 1]) if t > 1 else self._first(begin, move, e, chunk_at[i - 1], chunk_n[i - 1])
                before[i] = v / v.sum(axis=1, keepdims=True)
        for t in range(int(parts.max(initial=0)) - 2, -1, -1):
            c = int((parts > t + 1).sum())
            i = first_chunk[by_parts[:c]] + t
            v = np.einsum("ijk,ik->ij", m[i + 1], after[i + 1])
            after[i] = v / v.sum(axis=1, keepdims=True)
        # inside all chunks at once
        forward, backward = np.zeros((n, k)), np.zeros((n, k))
        opening = nth[order] == 0
        now = before[order]
        for t, c in enumerate(live):
            v = now[:c] @ move
            if t == 0:
                v[opening[:c]] = begin
            v *= e[a[:c] + t]
            now[:c] = v / v.sum(axis=1, keepdims=True)
            forward[a[:c] + t] = now[:c]
        now = after[order]
        ends = a + chunk_n[order] - 1
        for t, c in enumerate(live):
            backward[ends[:c] - t] = now[:c]
            v = (now[:c] * e[ends[:c] - t]) @ move.T
            now[:c] = v / v.sum(axis=1, keepdims=True)
        p = forward * backward
        return p / p.sum(axis=1, keepdims=True)

    @staticmethod
    def _first(begin, move, e, starts, sizes) -> np.ndarray:
        """Forward vectors at the end of documents' first chunks."""
        now = begin * e[starts]
        now /= now.sum(axis=1, keepdims=True)
        for t in range(1, int(sizes.max(initial=0))):
            on = sizes > t
            v = (now[on] @ move) * e[starts[on] + t]
            now[on] = v / v.sum(axis=1, keepdims=True)
        return now

    def label(self, col: pa.Array):
        """(posteriors of words, offsets of rows in them) of a text column."""
        data, first, last, hashes, at = words(col)
        return self.posteriors(self.emissions(data, first, last, hashes), at), at


def expectations(e: np.ndarray, moves: np.ndarray, start: np.ndarray, y: np.ndarray):
    """Mean log likelihood and gradients of sequences of one length: e is sequences x words x labels, y their labels."""
    s, n, k = e.shape
    shift = e.max(axis=2, keepdims=True)
    x, move, begin = np.exp(e - shift), np.exp(moves), np.exp(start)
    a, b, scale = np.zeros_like(x), np.ones_like(x), np.zeros((s, n))
    for t in range(n):
        v = (a[:, t - 1] @ move if t else begin) * x[:, t]
        scale[:, t] = v.sum(axis=1)
        a[:, t] = v / scale[:, t, None]
    for t in range(n - 2, -1, -1):
        b[:, t] = (b[:, t + 1] * x[:, t + 1]) @ move.T / scale[:, t + 1, None]
    p = a * b
    p /= p.sum(axis=2, keepdims=True)
    pair = np.einsum("stj,stk->jk", a[:, :-1], b[:, 1:] * x[:, 1:] / scale[:, 1:, None]) * move
    hot = np.eye(k)[y]
    gold = np.einsum("stj,stk->jk", hot[:, :-1], hot[:, 1:])
    score = (e * hot).sum() + (moves * gold).sum() + (start * hot[:, 0].sum(axis=0)).sum()
    like = (score - np.log(scale).sum() - shift.sum()) / (s * n)
    return like, (hot - p) / (s * n), (gold - pair) / (s * n), (hot[:, 0] - p[:, 0]).sum(axis=0) / (s * n)


def fitted(texts: list[str], langs: list[str], seed: int = 0, rounds: int = ROUNDS, most: int = WORDS) -> Model:
    """Fits the field to texts of known language; at most ``most`` words of each count, from all its texts alike."""
    labels = sorted(set(langs))
    k, rng = len(labels), np.random.default_rng(seed)
    data, first, last, hashes, at = words(pa.array(texts, pa.string()))
    of_doc = np.array([labels.index(v) for v in langs], np.int64)
    pool = []
    for j in range(k):
        own = np.flatnonzero(of_doc == j)
        each = most  # the same share of every text, and what short ones leave over
        while len(own) and np.minimum(at[own + 1] - at[own], each).sum() > most and each > 1:
            each -= max(1, each // 20)
        parts = [np.arange(at[i], min(at[i + 1], at[i] + each)) for i in own]
        pool.append(np.concatenate(parts)[:most] if parts else np.zeros(0, np.int64))
    blank = Model(labels, np.zeros((BUCKETS, k), np.float32), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((k, k), np.float32), np.zeros((k, k)), np.zeros(k))
    if not k or not sum(map(len, pool)):
        return blank
    rows, marks = [], []
    for j in range(k):
        for lo in range(0, len(pool[j]), SEQUENCE):
            part = pool[j][lo : lo + SEQUENCE]
            part = np.resize(part, SEQUENCE)
            mark = np.full(SEQUENCE, j)
            rows.append(part)
            marks.append(mark)
            if k > 1:  # the same with pieces of other languages
                part, mark = part.copy(), mark.copy()
                edge = np.sort(rng.integers(1, SEQUENCE, 2))
                other = int(rng.choice([i for i in range(k) if i != j and len(pool[i])] or [j]))
                from_ = int(rng.integers(0, len(pool[other])))
                part[edge[0] : edge[1]] = np.take(pool[other], np.arange(from_, from_ + edge[1] - edge[0]), mode="wrap")
                mark[edge[0] : edge[1]] = other
                rows.append(part)
                marks.append(mark)
    place, y = np.stack(rows), np.stack(marks)
    _, one, word = np.unique(hashes[place], return_index=True, return_inverse=True)
    word = word.reshape(place.shape)
    one = place.ravel()[one]
    flat = list(features(data, first[one], last[one], hashes[one]))
    bucket = np.concatenate([b for _, _, b in flat])
    owner = np.concatenate([np.repeat(w, np.diff(s, append=len(b))) for w, s, b in flat])
    counts = np.stack([np.bincount(word[y == j], minlength=len(one)) for j in range(k)], axis=1)
    sure = (counts.sum(axis=1) >= 3) & (counts.max(axis=1) >= 0.8 * counts.sum(axis=1))
    listed = np.where(sure, counts.argmax(axis=1), -1)
    w, lex, moves, start = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros((k, k)), np.zeros(k)
    state = [(np.zeros_like(v), np.zeros_like(v)) for v in (w, lex, moves, start)]
    for r in range(1, rounds + 1):
        e = np.stack([np.bincount(owner, w[bucket, j], len(one)) for j in range(k)], axis=1)
        e[listed >= 0] += lex[listed[listed >= 0]]
        _, ge, gm, gs = expectations(e[word], moves, start, y)
        gw = np.stack([np.bincount(word.ravel(), ge[:, :, j].ravel(), len(one)) for j in range(k)], axis=1)
        grads = [np.stack([np.bincount(bucket, gw[owner, j], BUCKETS) for j in range(k)], axis=1), np.stack([gw[listed == j].sum(axis=0) for j in range(k)]), gm, gs]
        for v, g, (m1, m2) in zip((w, lex, moves, start), grads, state):
            g = g - 1e-6 * v
            m1 *= 0.9
            m1 += 0.1 * g
            m2 *= 0.99
            m2 += 0.01 * g * g
            v += 0.1 * (m1 / (1 - 0.9**r)) / (np.sqrt(m2 / (1 - 0.99**r)) + 1e-8)
    known = np.flatnonzero(listed >= 0)
    own = hashes[one[known]]
    by = np.argsort(own)
    return Model(labels, w.astype(np.float32), own[by], listed[known][by], lex.astype(np.float32), moves, start)


def fit(docs: DataFrame, is_training: Column, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Fits to the labelled training rows; of each language the per_language distinct texts of least hash, or all of
    them. Of a text of over ``LONGEST`` characters a piece from anywhere in it is taken."""
    rows = docs.where(F.coalesce(is_training, F.lit(False))).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    rows = rows.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 40)))
    # about half as many again as wanted, so that a hash decides in the tasks what the exact rank then sees
    share = {r.lang: int(1.5 * (per_language + 50) / r.n * (1 << 40)) for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not share:
        return fitted([], [])
    bound = F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col("lang"))
    piece = F.expr(f"substring(text, cast(1 + pmod(h, greatest(1, char_length(text) - {LONGEST} + 1)) as int), {LONGEST})")
    one = rows.where(F.col("h") < bound).groupBy("lang", "h").agg(F.min(piece).alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    picked = sorted((r.h, r.text, r.lang) for r in one.withColumn("rank", rank).where(F.col("rank") <= per_language).collect())
    return fitted([t for _, t, _ in picked], [v for _, _, v in picked])


def _summary(model: Model, col: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each row of a text column."""
    names, scores = [], []
    letter = pc.fill_null(pc.match_substring_regex(col, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    for lo, hi in slices(col, 1 << 18):
        if not model.labels:
            names += [UND] * (hi - lo)
            scores.append(np.zeros(hi - lo))
            continue
        p, at = model.label(col[lo:hi])
        sums = np.concatenate([np.zeros((1, len(model.labels))), np.cumsum(p, axis=0)])
        n = np.diff(at)
        mean = (sums[at[1:]] - sums[at[:-1]]) / np.maximum(1, n)[:, None]
        best = mean.argmax(axis=1)
        known = (n > 0) & letter[lo:hi]
        names += [model.labels[b] if k else UND for b, k in zip(best, known)]
        scores.append(np.clip(np.where(known, mean.max(axis=1), 0), 0, 1))
    return names, np.concatenate(scores) if scores else np.zeros(0)


def labelled(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every document."""
    own = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        for b in rows:
            names, scores = _summary(own.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores)], names=["id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): runs of words of one most likely language, as (first word, end, lang, mean posterior)."""
    own = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    shape = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string()), ("score", pa.float64())]))

    def run(rows):
        for b in rows:
            for lo, hi in slices(b.column(1), 1 << 20):
                out = []
                p, at = own.value.label(b.column(1)[lo:hi]) if own.value.labels else (np.zeros((0, 0)), np.zeros(hi - lo + 1, np.int64))
                for a, z in zip(at[:-1], at[1:]):
                    best = p[a:z].argmax(axis=1) if z > a else np.zeros(0, np.int64)
                    edge = np.concatenate([[0], np.flatnonzero(np.diff(best)) + 1, [len(best)]]) if len(best) else np.zeros(1, np.int64)
                    out.append([{"first": int(s), "end": int(t), "lang": own.value.labels[best[s]], "score": float(p[a + s : a + t, best[s]].mean())} for s, t in zip(edge[:-1], edge[1:])])
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.array(out, shape)], names=["id", "spans"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, spans array<struct<first:long,end:long,lang:string,score:double>>").withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.1) -> DataFrame:
    """docs without those that are ``und`` or whose score lies less than ``least`` of the way from chance, one in the
    number of languages, to certainty; all columns as they were."""
    own = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)
    chance = 1 / max(1, len(model.labels))
    bar = chance + least * (1 - chance) - 1e-9

    def run(rows):
        for b in rows:
            names, scores = _summary(own.value, b.column(place))
            yield b.filter(pa.array((np.array(names, object) != UND) & (scores >= bar), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
