"""Token counts of whole texts by a word-wise BPE, from lengths of pre-tokens looked up in two tiers on the map side.

The tokeniser never merges across pre-tokens, so a text's count is the sum of its pre-tokens' lengths. Most of these are
frequent ones: a first pass counts pre-tokens in every task into a summary of bounded size (Misra and Gries), summaries
are merged in a tree, and the ``FREQUENT`` most frequent with their lengths make a hash table of fixed size that is
broadcast. The counting pass probes it with numpy; what it does not hold is looked up in a cache of the worker, and
what is not there either is encoded by the library. No pre-token is shuffled, and the table decides about speed alone:
counts are the library's whatever it holds.

Parts of a text without ASCII space that are Latin-1 are cut into pre-tokens by numpy, after the normaliser's lower case;
others go to the library's own normaliser and pre-tokeniser. Strings that spell an added token count as one token, as
the library has it.

Memory: the table has 2 ``FREQUENT`` places of 18 bytes, a summary at most ``FREQUENT`` words of 16 bytes, a worker's
cache ``KEEP`` words; a long text is worked through in parts that end at white space, a part without white space whole.

Defined cases: a null or empty text has no bytes and no tokens; repeated rows are counted each; null ids and other
columns stay as they are (n_bytes, n_tokens and over_limit are new columns in the place of any of these names); an
empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import pickle
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mixed, slices
from .tokens import CLASS, GROUP, LETTER, NUMBER, SPACE, groups, same_pieces, split_safely, tokenizer_path

#: Words of the broadcast table and of a summary, words a worker keeps, and the longest word in bytes that the table holds.
FREQUENT, KEEP, SHORT = 1 << 15, 1 << 18, 16
LIMIT = 2048
#: Lower case of Latin-1 characters.
LOWER = np.array([ord(chr(i).lower()) for i in range(256)], np.uint8)
#: Fixed value: the pre-tokeniser's pattern that ``word_bounds`` follows.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and size of the pre-tokens of lower-case Latin-1 texts that lie end to end."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = CLASS[data]
    opens = np.zeros(n + 1, bool)
    opens[off] = True
    before = np.full(n, SPACE, np.uint8)
    before[1:] = kind[:-1]
    before[opens[:n]] = SPACE
    start = (kind != SPACE) & ((kind != before) | (kind == NUMBER))
    quote = np.flatnonzero(start & (data == 39))
    tail = np.zeros(0, np.int64)
    if len(quote):  # a quotation mark that begins a pre-token takes what follows it
        ahead = np.concatenate([data, np.zeros(2, np.uint8)])
        bound = off[np.searchsorted(off, quote, "right")]
        c, d = ahead[quote + 1], ahead[quote + 2]
        two = np.isin(c, np.frombuffer(b"stmd", np.uint8)) & (quote + 2 <= bound)
        three = (((c == 114) | (c == 118)) & (d == 101) | (c == 108) & (d == 108)) & (quote + 3 <= bound)
        start[quote[two | three] + 1] = False
        tail = np.concatenate([quote[two] + 2, quote[three] + 3])
        tail = tail[(tail < n) & ~opens[np.minimum(tail, n)]]
        start[tail[kind[tail] == LETTER]] = True
    first = np.flatnonzero(start)
    stop = start | (kind == SPACE) | opens[:n]
    ends = np.append(np.flatnonzero(stop), n)
    size = ends[np.searchsorted(ends, first, "right")] - first
    return first, size


def keys_of(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of short words as two numbers each; with the length they stand for the word."""
    padded = np.concatenate([data, np.zeros(SHORT + 8, np.uint8)])
    words = np.ndarray((len(data) + SHORT,), "<u8", padded, strides=(1,))
    mask = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)
    return np.stack([words[first] & mask[np.minimum(size, 8)], words[first + 8] & mask[np.clip(size - 8, 0, 8)]], axis=1)


def _slot(keys: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mixed(keys[:, 0] + mixed(keys[:, 1] + size.astype(np.uint64)))


class Table:
    """An open hash table of short words and their numbers of tokens, probed by whole arrays."""

    def __init__(self, keys: np.ndarray, size: np.ndarray, count: np.ndarray):
        self.places = 1 << max(4, (2 * len(keys) - 1).bit_length())
        self.keys, self.size, self.count = np.zeros((self.places, 2), np.uint64), np.zeros(self.places, np.uint8), np.zeros(self.places, np.uint8)
        at, todo, self.steps = (_slot(keys, size) % np.uint64(self.places)).astype(np.int64), np.arange(len(keys)), 0
        while len(todo):
            self.steps += 1
            free = todo[self.size[at[todo]] == 0]
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.keys[at[put]], self.size[at[put]], self.count[at[put]] = keys[put], size[put], count[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            at[todo] = (at[todo] + 1) % self.places

    def __call__(self, keys: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of each word, 0 where the table has none."""
        out = np.zeros(len(keys), np.int64)
        at, todo = (_slot(keys, size) % np.uint64(self.places)).astype(np.int64), np.arange(len(keys))
        for _ in range(self.steps):
            if not len(todo):
                break
            here = at[todo]
            same = (self.size[here] == size[todo]) & (self.keys[here] == keys[todo]).all(axis=1)
            out[todo[same]] = self.count[here[same]]
            todo = todo[~same & (self.size[here] != 0)]
            at[todo] = (at[todo] + 1) % self.places
        return out


class Summary:
    """Counts of short words in bounded space: what falls out lowers all others by as much (Misra and Gries)."""

    def __init__(self, most: int = FREQUENT):
        self.most, self.parts, self.held = most, [], 0

    def add(self, keys: np.ndarray, size: np.ndarray, count: np.ndarray) -> Summary:
        self.parts.append((keys, size, count))
        self.held += len(size)
        if self.held > 4 * self.most:
            self.settle()
        return self

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.parts:
            keys, size, count = (np.concatenate(x) for x in zip(*self.parts))
            t = pd.DataFrame({"a": keys[:, 0], "b": keys[:, 1], "s": size, "c": count}).groupby(["a", "b", "s"], sort=False)["c"].sum().reset_index()
            if len(t) > self.most:
                t = t.sort_values(["c", "a", "b", "s"], ascending=[False, True, True, True])
                over = int(t["c"].iloc[self.most])
                t = t.head(self.most).assign(c=lambda x: x["c"] - over)
                t = t[t["c"] > 0]
            self.parts = [(t[["a", "b"]].to_numpy(np.uint64), t["s"].to_numpy(np.int64), t["c"].to_numpy(np.int64))]
            self.held = len(t)
        return self.parts[0] if self.parts else (np.zeros((0, 2), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


class Counter:
    """Counts tokens by one tokenizer file of words in lower case with word ends."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Regex, Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        normal = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
        split = {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True}
        if kind["normalizer"] != normal or kind["pre_tokenizer"]["pretokenizers"][0] != split or kind["pre_tokenizer"]["pretokenizers"][1]["type"] != "ByteLevel":
            raise ValueError("a tokeniser of words in lower case is needed")
        added = {t["content"]: t for t in kind["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added.values()):
            raise ValueError("added tokens must stand for their own characters only")
        self.added = set(added)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet: these bytes stand for themselves
        self.alphabet = dict(zip(plain, plain)) | {b: 256 + i for i, b in enumerate(i for i in range(256) if i not in plain)}
        self.split = Split(Regex(PATTERN), behavior="removed", invert=True)
        self.known: dict[bytes, int] = {}
        self.table: Table | None = None

    def encoded(self, word: bytes) -> int:
        """Tokens of a pre-token in UTF-8, by the library's model."""
        return len(self.tokenizer.model.tokenize(word.decode("latin-1").translate(self.alphabet)))

    def _cached(self, word: bytes) -> int:
        n = self.known.get(word)
        if n is None:
            n = self.encoded(word)
            if len(self.known) >= KEEP:
                self.known.clear()
            if len(word) <= 256:
                self.known[word] = n
        return n

    def _odd(self, text: str) -> int:
        """Tokens of a text by the library's own steps before the model."""
        return sum(self._cached(p.encode()) for p, _ in self.split.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text)))

    def _parted(self, texts: list) -> tuple[list[bytes], list[int], list[int], list[tuple[int, str]]]:
        """Latin-1 parts with their texts' numbers, added tokens in each text, other parts with their texts' numbers."""
        fast, of, added, odd = [], [], [0] * len(texts), []
        for i, text in enumerate(texts):
            for part in self.cut.split(text) if self.cut and text and any(c in text for c in self.added) else [text or ""]:
                if part in self.added:
                    added[i] += 1
                    continue
                try:
                    raw = part.encode("latin-1")
                except UnicodeEncodeError:
                    words = part.split(" ")
                    odd += [(i, w) for w in words if w and max(w) > "\xff"]
                    raw = " ".join(w for w in words if w and max(w) <= "\xff").encode("latin-1")
                cut = split_safely(raw) if len(raw) > 1 << 22 else [raw]
                fast += cut
                of += [i] * len(cut)
        return fast, of, added, odd

    def _words(self, texts: list[bytes]):
        """Distinct pre-tokens of Latin-1 texts: their bytes, bounds, and the number of each pre-token; bounds of texts among these."""
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        data = LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        first, size = word_bounds(data, off)
        codes, one = same_pieces(data, first, size)
        return data, first[one], size[one], codes, np.searchsorted(first, off)

    def summarised(self, texts: list, into: Summary) -> None:
        fast, _, _, _ = self._parted(texts)
        for lo, hi in groups(fast):
            data, first, size, codes, _ = self._words(fast[lo:hi])
            short = size <= SHORT
            into.add(keys_of(data, first[short], size[short]), size[short], np.bincount(codes, minlength=len(size))[short])

    def __call__(self, texts: list) -> np.ndarray:
        """Tokens of each text; None counts as empty."""
        fast, of, added, odd = self._parted(texts)
        out = np.array(added, np.int64)
        for i, part in odd:
            out[i] += self._odd(part)
        for lo, hi in groups(fast):
            data, first, size, codes, bounds = self._words(fast[lo:hi])
            n = np.zeros(len(first), np.int64)
            if self.table is not None and len(first):
                short = size <= SHORT
                n[short] = self.table(keys_of(data, first[short], size[short]), size[short])
            raw, missed = data.tobytes(), np.flatnonzero(n == 0)
            n[missed] = [self._cached(w if w.isascii() else w.decode("latin-1").encode()) for w in (raw[a : a + z] for a, z in zip(first[missed].tolist(), size[missed].tolist()))]
            sums = np.concatenate([[0], np.cumsum(n[codes])])
            np.add.at(out, of[lo:hi], sums[bounds[1:]] - sums[bounds[:-1]])
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """The counter of this Python worker, whose cache lasts from one task to the next."""
    return Counter(path)


def frequent(docs: DataFrame, text_col: str = "text", path: str | None = None, most: int = FREQUENT) -> Table:
    """The table of the most frequent short pre-tokens of all texts."""
    path = path or tokenizer_path("word_bpe_49k.json")

    def run(batches):
        count, found = counter(path), Summary(most)
        for b in batches:
            col = b.column(0)
            for lo, hi in slices(col, GROUP):
                count.summarised(col.slice(lo, hi - lo).to_pylist(), found)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found.settle())], pa.binary())], names=["part"])

    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "part binary").rdd
    keys, size, _ = parts.treeAggregate(Summary(most), lambda s, r: s.add(*pickle.loads(r[0])), lambda a, b: a.add(*b.settle()), 2).settle()
    own = counter(path)
    words = [k.astype("<u8").tobytes()[:n].decode("latin-1").encode() for k, n in zip(keys, size.tolist())]
    return Table(keys, size, np.array([own.encoded(w) for w in words], np.int64))


def counted(docs: DataFrame, text_col: str = "text", path: str | None = None, limit: int = LIMIT, table: Table | None = None) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit; the table is fitted to docs unless one is given."""
    path = path or tokenizer_path("word_bpe_49k.json")
    held = docs.sparkSession.sparkContext.broadcast(table or frequent(docs, text_col, path))

    @F.arrow_udf("long")
    def tokens(text: pa.Array) -> pa.Array:
        count = counter(path)
        count.table = held.value
        out = np.zeros(len(text), np.int64)
        for lo, hi in slices(text, GROUP):
            out[lo:hi] = count(text.slice(lo, hi - lo).to_pylist())
        return pa.array(out)

    text = F.col(text_col).cast("string")
    return docs.withColumns({"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "n_tokens": tokens(text)}).withColumn("over_limit", F.col("n_tokens") > limit)
