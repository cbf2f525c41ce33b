"""Tokenising by the tokenizers library, whole texts, each distinct pre-token encoded once.

A byte-level BPE never merges across pre-tokens, so the ids of a text are those of its pre-tokens in order. Most
pre-tokens repeat; a worker keeps those it has met (up to ``KEEP``, then it starts anew), encodes the others in one
batch and gathers the ids with numpy. Texts of Latin-1 characters are cut into pre-tokens by numpy too, others by the
tokeniser's pattern. Strings that spell one of the file's added tokens get its id, as the library does it.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd

from .common import mixed

#: Classes of Latin-1 characters in the pre-tokeniser's pattern: white space, letters, numbers, others.
SPACE, LETTER, NUMBER, OTHER = range(4)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = SPACE
CLASS[[i for i in range(256) if chr(i).isalpha()]] = LETTER
CLASS[[i for i in range(256) if chr(i).isnumeric()]] = NUMBER
#: Pre-tokens a worker keeps, pre-tokens gathered at a time, and characters of texts encoded together; they bound a worker's memory.
KEEP, AT_A_TIME, GROUP = 1 << 18, 1 << 17, 1 << 18


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Numbers(dict):
    """Numbers what it is asked for in the order of first mention."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self.fresh.append(key)
        self[key] = n = len(self)
        return n


class Encoder:
    """Encodes texts by one tokenizer file whose pre-tokeniser is the byte-level one."""

    def __init__(self, path: str, end_id: int | None = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        kind = json.loads(Tokenizer.from_file(path).to_str())
        if kind["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or kind["normalizer"]:
            raise ValueError("a byte-level pre-tokeniser without a normaliser is needed")
        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        added = {t["content"]: t for t in kind["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added.values()):
            raise ValueError("added tokens must stand for their own characters only")
        self.added = {c: np.array([t["id"]], np.uint32) for c, t in added.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet: these bytes stand for themselves
        rest = [i for i in range(256) if i not in plain]
        self.alphabet = dict(zip(plain, plain)) | {b: 256 + i for i, b in enumerate(rest)}
        self.vocab = self.tokenizer.get_vocab_size()
        self._forget()

    def _forget(self) -> None:
        self.known = Numbers()
        self.ids, self.begin, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, fresh: list[str]) -> None:
        """Encodes pre-tokens by the library's model, in the characters that stand for bytes, and keeps their ids."""
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(self.alphabet))] for p in fresh]
        count = np.fromiter(map(len, found), np.int64, len(found))
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum()))])

    def _gather(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, end to end, and the number of each."""
        if len(self.known) > KEEP:
            self._forget()
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if self.known.fresh:
            self._learn(self.known.fresh)
            self.known.fresh = []
        n = self.count[at]
        ends = np.cumsum(n)
        return self.ids[np.arange(ends[-1]) + np.repeat(self.begin[at] - (ends - n), n)], n

    def _slow(self, text: str) -> np.ndarray:
        """Ids of a text with other than Latin-1 characters, by the pattern itself."""
        out, pieces = [], (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(pieces, AT_A_TIME)):
            out.append(self._gather(part)[0])
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def _fast(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each of some Latin-1 texts, found together by numpy."""
        raw = b"".join(texts)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        data = np.frombuffer(raw, np.uint8)
        first = piece_starts(data, off)
        size = np.diff(first, append=len(data))
        codes, one = same_pieces(data, first, size)
        distinct = [raw[a:z].decode("latin-1") for a, z in zip(first[one].tolist(), (first[one] + size[one]).tolist())]
        ids, n = self._gather(distinct) if distinct else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        begin = np.cumsum(n) - n
        count = n[codes]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        flat = ids[np.arange(total) + np.repeat(begin[codes] - (ends - count), count)]
        cut = np.concatenate([[0], ends])[np.searchsorted(first, off)]
        return [flat[a:z] for a, z in zip(cut[:-1], cut[1:])]

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a few texts, each with the end id, end to end; len + 1 offsets. None counts as empty."""
        found: list = [[] for _ in texts]
        fast, where = [], []
        for i, t in enumerate(texts):
            for part in self.cut.split(t) if t and any(c in t for c in self.added) else [t or ""]:
                if part in self.added:
                    found[i].append(self.added[part])
                    continue
                try:
                    parts = split_safely(part.encode("latin-1"))
                    where += [(i, len(found[i]) + j) for j in range(len(parts))]
                    fast += parts
                    found[i] += [None] * len(parts)
                except UnicodeEncodeError:
                    found[i].append(self._slow(part))
        for lo, hi in groups(fast):
            for (i, j), ids in zip(where[lo:hi], self._fast(fast[lo:hi])):
                found[i][j] = ids
        end = [] if self.end_id is None else [np.array([self.end_id], np.uint32)]
        sizes = [sum(map(len, f)) + len(end) for f in found]
        ids = [x for f in found for x in (*f, *end)]
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int | None = 0) -> Encoder:
    """The encoder of this Python worker, which keeps what it has learned from one task to the next."""
    return Encoder(path, end_id)


def split_safely(text: bytes, most: int = 1 << 22) -> list[bytes]:
    """A long text in parts, cut at white space after something else, where a pre-token begins whatever comes before."""
    parts = []
    while len(text) > most:
        tail = np.frombuffer(text, np.uint8)[: 2 * most]
        space = CLASS[tail] == SPACE
        at = np.flatnonzero(space[most:] & ~space[most - 1 : -1])
        if not len(at):
            break
        parts.append(text[: most + int(at[0])])
        text = text[most + int(at[0]) :]
    return [*parts, text]


def piece_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of Latin-1 texts begin; texts lie end to end and each pre-token ends where the next begins."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = np.full(n + 2, SPACE, np.uint8)
    kind[1:-1] = CLASS[data]
    here, before, after = kind[1:-1], kind[:-2], kind[2:]
    opens = np.zeros(n + 1, bool)
    opens[off] = True
    last = opens[1:]  # the last character of a text
    opens = opens[:-1]
    space = here == SPACE
    blank_before = np.zeros(n, bool)
    blank_before[1:] = data[:-1] == 32
    start = np.where(space, (before != SPACE) | ((after != SPACE) & ~last), (here != before) & ~blank_before) | opens
    quote = np.flatnonzero(start & (data == 39))
    if len(quote):  # 's 't 're 've 'm 'll 'd
        ahead = np.concatenate([data, np.zeros(2, np.uint8)])
        bound = off[np.searchsorted(off, quote, "right")]
        c, d = ahead[quote + 1], ahead[quote + 2]
        two = np.isin(c, np.frombuffer(b"stmd", np.uint8)) & (quote + 2 <= bound)
        three = (((c == 114) | (c == 118)) & (d == 101) | (c == 108) & (d == 108)) & (quote + 3 <= bound)
        for i, size in ((quote[two], 2), (quote[three], 3)):
            start[i + 1] = False
            i = i[i + size < n]
            start[i + size] = True
    return np.flatnonzero(start)


def same_pieces(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers pieces so that equal ones share a number; also one place of each. Compared by their bytes, 8 at a time."""
    n = len(first)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.concatenate([data, np.zeros(32, np.uint8)])
    words = np.ndarray((len(data) + 24,), "<u8", padded, strides=(1,))
    mask = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)
    short = size <= 32
    at, length = first[short], size[short]
    keys = [words[at] & mask[np.minimum(length, 8)], words[np.minimum(at + 8, len(words) - 1)] & mask[np.clip(length - 8, 0, 8)]]
    h = mixed(keys[0] + mixed(keys[1] + length.astype(np.uint64)))
    more = np.flatnonzero(length > 16)
    if len(more):
        rest = [words[at[more] + d] & mask[np.clip(length[more] - d, 0, 8)] for d in (16, 24)]
        keys += [np.zeros(len(at), np.uint64) for _ in rest]
        for k, r in zip(keys[2:], rest):
            k[more] = r
        h[more] = mixed(h[more] + mixed(rest[0] + mixed(rest[1])))
    codes_short, distinct = pd.factorize(h)
    one_short = np.empty(len(distinct), np.int64)
    one_short[codes_short[::-1]] = np.arange(len(at))[::-1]
    same = length == length[one_short][codes_short]
    for k in keys:
        same &= k == k[one_short][codes_short]
    numbers = Numbers()  # the long ones, and those whose hash another one has
    odd = np.concatenate([np.flatnonzero(~short), np.flatnonzero(short)[~same]])
    raw = data.tobytes() if len(odd) else b""
    numbered = [numbers[raw[a : a + z]] for a, z in zip(first[odd].tolist(), size[odd].tolist())]
    codes = np.empty(n, np.int64)
    codes[short] = codes_short
    codes[odd] = len(distinct) + np.array(numbered, np.int64)
    one_odd = np.empty(len(numbers), np.int64)
    one_odd[numbered[::-1]] = odd[::-1]
    return codes, np.concatenate([np.flatnonzero(short)[one_short], one_odd])


def groups(texts: list, most: int = GROUP):
    """Slices of a list of texts of about ``most`` characters or one text."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
