import math
import random
import zlib

import numpy as np
import pytest

from tilelake.llm import ctw


def tokens(text):
    return (text or "").encode().translate(bytes(ctw.LOWER)).split()  # bytes.split: the same six white-space bytes


def kt(n0, n1):
    """log of the product that adds the ones after the zeros, one at a time."""
    out = 0.0
    for i in range(n0):
        out += math.log((i + 0.5) / (i + 1))
    for i in range(n1):
        out += math.log((i + 0.5) / (n0 + i + 1))
    return out


class Tree:
    """The whole context tree in dictionaries: a node is (depth's last bytes, bits of the byte so far)."""

    def __init__(self, texts, depth):
        self.depth, self.n, self.below = depth, {}, {}
        for t in texts:
            for past, prefix, bit in self.decisions(t):
                for d in range(depth + 1):
                    node = (past[depth - d :], prefix)
                    self.n.setdefault(node, [0, 0])[bit] += 1
                    if d < depth:
                        self.below.setdefault(node, set()).add((past[depth - d - 1 :], prefix))
        self.log = {}

    def decisions(self, text):
        s = b"\n" * self.depth + b" ".join(tokens(text)) + b"\n"
        for i in range(self.depth, len(s)):
            bits = f"{s[i]:08b}"
            for j in range(8):
                yield s[i - self.depth : i], bits[:j], int(bits[j])

    def weighted(self, node):
        if node not in self.log:
            own = kt(*self.n[node])
            self.log[node] = own if len(node[0]) == self.depth else np.logaddexp(own, self.children(node)) - math.log(2)
        return self.log[node]

    def children(self, node):
        return sum(map(self.weighted, self.below[node]))

    def probability(self, past, prefix, bit, d=0):
        node = (past[self.depth - d :], prefix)
        if node not in self.n:
            return 0.5
        n = self.n[node]
        own = (n[bit] + 0.5) / (sum(n) + 1)
        if d == self.depth:
            return own
        w = 1 / (1 + math.exp(min(700, self.children(node) - kt(*n))))
        return w * own + (1 - w) * self.probability(past, prefix, bit, d + 1)

    def score(self, text):
        return sum(math.log10(self.probability(*x)) for x in self.decisions(text))


def brute(rows, depth):
    train = [t for i, t, on in rows if on]
    count, ends = {}, len(train)
    for t in train:
        for w in tokens(t):
            count[w] = count.get(w, 0) + 1
    total, distinct = sum(count.values()) + ends, len(count) + (ends > 0)
    tree, out = Tree(train, depth), []
    for i, t, on in rows:
        c = [count.get(w, 0) for w in tokens(t)] + [ends]
        base = sum(math.log10((x + 0.1) / (total + 0.1 * (distinct + 1))) for x in c)
        out.append((i, on, len(c), sum(x > 0 for x in c), total, base, tree.score(t)))
    return out


def same(got, want):
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[2], r[5])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], abs=1e-9) and g[6] == pytest.approx(w[6], rel=1e-5, abs=1e-6)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, on, 0.5, 1) for i, t, on in rows], "doc_id long, text string, training boolean, score double, block int")
    found = ctw.scores(df, df.training, **kw).collect()
    assert all(r.bits_per_byte >= 0 and r.n_bytes >= 1 for r in found)
    return [tuple(r)[:7] for r in found]


WORDS = ["the", "then", "Tea", "a", "of", "öl", "東京", "x" * 9, "on.", "\x0bq"]


@pytest.mark.parametrize("depth,block_mb", [(3, 20), (6, 20), (7, 20), (6, 0.0002)])
def test_against_a_plain_tree(spark, depth, block_mb):
    rng = random.Random(depth)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(14))), rng.random() < 0.7) for i in range(40)]
    rows += [(100, None, True), (101, "", False), (102, " \t\n", True), (103, rows[0][1], True), (103, rows[0][1], True), (None, "the tea of öl", False), (None, None, False), (104, "unseen WORDS only", False)]
    same(run(spark, rows, depth=depth, block_mb=block_mb), brute(rows, depth))


def test_no_training_rows(spark):
    got = run(spark, [(1, "ab", False), (2, None, False)])
    assert [(r[0], r[2], r[3], r[4]) for r in sorted(got)] == [(1, 2, 0, 0), (2, 1, 0, 0)]
    assert sorted(got)[0][6] == pytest.approx(24 * math.log10(0.5))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ctw.scores(df, ~ctw.held_out("doc_id", 10, 0)).count() == 0


def test_probabilities_of_a_byte_add_up_to_one(spark):
    rows = [(0, "abc abd abe ab", True)] + [(1 + b, "ab" + chr(b), False) for b in range(97, 123)]
    scores = {r[0] - 1: r[6] for r in run(spark, rows)}
    tree = Tree(["abc abd abe ab"], 6)
    past = b"\n\n\n\nab"
    total = 0.0
    for b in range(256):
        p = 1.0
        for j in range(8):
            p *= tree.probability(past, f"{b:08b}"[:j], int(f"{b:08b}"[j]))
        total += p
    assert total == pytest.approx(1)
    assert scores[ord("c")] > scores[ord("z")]


def test_long_text_is_whole(spark):
    text = "some words of a long text " * 60_000
    got = run(spark, [(1, text, True), (2, text + "tail", False), (3, "q", False)])
    by = {r[0]: r for r in got}
    assert by[1][2] == 360_001 and by[2][2] == 360_002 and by[2][6] < by[1][6]


def test_held_out(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    got = {r.doc_id: r.h for r in df.select("doc_id", ctw.held_out("doc_id", 10, 0).alias("h")).collect()}
    assert got.pop(None) is False and all(v == (zlib.crc32(str(i).encode()) % 10 == 0) for i, v in got.items())
