import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tilelake.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items):
    out = []
    split = [(i, WORD.findall(lower(t))) for i, t in items]
    for doc_id, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for item, v in split:
            n = min(10, len(v))
            for s in range(len(v) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[s : s + n]:
                        hit |= set(range(p, p + n))
                        if item is not None:
                            found.add(str(item))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "ß", "東京", "x1", "É"] + [f"w{i}" for i in range(rng.choice([4, 40, 400]))]
    text = lambda n: rng.choice([" ", ", ", "--"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 6, 9, 10, 11, 14, 30]))) for i in range(8)] + [(None, text(12)), (3, text(12)), (50, None)]
    items.append((77, items[5][1]))
    docs = [(i, text(rng.choice([0, 5, 40, 120]))) for i in range(12)]
    for i in range(16):
        a = WORD.findall(rng.choice(items)[1] or "")
        lo = rng.randrange(len(a) + 1)
        docs.append((100 + i, text(rng.choice([0, 3])) + " " + " ".join(a[lo : lo + rng.choice([9, 10, 12, 40])]).upper().replace("É", "É") + " " + text(rng.choice([0, 7]))))
    return docs + [(500, None), (501, ""), (502, "..."), docs[13], (None, docs[14][1])], items


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(spark, seed):
    docs, items = case(seed)
    df = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, first int")
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    want = brute(docs, items)
    for mb in ([32, 0.001] if seed < 2 else [32]):
        got = sorted((tuple(r) for r in d.report(df, bench, block_mb=mb).collect()), key=str)
        assert got == want
    if seed < 2:
        kept = sorted((r.doc_id for r in d.clean(df, bench, block_mb=0.001).collect()), key=str)
        assert kept == sorted((w[0] for w in want if not w[-1]), key=str)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:4] for r in d.report(df, none).collect()] == [(3, 0, 0)]
    assert d.report(df.limit(0), none).count() == 0


def test_every_shared_window_shares_a_fingerprint():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = (rng.integers(0, 30, 60).astype(np.uint64) for _ in range(2))
        b[20:30] = a[7:17]
        ka = set(d.winnowed(a, np.array([0, 60]))[1][d.winnowed(a, np.array([0, 60]))[0] >= 7])
        assert ka & set(d.winnowed(b, np.array([0, 60]))[1])


def test_hashes_do_not_depend_on_place():
    h, at = d.words(pa.array(["foo Bar", None, "bar", "", "x foo", "foobar"]))
    assert at.tolist() == [0, 2, 2, 3, 3, 5, 6]
    assert h[0] == h[4] and h[1] == h[2] and len(set(h.tolist())) == 4


def test_one_word_repeated_without_end():
    import time
    import tracemalloc

    block = d.Benchmark(["x", "y"], ["lorem " * 100, "other words of an item that is long enough to be looked for here"])
    h, at = d.words(pa.array(["lorem " * 180_000, "lorem " * 12 + "end"], pa.string()))
    tracemalloc.start()
    began = time.time()
    doc, item, first, end = block.hits(h, at)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6 and time.time() - began < 60
    assert set(item.tolist()) == {0} and d.covered(180_000, first[doc == 0], end[doc == 0]) == 180_000
    assert d.covered(13, first[doc == 1] - at[1], end[doc == 1] - at[1]) == 12


def test_pairs_in_small_parts(monkeypatch):
    monkeypatch.setattr(d, "PAIRS", 7)
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for i in range(30)]
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 30)))) for i in range(12)]
    block = d.Benchmark([i for i, _ in items], [t for _, t in items])
    h, at = d.words(pa.array([t for _, t in docs], pa.string()))
    small = set(zip(*(x.tolist() for x in block.hits(h, at))))
    monkeypatch.setattr(d, "PAIRS", 1 << 18)
    assert small == set(zip(*(x.tolist() for x in block.hits(h, at)))) and small
