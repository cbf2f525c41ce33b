import itertools

import numpy as np
import pyarrow as pa
import pytest

from tilelake.llm import ctw, langid


def brute_posteriors(e, moves, start):
    n, k = e.shape
    p = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        s = start[path[0]] + sum(e[t, path[t]] for t in range(n)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
        for t in range(n):
            p[t, path[t]] += np.exp(s)
    return p / p.sum(axis=1, keepdims=True)


def model(k, rng):
    return langid.Model([f"l{i}" for i in range(k)], None, np.zeros(0, np.uint64), None, None, rng.normal(size=(k, k)), rng.normal(size=k))


@pytest.mark.parametrize("chunk", [1, 2, 3, 256])
def test_forward_backward_against_all_paths(monkeypatch, chunk):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    m = model(3, rng)
    sizes = [0, 1, 2, 7, 0, 5, 6]
    at = np.concatenate([[0], np.cumsum(sizes)])
    e = rng.normal(size=(at[-1], 3)) * 2
    p = m.posteriors(e, at)
    for a, z in zip(at[:-1], at[1:]):
        if z > a:
            assert np.allclose(p[a:z], brute_posteriors(e[a:z], m.moves, m.start))


def test_gradients():
    rng = np.random.default_rng(0)
    e, moves, start = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    y = rng.integers(0, 3, (2, 4))
    like, ge, gm, gs = langid.expectations(e, moves, start, y)
    for x, g in ((e, ge), (moves, gm), (start, gs)):
        for i in np.ndindex(x.shape):
            x[i] += 1e-6
            up = langid.expectations(e, moves, start, y)[0]
            x[i] -= 1e-6
            assert abs((up - like) / 1e-6 - g[i]) < 1e-4


def corpus(rng, n):
    syllables = {"xx": ["ba", "ne", "to", "ri"], "yy": ["ok", "ul", "ez", "im"], "zz": ["é", "ña", "sto", "ke"]}
    return [(lang, " ".join("".join(rng.choice(s, rng.integers(1, 5))) for _ in range(60)) + ".") for lang, s in syllables.items() for _ in range(n)]


def test_learns_and_marks_switches(spark):
    rng = np.random.default_rng(1)
    train = corpus(rng, 20)
    m = langid.fitted([t for _, t in train], [v for v, _ in train], rounds=25)
    test = corpus(rng, 5)
    rows = [(i, t, None) for i, (_, t) in enumerate(test)]
    mix = test[0][1].replace(".", " ") + test[6][1]
    rows += [(100, mix, "x"), (101, None, "xx"), (102, "", "xx"), (103, "12 -- 3", "xx"), (104, "東京 ???", None), (105, test[1][1].upper(), None), (105, test[1][1].upper(), None), (None, test[1][1], None)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = langid.labelled(df, m).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == v for i, (v, _) in enumerate(test))
    assert [by[i].lang_pred for i in (101, 102, 103)] == ["und"] * 3 and by[101].score == 0
    assert by[105].lang_pred == "xx" and by[None].lang_pred == "xx" and by[104].lang_pred in m.labels
    found = {r.doc_id: r.spans for r in langid.spans(df, m).collect()}[100]
    assert [s.lang for s in found] == ["xx", "yy"] and abs(found[0].end - 60) <= 1 and found[-1].end == 120
    kept = langid.accepted(df, m)
    assert kept.columns == df.columns and {101, 102, 103}.isdisjoint(r.doc_id for r in kept.collect()) and kept.count() >= len(test) + 3
    whole, parts = m.label(pa.array([mix]))[0], m.label(pa.array(["a", mix, None]))
    assert np.allclose(whole, parts[0][parts[1][1] : parts[1][2]])


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    m = langid.fit(df, ~ctw.held_out("doc_id", 3, 1))
    assert [tuple(r) for r in langid.labelled(df, m).collect()] == [(1, "und", 0.0)]
    assert langid.labelled(df.limit(0), m).count() == 0 and langid.accepted(df, m).count() == 0
    assert [r.spans for r in langid.spans(df, m).collect()] == [[]]


def test_all_bytes_of_a_word_count():
    stem = "ab" * 16
    train = [(f"{stem}{end}{i % 7}" + " " + f"{stem}{end}", lang) for i in range(40) for end, lang in (("quxquv", "xx"), ("jizjoz", "yy"))]
    m = langid.fitted([t for t, _ in train], [v for _, v in train], rounds=25)
    names, scores = langid._summary(m, pa.array([f"{stem}mequxquvle", f"{stem}mejizjozle", "東京" * 40 + "quxquv " * 3]))
    assert names == ["xx", "yy", "xx"] and min(scores) > 0.5


def test_long_runs_are_cut_between_characters_and_lose_nothing():
    texts = ["東" * 100, "a" * 48, "a" * 49, "éa" * 500 + ", “b” c", "", None, "x"]
    data, first, last, _, at = langid.words(pa.array(texts))
    found = [[data[a:z].tobytes().decode() for a, z in zip(first[i:j], last[i:j])] for i, j in zip(at[:-1], at[1:])]
    assert ["".join(f) for f in found] == ["東" * 100, "a" * 48, "a" * 49, "éa" * 500 + "bc", "", "", "x"]
    assert max(len(w.encode()) for f in found for w in f) <= 51 and found[1] == ["a" * 48] and found[3][-2:] == ["b", "c"]


def test_sample_takes_each_text_once(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(langid, "fitted", lambda texts, langs: seen.update(texts=texts, langs=langs))
    rows = [(i, "copied text", "xx") for i in range(300)] + [(1000 + i, f"text {i} of its own", "xx") for i in range(60)] + [(2000, "long " * 20_000, "yy"), (None, "no id", "yy")]
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), ~ctw.held_out("doc_id", 3, 5), per_language=40)
    assert seen["langs"].count("xx") == 40 and len(set(seen["texts"])) == len(seen["texts"]) == 42
    assert max(map(len, seen["texts"])) == langid.LONGEST


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = ctw.held_out("doc_id", 3, 1)
    m = langid.fit(docs, ~held)
    found = langid.labelled(docs, m).join(docs.where(held).select("doc_id", "lang"), "doc_id").where("lang is not null and lang_pred <> 'und'").collect()
    assert len(found) > 250 and sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
