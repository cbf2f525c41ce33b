import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tilelake.llm import counts
from tilelake.llm.tokens import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
ODD = ["", None, "a", " \n\n x  y\t\n", "Don't 've''s I'LL 'tis it's's \"'s", "Öl ÄSS ß 東京 123½²  x", "<|endoftext|> x", "a<|endoftext|><|startoftext|>  b東 é<|endoftext|>'s", "<|ENDOFTEXT|>", "<|endoftext|", "é \U0001f600\U0001f600 ΣΑΣ İI Kelvin K", "x" * 5000, " " * 300 + "y", "é ạ̈ ́b", "a b c\u0085d", "...!!!'s -- 'd' 'x", "a\x00b\x1cc", "ſ'ſ", "ab" * 40 + "東" + "cd" * 40]


OWN, PLAIN = counts.Counter(PATH), Tokenizer.from_file(PATH)


def wanted(texts):
    return [len(e.ids) for e in PLAIN.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def table_of(texts, most=50):
    count, found = OWN, counts.Summary(most)
    count.summarised(texts, found)
    keys, size, _ = found.settle()
    return counts.Table(keys, size, np.array([count.encoded(k.astype("<u8").tobytes()[:n].decode("latin-1").encode()) for k, n in zip(keys, size.tolist())]))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_counts_equal_the_library(texts):
    texts = texts + ODD
    for OWN.table in (None, table_of(texts)):
        assert OWN(texts).tolist() == wanted(texts)


def test_every_latin_character():
    rng = np.random.default_rng(0)
    few = list("ab1'  \n\tSREVMLTDé\xa0!")
    texts = ["".join(map(chr, rng.integers(0, 256, 40))) for _ in range(400)] + [f"a{chr(c)}{chr(d)}b" for c in range(256) for d in (32, 39, 133, 160, 28, 65)] + ["".join(rng.choice(few, rng.integers(0, 12))) for _ in range(3000)]
    assert OWN(texts).tolist() == wanted(texts)


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(counts, "split_safely", lambda raw: __import__("tilelake.llm.tokens", fromlist=["x"]).split_safely(raw, 50))
    text = "It's a längeres Wort, 12 numbers; and   spaces\n" * 3_000
    assert OWN([text]).tolist() == wanted([text])


def test_table_holds_what_it_was_given():
    rng = np.random.default_rng(1)
    words = sorted({bytes(rng.integers(97, 123, rng.integers(1, 17)).astype(np.uint8)) for _ in range(3000)})
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    first = np.cumsum(size) - size
    keys = counts.keys_of(data, first, size)
    half = np.arange(len(words)) % 2 == 0
    table = counts.Table(keys[half], size[half], 1 + size[half] % 5)
    assert (table(keys, size) == np.where(half, 1 + size % 5, 0)).all()
    assert counts.Table(keys[:0], size[:0], size[:0])(keys, size).sum() == 0


def test_summary_keeps_the_frequent_in_bounded_space():
    rng = np.random.default_rng(2)
    stream = np.concatenate([np.repeat(np.arange(5), 2000), rng.integers(100, 10**6, 20_000)])
    rng.shuffle(stream)
    parts = []
    for x in np.array_split(stream, 7):
        s = counts.Summary(64)
        for y in np.array_split(x, 30):
            v, n = np.unique(y, return_counts=True)
            s.add(np.stack([v, v], axis=1).astype(np.uint64), np.full(len(v), 16), n)
            assert s.held <= 4 * 64 + len(v)
        parts.append(s)
    for s in parts[1:]:
        parts[0].add(*s.settle())
    keys, _, count = parts[0].settle()
    assert len(keys) <= 64 and set(range(5)) <= set(keys[:, 0].tolist()) and (count <= 2000).all()


@pytest.fixture
def docs(spark):
    rows = [(i % 7 if i != 3 else None, t, "x") for i, t in enumerate(ODD * 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counted(docs):
    found = counts.counted(docs.repartition(3), limit=20).collect()
    want = sorted((t or "", n, n > 20, len((t or "").encode())) for t, n in zip(ODD * 2, wanted(ODD * 2)))
    assert sorted((r.text or "", r.n_tokens, r.over_limit, r.n_bytes) for r in found) == want
    assert sorted(x or 0 for x in docs.toPandas().doc_id.fillna(0)) == sorted(r.doc_id or 0 for r in found)


def test_empty_and_one_table_for_several(spark, docs):
    assert counts.counted(docs.limit(0)).count() == 0
    table = counts.frequent(docs)
    assert [r.n_tokens for r in counts.counted(spark.createDataFrame([("It's nice",)], "t string"), "t", table=table).collect()] == wanted(["It's nice"])
