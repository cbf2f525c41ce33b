import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tilelake.llm import bitpack, packing, tokens
from tilelake.llm.tokens import Encoder, tokenizer_path

ODD = ["", None, "a", " \n\n x  y\t\n", "don't 've''s", "Öl äß 東京 123  x", "<|endoftext|> x", "a  <|endoftext|><|endoftext|>  b東 é<|endoftext|>'s", "<|endoftext|", "é \U0001f600\U0001f600", "x" * 5000, " " * 300 + "y", "a\r\n\r\nb   \n  c"]


def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_encoder_equals_the_library(texts):
    texts = texts + ODD
    ids, off = Encoder(tokenizer_path())(texts)
    want = [e.ids + [0] for e in plain().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == want


def test_encoder_on_every_latin_character():
    rng = np.random.default_rng(0)
    texts = ["".join(map(chr, rng.integers(0, 256, 40))) for _ in range(400)] + [f"a{chr(c)}{chr(d)} b" for c in range(256) for d in (32, 39, 133, 160, 28, 65)]
    ids, off = Encoder(tokenizer_path())(texts)
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [e.ids + [0] for e in plain().encode_batch(texts, add_special_tokens=False)]


def test_pieces_against_the_pattern():
    import public_tokenizers
    import regex

    rng = np.random.default_rng(5)
    pattern = regex.compile(public_tokenizers.PATTERN)
    few = "ab1'  \n\t.!srevmltd\xa0é"
    texts = ["".join(rng.choice(list(few), rng.integers(0, 12))) for _ in range(5000)] + ["'s", "x's", " 's", "'street", "'ll've", "''d", "\n's", "a'", "'r", "'re"]
    raw = [t.encode("latin-1") for t in texts]
    off = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    first = tokens.piece_starts(data, off)
    want = [int(o) + m.start() for t, o in zip(texts, off) for m in pattern.finditer(t)]
    assert first.tolist() == want
    size = np.diff(first, append=len(data))
    codes, one = tokens.same_pieces(data, first, size)
    pieces = [bytes(data[a : a + z]) for a, z in zip(first, size)]
    assert [pieces[one[c]] for c in codes] == pieces and len(set(pieces)) == len(one)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(tokens, "mixed", lambda x: x & np.uint64(7))
    text = " ".join(f"w{i}" + "y" * (i % 50) for i in range(300))
    assert Encoder(tokenizer_path())([text])[0].tolist() == plain().encode(text, add_special_tokens=False).ids + [0]


def test_encoder_on_long_texts(monkeypatch):
    monkeypatch.setattr(tokens, "AT_A_TIME", 50)
    monkeypatch.setattr(tokens, "KEEP", 60)
    monkeypatch.setattr(tokens.split_safely, "__defaults__", (100,))
    for odd in ("", "\u4e00"):
        text = odd + " ".join(f"word{i % 97} x{i}\n\n" for i in range(500)) + "z" * 500
        ids, off = Encoder(tokenizer_path())([text, "a b", text])
        one = plain().encode(text, add_special_tokens=False).ids + [0]
        assert ids[off[0] : off[1]].tolist() == one and ids[off[2] : off[3]].tolist() == one


@pytest.mark.parametrize("width", [1, 7, 8, 13, 16, 17, 32])
def test_bits_round_trip(width):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 1 << width, 1001).astype(np.uint32)
    data = bitpack.pack(ids, width)
    assert len(data) == -(-1001 * width // 8) and (bitpack.unpack(data, 1001, width) == ids).all()
    w = bitpack.Writer(width, block=64)
    w.add(np.array([3, 5]), ids[:700], np.array([0, 100, 700]))
    w.add(np.array([9]), ids[700:], np.array([0, 301]))
    r = bitpack.Reader(io.BytesIO(w.finish()[0]))
    assert (r.ids(130, 135) == ids[130:135]).all() and (r.doc(1) == ids[100:700]).all() and (r.doc(2) == ids[700:]).all()
    if width < 32:
        with pytest.raises(ValueError):
            bitpack.pack(np.array([1 << width], np.uint32), width)


def rows(spark):
    data = [(i * 7 % 31, t, "z") for i, t in enumerate(ODD + ["word " * n for n in (1000, 2047, 2048, 5000)])]
    data += [data[3], (None, "null id", "z")]
    return spark.createDataFrame(data, "doc_id long, text string, start string")


def test_bitpack_round_trip_in_spark(spark):
    df, t = rows(spark), plain()
    got = bitpack.read(bitpack.write(df, shard_mb=0.005), with_ids=True).collect()
    assert bitpack.write(df, shard_mb=0.005).count() > 1
    at = 0
    order = sorted(((r.doc_id is not None, r.doc_id or 0), t.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in df.collect())
    assert sorted((r.start, r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((sum(len(x) for _, x in order[:i]), *order[i][0]) for i in range(len(order)))
    for (key, _), r in zip(order, sorted(got, key=lambda r: r.start)):
        assert (r.doc_id is not None, r.doc_id or 0) == key and r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert sorted(tuple(r.ids) for r in got) == sorted(tuple(x) for _, x in order)
    assert bitpack.read(bitpack.write(df.limit(0))).count() == 0


def test_packing_holds_every_piece_once(spark):
    df, t = rows(spark), plain()
    got = packing.packed(df, capacity=64, shard=7).collect()
    want = []
    for r in df.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [0]
        cuts = packing.cut(len(ids), 64)
        assert cuts[0][0] == 0 and sum(n for _, n in cuts) == len(ids) and all(n == 64 for _, n in cuts[1:])
        want += [(str(r.doc_id), k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cuts)]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 64
    assert packing.packed(df.limit(0)).count() == 0


def brute_sum_of_squares(sizes, capacity):
    """Levels of open bins by the rule, trying every bin."""
    bins = []
    for s in sorted(sizes, reverse=True):
        def cost(levels):
            n = {}
            for g in levels:
                if 0 < g < capacity:
                    n[g] = n.get(g, 0) + 1
            return sum(v * v for v in n.values())

        tries = [(cost(bins[:i] + [g - s] + bins[i + 1 :]), 0, g - s, i) for i, g in enumerate(bins) if g >= s]
        if tries:
            bins[min(tries)[3]] -= s
        else:
            bins.append(capacity - s)
    return sorted(bins)


def test_sum_of_squares_against_brute_force():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 80):
        sizes = rng.integers(1, 33, n)
        bins, places = packing.sum_of_squares(sizes, 32)
        full = np.bincount(bins, sizes).astype(int) if n else np.zeros(0, int)
        assert sorted(32 - full) == brute_sum_of_squares(sizes.tolist(), 32)
        assert full.max(initial=0) <= 32


def test_density():
    rng = np.random.default_rng(4)
    sizes = np.minimum(2047, rng.lognormal(6, 1, 5000).astype(int) + 1)
    bins, _ = packing.sum_of_squares(sizes)
    assert bins.max() + 1 <= 1.01 * -(-sizes.sum() // 2048)
