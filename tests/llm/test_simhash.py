import random

from tilelake.llm import simhash


def brute(rows):
    fps = [simhash.fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    out = {}
    for i, (d, _) in enumerate(rows):
        out.setdefault(find(i), []).append(d)
    return {rows[i][0]: (f"{fps[i]:016x}", min(out[find(i)])) for i in range(len(rows))}


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 30, 200]))]
        rows.append((len(rows), " ".join(text)))
        for _ in range(rng.choice([0, 0, 1, 4])):
            again = list(text)
            if again:
                again[rng.randrange(len(again))] = rng.choice(words)
            rows.append((len(rows), "  ".join(again).upper()))
    rows += [(1000, None), (1001, ""), (1002, " \t\n")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fp string, id int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_links_at_every_distance(spark):
    rng = random.Random(5)
    values = set()
    for _ in range(200):
        base = rng.getrandbits(64)
        values.add(base)
        for _ in range(3):
            x = base
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                x ^= 1 << b
            values.add(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    for wide in (False, True):
        rows = [tuple(r) for r in simhash.links(df, wide=wide).collect()]
        assert len(rows) == len(set(rows)) and {tuple(sorted(r)) for r in rows} == want


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (0, "q w e r t y")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect() if r.doc_id is not None)
    assert got == [(0, 0), (1, 1), (1, 1)]
    assert sorted(r.doc_id for r in simhash.deduplicated(df).collect()) == [0, 1]


def test_one_row_of_each_group_whatever_its_id(spark):
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(40)) for _ in range(5)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (4, texts[2]), (4, texts[3]), (3, texts[2]), (None, texts[3]), (9, texts[4]), (9, texts[4].upper())]
    got = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "text"]
    got = sorted(((r.doc_id, r.text.lower()) for r in got.collect()), key=str)
    assert got == sorted([(None, texts[0]), (None, texts[1]), (3, texts[2]), (4, texts[3]), (9, texts[4])], key=str)


def test_fingerprints_against_sql(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["Öl", "the", "A", "b\x0b", "w1", "東京"]) for _ in range(rng.randrange(12))) for _ in range(60)] + [None, "", "x", "A\tb", "z " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = "filter(split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\\\x09-\\\\x0d]+'), w -> w <> '')"
    rows = df.selectExpr("doc_id", f"{words} as w").selectExpr("doc_id", "transform(case when size(w) = 0 then array() when size(w) < 3 then array(w) else transform(sequence(1, size(w) - 2), i -> slice(w, i, 3)) end, s -> xxhash64(array_join(s, ' '))) as h")
    bit = [f"if(2 * size(filter(h, x -> shiftright(x, {b}) & 1 = 1)) > size(h), shiftleft(1L, {b}), 0L)" for b in range(64)]
    want = {r.doc_id: r.f for r in rows.selectExpr("doc_id", f"lower(lpad(hex({' | '.join(bit)}), 16, '0')) as f").collect()}
    got = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(df).collect()}
    assert got == want


def test_survivors_whatever_the_columns_are_called(spark):
    names = ["_label", "_id", "_hash", "label", "id", "text.x", "doc_id", "text"]
    rows = [(*[i] * 6, i, t) for i, t in [(3, "a b"), (1, "a b"), (2, "c"), (None, "c"), (None, "d")]]
    docs = spark.createDataFrame(rows, "a int, b int, c int, d int, e int, f int, doc_id long, text string").toDF(*names)
    kept = simhash.deduplicated(docs)
    assert kept.columns == names and sorted((r[0] or -1, r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, -1, "d"), (1, 1, "a b"), (2, 2, "c")]
