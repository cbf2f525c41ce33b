import random

import corpus_pipeline

from tilelake.llm import simhash


def shingles(text, k=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def brute(rows):
    """Ids of the rows that stay, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted(least.values())


def test_stage_takes_near_copies_from_similarity_of_eight_tenths(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(25):
        text = [f"w{rng.randrange(400)}" for _ in range(rng.choice([2, 4, 12, 100, 300]))]
        rows.append((len(rows), " ".join(text)))
        for _ in range(rng.choice([1, 2, 5])):
            if rng.random() < 0.5:
                text = list(text)  # a copy of the copy
            again = list(text)
            for _ in range(rng.choice([0, 1, 2, 4, 6])):
                again[rng.randrange(len(again))] = f"v{rng.randrange(400)}"
            rows.append((len(rows), "\n ".join(again).upper()))
            text = rng.choice([text, again])
    # similarity of exactly 0.8: 40 shared shingles of 50
    base = [f"x{i}" for i in range(48)]
    rows += [(900, " ".join(base[:44])), (901, " ".join([*base[:44], *[f"z{i}" for i in range(10)]])), (902, " ".join([*base[:44], *[f"y{i}" for i in range(11)]]))]
    rows += [(950, None), (951, ""), (952, " \t")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert 901 not in want and 902 in want and 950 in want and 951 not in want
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert sorted(r.doc_id for r in got.collect()) == want
    assert simhash.deduplicated(df.limit(0)).count() == 0


def test_filter_of_texts_loses_none(spark):
    rng = random.Random(6)
    hashes = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(4000)] + [0, -1, -(1 << 63)]
    rows = spark.createDataFrame([(h, str(h)) for h in hashes], "text_hash long, text string")
    wanted = hashes[::4] + hashes[-3:]
    texts = spark.createDataFrame([(h,) for h in wanted], "text_hash long")
    got = {r.text_hash for r in simhash.among(rows, texts).collect()}
    assert set(wanted) <= got and len(got) < len(wanted) + 300
    assert set(wanted) <= {r.text_hash for r in simhash.among(rows, texts, 1 << 10).collect()}
    assert simhash.among(rows, texts.limit(0)).count() == 0


def test_texts_without_a_partner_are_not_shuffled(spark):
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(10**7)}" for _ in range(4000)) for _ in range(200)]
    rows = [*enumerate(texts), (900, texts[0] + " more"), (901, texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df.count()
    written = lambda: sum(e.totalShuffleWrite() for e in map(found().apply, range(found().size())))
    found = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(True)
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df.write.parquet(path := f"{simhash.stored(df.limit(1), 'path').inputFiles()[0]}-docs")
        before = written()
        got = simhash.deduplicated(spark.read.parquet(path)).select("doc_id").collect()
        used = written() - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    assert sorted(r.doc_id for r in got) == list(range(200))
    # the rows that stay are joined with whole texts once, at the end
    assert used < 1.3 * sum(map(len, texts)), (used, sum(map(len, texts)))
