import random

import corpus_pipeline

from tilelake.llm.tokens import Encoder, tokenizer_path

from .test_decontaminate import brute as brute_hits
from .test_simhash import brute as brute_groups


def fixture(rng):
    vocab = {"en": "the of and a in that with sold house", "de": "der die und ein mit das haus verkauft nicht", "fr": "le la et un dans que avec maison vendue"}
    docs = []
    for i in range(90):
        lang = rng.choice(list(vocab))
        docs.append((i, " ".join(rng.choice(vocab[lang].split()) + rng.choice(["", "", "s", "e"]) for _ in range(rng.choice([20, 60]))), lang, "s", 1))
    items = [(i, " ".join(rng.choice(vocab["en"].split()) for _ in range(14))) for i in range(4)]
    docs += [(100 + i, docs[3 * i][1].upper(), docs[3 * i][2], "s", 1) for i in range(10)]
    docs += [(200, "x " + items[0][1] + " y", "en", "s", 1), (201, docs[5][1] + " " + items[1][1], "en", "s", 1), (202, "12 34", "en", "s", 1), (203, None, "en", "s", 1), (204, "", None, None, None)]
    return docs, items


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    docs, items = fixture(rng)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "contamination", "packing"]
    kept = stages["language"](spark, df, str(tmp_path))
    assert kept.columns == df.columns
    left = {r.doc_id: r.text for r in kept.collect()}
    assert set(left) == {d[0] for d in docs} - {202, 203, 204}
    groups = brute_groups(sorted(left.items()))
    left = {i: t for i, t in left.items() if groups[i][1] == i}
    got = stages["near_duplicates"](spark, kept, str(tmp_path))
    assert got.columns == df.columns and {r.doc_id: r.text for r in got.collect()} == left
    hit = {r[0] for r in brute_hits(sorted(left.items()), items) if r[-1]}
    got = stages["contamination"](spark, got, str(tmp_path))
    left = {i: t for i, t in left.items() if i not in hit}
    assert got.columns == df.columns and {r.doc_id: r.text for r in got.collect()} == left and {200, 201} <= hit
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    encode = Encoder(tokenizer_path())
    assert {r.doc_id: r.length for r in rows} == {i: len(encode([t])[0]) for i, t in left.items()}
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 2048 and sum(used.values()) == sum(r.length for r in rows)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
