import hashlib
import zlib

import duckdb
import pytest

from tilelake.llm import merkle
from tilelake.llm.oracle import ORACLE_SQL

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, _row string, pos int, n int, g int"


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, source, lang, n_chars, text):
    return H("".join(map(field, (doc_id, source, lang, n_chars, text))))


def climb(nodes, at):
    """Root of a tree of eight and, for one node, its siblings and the places it takes in its runs."""
    steps = []
    while len(nodes) > 1:
        a = at // 8 * 8
        steps.append((nodes[a:at], nodes[at + 1 : a + 8]))
        nodes, at = [H("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)], at // 8
    return nodes[0], steps


def plain(rows):
    rows = [r[:5] for r in rows]
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    names = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        by[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    subroots = [climb([leaf(*r) for r in by[g]], 0)[0] for g in names]
    out = []
    for k, g in enumerate(names):
        leaves = [leaf(*r) for r in by[g]]
        for i, r in enumerate(by[g]):
            sub, own = climb(leaves, i)
            root, over = climb(subroots, k)
            now = leaves[i]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                now = leaf(*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            for left, right in own + over:
                now = H("".join(left) + now + "".join(right))
            out.append((r[0], leaves[i], sub, root, H("".join("".join(a + z) for a, z in own + over)), now, now == root))
    return sorted(out, key=repr)


def documents(n=700):
    text = ["Äb C", "", None, "plain", "X" * 3000, "same Text"]
    rows = [(i, "web", ["en", "de", None, "", "en", "en", "én"][i % 7], i * 3, text[i % 6]) for i in range(n)]
    rows += [(5, "web", "en", 15, "same Text")] * 90 + [(None, None, None, None, None)] * 20 + [(None, "a", "en", 1, "Q")] * 3 + [(7, "other", "x", None, "Lone")]
    return [(*r, "a", 1, 2, 3) for r in rows]


@pytest.mark.parametrize("deep,top,sort", [(4, 1 << 17, 1 << 16), (1, 3, 50), (2, 40, 100), (1, 1, 64)])
def test_against_the_definition(spark, monkeypatch, deep, top, sort):
    monkeypatch.setattr(merkle, "SORTED", sort)
    rows = documents()
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5), deep=deep, top=top)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows)


def test_small_tables(spark):
    for rows in ([], documents(1)[:1], documents(9)[:8]):
        found = merkle.manifest(spark.createDataFrame(rows, SCHEMA))
        assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows)


def test_sql_says_the_same(spark):
    rows = documents(150)
    con = duckdb.connect()
    t = spark.createDataFrame(rows, SCHEMA).drop("_row", "pos", "n", "g").toPandas()
    t = t.astype({"doc_id": "Int64", "n_chars": "Int64"})
    con.register("t", t)
    con.execute("create view documents as select doc_id, source, lang, n_chars, text from t")
    assert sorted((tuple(r) for r in con.sql(f"select doc_id, leaf, subroot, root, proof_sha256, folded_root, verified from ({ORACLE_SQL['op12_merkle']})").fetchall()), key=repr) == plain(rows)
