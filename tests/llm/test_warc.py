import base64
import hashlib
import io
import random
import zlib

import pytest

from tilelake.llm import queries, warc


def brute(rows, least=0):
    first = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if i is not None and len(h) >= least:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        n = sum((x[2] or "").encode() == h for x in rows)
        again = len(h) >= least and n > 1 and h in first and first[h] != i
        out.append((i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a.example/x?y#z", "<p>ä</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (3, "http://b.example", "<p>same</p>"), (9, None, "<p>same</p>"), (4, "http://c.example/\r\nEvil: 1", "<p>same</p>"),
    (7, "http://d.example/", None), (8, "x", ""), (10, "http://e.example/\n", "x" * 200_000), (11, "http://f.example/", "\r\n\r\n"),
    (3, "http://b.example", "<p>same</p>"), (None, "http://g.example/", "<p>same</p>"), (None, "u", "only null"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    manifest = warc.write(frame(spark, ROWS), least_bytes=least, file_mb=0.005, compression="none" if least else "gzip")
    got = warc.captures(manifest, with_payload=True)
    rows = sorted((tuple(r) for r in queries.capture_digests(got).collect()), key=str)
    assert rows == brute(ROWS, least)
    seen = []
    for r in got.collect():
        assert len(r.requests) == len(r.metadata) == 1 and r.requests[0].concurrent_to == r.metadata[0].concurrent_to == r.response.record_id
        seen += [r.requests[0].record_id, r.metadata[0].record_id, r.response.record_id]
        if r.response.type == "response":
            assert r.response.digest == "sha1:" + r.response.payload_digest
            assert bytes(r.response.payload).decode() in [h or "" for _, _, h in ROWS]
    assert len(set(seen)) == 3 * len(ROWS)
    kinds = {r.type: r["count"] for r in warc.read(manifest).groupBy("type").count().collect()}
    assert kinds["request"] == kinds["metadata"] == kinds["response"] + kinds["revisit"] == len(ROWS) and kinds["warcinfo"] == manifest.count()


def test_files_are_bounded_and_every_record_is_a_member(spark):
    rng = random.Random(0)
    rows = [(i, "http://a.example/", "".join(rng.choices("abcdefgh", k=3000 if i else 300_000))) for i in range(40)]
    manifest = warc.write(frame(spark, rows).coalesce(1), file_mb=0.02).collect()
    assert len(manifest) > 3 and sum(r.n_records for r in manifest) == 3 * 40 + len(manifest)
    assert all(r.n_bytes <= 20_000 or r.n_records == 4 for r in manifest)
    for r in manifest:
        data, members = open(r.path.removeprefix("file://"), "rb").read(), 0
        while data:
            one = zlib.decompressobj(31)
            text = one.decompress(data)
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and len(list(warc.parsed(io.BytesIO(text)))) == 1
            data, members = one.unused_data, members + 1
        assert members == r.n_records


def test_empty_and_broken(spark):
    manifest = warc.write(frame(spark, []))
    assert warc.captures(manifest).count() == 0
    for broken in (b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n", b"junk", b"WARC/1.1\r\nContent-Le"):
        with pytest.raises(ValueError):
            list(warc.parsed(io.BytesIO(broken)))
