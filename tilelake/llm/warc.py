"""WARC archives: captures written as request, response or revisit, and metadata records, and assembled again.

Payloads are digested, numbered and kept in the shared folder; grouping the digests finds the response of equal
payloads. Each task then writes its captures as archives of at most ``FILE_MB`` (compressed; or one capture), a warcinfo
record first, every record a gzip member of its own, so that usual readers may seek to any. Each attempt of a task
writes files of its own, and the manifest names those of the attempts that counted. Reading streams the archives of a
manifest record by record and assembles transactions: records meet under the identifier that WARC-Concurrent-To names;
revisits are joined to the response that they refer to.

Defined cases: a null html is an empty payload; a null url has no WARC-Target-URI; line ends in a url are
percent-encoded; a null id refers to nothing and never is the one referred to; rows repeated with one id and payload
are captures of their own, with records of their own, all of the same type; a very long payload is one record of a file
of its own; an empty table writes no archives; other columns are ignored. Ids of any type are written; the query
``op4_warc`` reads them back as integers, so there other strings raise.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import shared_dir, stored
from .bitpack import _fs

FILE_MB = 8
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, digest string, fields map<string,string>, http_head string, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(place: int, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{place}|{digest}|{kind}'.encode()).digest())}>"


def record(kind: str, headers: list[tuple[str, str | None]], content_type: str, block: bytes) -> bytes:
    """One WARC record with its end; headers of null value are left out."""
    lines = [f"WARC/1.1\r\nWARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return b"".join(["\r\n".join(lines).encode(), END, block, END])


def capture(place: int, id_, url: str | None, payload: bytes, digest: str, first_place: int | None, date: str) -> list[bytes]:
    """The three records of one capture; a revisit names the place of its response."""
    again = first_place is not None
    url = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    common = [("WARC-Target-URI", url), ("WARC-Date", date)]
    own = urn(place, digest, "response")
    rest = (url or "").partition("://")[2].partition("#")[0]
    host, slash, path = rest.partition("/")
    get = f"GET {slash + path or '/'} HTTP/1.1\r\nHost: {host}".encode() + END
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    return [
        record("request", [("WARC-Record-ID", urn(place, digest, "request")), ("WARC-Concurrent-To", own), *common], "application/http; msgtype=request", get),
        record("revisit" if again else "response", [("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Profile", PROFILE if again else None), ("WARC-Refers-To", urn(first_place, digest, "response") if again else None)], "application/http; msgtype=response", http + (b"" if again else payload)),
        record("metadata", [("WARC-Record-ID", urn(place, digest, "metadata")), ("WARC-Concurrent-To", own), *common], "application/warc-fields", b"" if id_ is None else f"capture-id: {id_}\r\n".encode()),
    ]


def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(place, id, url, html, digest, bytes, refers_to, first_place): refers_to is the smallest id of an equal payload,
    null for responses, first_place the place of a row of that id; place numbers the rows."""
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("html"))

    def number(batches):
        from pyspark import TaskContext

        place = TaskContext.get().partitionId() << 33
        for b in batches:
            html = b.column(2).to_pylist()
            cols = [pa.array(range(place, place + len(html)), pa.int64()), *b.columns, pa.array(map(base32_sha1, html), pa.string()), pa.array(map(len, html), pa.int64())]
            place += len(html)
            yield pa.RecordBatch.from_arrays(cols, names=["place", "id", "url", "html", "digest", "bytes"])

    rows = stored(rows.mapInArrow(number, f"place long, id {kind}, url string, html binary, digest string, bytes long"), "payloads")
    first = rows.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "place"))).alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    first = stored(first.select("digest", F.col("first.id").alias("first"), F.col("first.place").alias("first_place")), "firsts")  # a plain scan, so that Spark may split the rows of a frequent payload
    again = ~F.col("id").eqNullSafe(F.col("first"))
    joined = rows.join(first, "digest", "left")
    return joined.select("place", "id", "url", "html", "digest", "bytes", F.when(again, F.col("first")).alias("refers_to"), F.when(again, F.col("first_place")).alias("first_place"))


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", file_mb: float = FILE_MB, compression: str = "gzip") -> DataFrame:
    """Writes three records a page; returns the manifest (path, n_records, n_bytes). The folder must be one that executors
    share; the default lies in spark.checkpoint.dir."""
    folder = folder or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    rows = planned(pages, id_col, url_col, html_col, least_bytes).select("place", "id", "url", "html", "digest", "first_place")
    suffix = ".warc.gz" if compression == "gzip" else ".warc"
    squeeze = (lambda r: gzip.compress(r, 3, mtime=0)) if compression == "gzip" else (lambda r: r)

    def run(batches):
        fs, base = _fs(folder)
        fs.create_dir(base, recursive=True)
        held, size = [], 0

        def flush():
            name = f"{uuid.uuid4().hex}{suffix}"
            info = record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", name)], "application/warc-fields", b"format: WARC File Format 1.1\r\n")
            with fs.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(b"".join([squeeze(info), *held]))
            out = pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "n_records": len(held) + 1, "n_bytes": size}])
            held.clear()
            return out

        for b in batches:
            for place, id_, url, html, digest, first_place in zip(*(c.to_pylist() for c in b.columns)):
                own = [squeeze(r) for r in capture(place, id_, url, html, digest, first_place, date)]
                more = sum(map(len, own))
                if held and size + more > file_mb * 1e6:
                    yield flush()
                    size = 0
                held += own
                size += more
        if held:
            yield flush()

    return stored(rows.mapInArrow(run, "path string, n_records long, n_bytes long"), "manifest")


def parsed(file):
    """(headers by lower-case name, block) of each record of an archive, read in turn from a file."""
    while line := file.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        head = {}
        while (line := file.readline()) != b"\r\n":
            if not line:
                raise ValueError("a record's headers are cut short")
            k, _, v = line.decode().partition(":")
            head[k.lower()] = v.strip()
        n = int(head["content-length"])
        block = file.read(n)
        if len(block) < n or file.read(4) != END:
            raise ValueError("a record is cut short")
        yield head, block


def read(manifest: DataFrame, with_payload: bool = True, at_a_time: int = 1 << 22) -> DataFrame:
    """One row per record of the archives that a table's column path names, gzipped or not; http_head and payload for
    HTTP blocks, fields for warcinfo and metadata."""

    def run(rows):
        for b in rows:
            for path in b.column(0).to_pylist():
                fs, name = _fs(path)
                out, size = [], 0
                with fs.open_input_file(name) as raw:
                    for head, block in parsed(gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else io.BufferedReader(raw)):
                        r = {"type": head["warc-type"], "record_id": head["warc-record-id"], "concurrent_to": head.get("warc-concurrent-to"), "refers_to": head.get("warc-refers-to"), "target_uri": head.get("warc-target-uri"), "date": head.get("warc-date"), "digest": head.get("warc-payload-digest")}
                        if head.get("content-type", "").startswith("application/http"):
                            http, _, payload = block.partition(END)
                            r |= {"http_head": http.decode("utf-8", "replace"), "payload_bytes": len(payload), "payload_digest": base32_sha1(payload), "payload": payload if with_payload else None}
                        elif head.get("content-type") == "application/warc-fields":
                            r["fields"] = [(k, v.strip()) for k, _, v in (x.partition(":") for x in block.decode().splitlines()) if k]
                        out.append(r)
                        size += len(block) * with_payload + 1000
                        if size >= at_a_time:
                            yield pa.RecordBatch.from_pylist(out, schema)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([*((c, pa.string()) for c in ("type", "record_id", "concurrent_to", "refers_to", "target_uri", "date", "digest")), ("fields", pa.map_(pa.string(), pa.string())), ("http_head", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    files = max(1, manifest.count())
    return manifest.select("path").repartitionByRange(files, "path").mapInArrow(run, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture, response, requests, metadata); response is a response or revisit record."""
    one = F.struct(*records.columns)
    kind = F.col("type")
    met = records.where(kind.isin("response", "revisit", "request", "metadata")).groupBy(F.coalesce("concurrent_to", "record_id").alias("capture")).agg(
        F.collect_list(F.when(kind.isin("response", "revisit"), one)).alias("responses"), F.collect_list(F.when(kind == "request", one)).alias("requests"), F.collect_list(F.when(kind == "metadata", one)).alias("metadata")
    )
    return met.select("capture", F.explode("responses").alias("response"), "requests", "metadata")


def captures(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Of a manifest's archives, transactions with capture_id from their metadata, and of revisits the response that they refer to."""
    done = transactions(read(manifest, with_payload)).withColumn("capture_id", F.nullif(F.element_at(F.col("metadata")[0]["fields"], "capture-id"), F.lit("")))
    done = done if with_payload else stored(done, "captures")  # small rows, so that archives are read once
    responses = done.where("response.type = 'response'").groupBy(F.col("capture").alias("r_capture")).agg(F.first("capture_id").alias("r_id"), F.first("response.payload_bytes").alias("r_bytes"), F.first("response.payload_digest").alias("r_digest"))
    responses = stored(responses, "responses")  # a plain scan: revisits of one response may be half of all rows
    return done.join(responses, F.col("response.refers_to") == F.col("r_capture"), "left").select("*", F.when(F.col("r_capture").isNotNull(), F.struct(F.col("r_id").alias("capture_id"), F.col("r_bytes").alias("payload_bytes"), F.col("r_digest").alias("payload_digest"))).alias("referred")).drop("r_capture", "r_id", "r_bytes", "r_digest")
