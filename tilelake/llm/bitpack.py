"""Token ids in files of fixed-width bits, with block offsets for numpy unpacking and random access.

A shard file holds, little-endian: the magic ``TLBITS01``; width in bits, ids a block (u32 each); numbers of ids,
documents and blocks (u64 each); doc ids (i64, the smallest value for null); documents' first ids and the total (u64);
block offsets in bytes from the data's begin and its size (u64); the data. Each block packs its ids, most significant
bit first, into ``width`` bits each, and is filled to a whole byte.

Defined cases: a null or empty text is its end id alone; doc ids ascend over shards and in them, null first, and
repeated ids stay as often as they come, those of one id by a hash of their text; an empty table writes no shard; other
columns are ignored. Ids must be integers or strings of digits, others raise. A shard is written from one task's memory,
so a very long text is one large shard of its own.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import shared_dir, slices, stored, text_mb
from .tokens import GROUP, encoder, tokenizer_path

MAGIC, HEAD, NULL = b"TLBITS01", "<8sIIQQQ", np.iinfo(np.int64).min
BLOCK = 1 << 16


def width_of(vocab: int) -> int:
    """The fewest bits that hold every id below vocab."""
    return max(1, (vocab - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if width in (8, 16, 32):  # the same bits
        return ids.astype(f">u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width :]).tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f">u{width // 8}", n).astype(np.uint32)
    bits = np.zeros((n, 32), np.uint8)
    bits[:, 32 - width :] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width).reshape(n, width)
    return np.packbits(bits, axis=1).view(">u4").ravel().astype(np.uint32)


class Writer:
    """Gathers the ids of one shard, packed block by block."""

    def __init__(self, width: int, block: int = BLOCK):
        self.width, self.block = width, block
        self.docs: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.rest, self.data, self.at = np.zeros(0, np.uint32), io.BytesIO(), [0]

    def add(self, doc_ids: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.sizes.append(np.diff(offsets))
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // self.block * self.block
        for i in range(0, whole, self.block):
            self._put(ids[i : i + self.block])
        self.rest = ids[whole:]

    def _put(self, ids: np.ndarray) -> None:
        self.data.write(pack(ids, self.width))
        self.at.append(self.data.tell())

    def finish(self) -> tuple[bytes, int, int]:
        if len(self.rest):
            self._put(self.rest)
        docs, sizes = np.concatenate(self.docs), np.concatenate(self.sizes)
        first = np.concatenate([[0], np.cumsum(sizes)])
        head = struct.pack(HEAD, MAGIC, self.width, self.block, int(first[-1]), len(docs), len(self.at) - 1)
        return b"".join([head, docs.astype("<i8").tobytes(), first.astype("<u8").tobytes(), np.array(self.at, "<u8").tobytes(), self.data.getvalue()]), len(docs), int(first[-1])


class Reader:
    """Random access to one shard through a seekable file: only the index and the blocks asked for are read."""

    def __init__(self, file):
        self.file = file
        magic, self.width, self.block, self.n_ids, n, blocks = struct.unpack(HEAD, file.read(struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError("not a shard of packed ids")
        self.docs = np.frombuffer(file.read(8 * n), "<i8")
        self.first = np.frombuffer(file.read(8 * (n + 1)), "<u8").astype(np.int64)
        self.at = np.frombuffer(file.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.base = struct.calcsize(HEAD) + 8 * (2 * n + 1 + blocks + 1)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi of the shard, from the blocks that hold them."""
        if lo >= hi:
            return np.zeros(0, np.uint32)
        a, z = lo // self.block, (hi - 1) // self.block + 1
        self.file.seek(self.base + self.at[a])
        data = self.file.read(self.at[z] - self.at[a])
        parts = [unpack(data[self.at[k] - self.at[a] : self.at[k + 1] - self.at[a]], min(self.block, self.n_ids - k * self.block), self.width) for k in range(a, z)]
        return np.concatenate(parts)[lo - a * self.block : hi - a * self.block]

    def doc(self, i: int) -> np.ndarray:
        return self.ids(self.first[i], self.first[i + 1])


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write(docs: DataFrame, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, shard_mb: float = 32) -> DataFrame:
    """Encodes and writes every document in ascending id order; returns the manifest (shard, path, n_docs, n_ids).

    A shard takes about ``shard_mb`` of text. The folder must be one that executors share; the default lies in
    spark.checkpoint.dir. Each attempt of a task writes a file of its own, and the manifest names those of the
    attempts that counted, so a lost or doubled task does no harm.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path()
    folder = folder or f"{shared_dir(spark)}/packed-{uuid.uuid4().hex}"
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = max(1, round(text_mb(docs, "text") / shard_mb))
    dealt = docs.withColumn("h", F.xxhash64("text")).repartitionByRange(parts, "id", "h").sortWithinPartitions("id", "h")

    def run(rows):
        from pyspark import TaskContext

        encode = encoder(path)
        out = Writer(width_of(encode.vocab))
        for b in rows:
            doc_ids = b.column(0).fill_null(int(NULL)).to_numpy()
            for lo, hi in slices(b.column(1), GROUP):
                out.add(doc_ids[lo:hi], *encode(b.column(1).slice(lo, hi - lo).to_pylist()))
        if out.docs:
            data, n_docs, n_ids = out.finish()
            shard, (fs, base) = TaskContext.get().partitionId(), _fs(folder)
            name = f"shard-{shard:08d}-{uuid.uuid4().hex}.bits"
            fs.create_dir(base, recursive=True)
            with fs.open_output_stream(f"{base}/{name}") as f:
                f.write(data)
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": f"{folder}/{name}", "n_docs": n_docs, "n_ids": n_ids}])

    return stored(dealt.select("id", "text").mapInArrow(run, "shard long, path string, n_docs long, n_ids long"), "manifest")


def read(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids if asked for."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    shards = max(1, manifest.count())
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def run(rows):
        for b in rows:
            for r in b.to_pylist():
                fs, name = _fs(r["path"])
                with fs.open_input_file(name) as f:
                    x = Reader(f)
                    for lo in range(0, len(x.docs), 4096):
                        hi = min(len(x.docs), lo + 4096)
                        ids, at = x.ids(x.first[lo], x.first[hi]), x.first[lo : hi + 1] - x.first[lo]
                        data = ids.astype("<u4").tobytes()
                        cols = [pa.array(x.docs[lo:hi], mask=x.docs[lo:hi] == NULL), pa.array(r["base"] + x.first[lo:hi]), pa.array(np.diff(at)), pa.array([zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(at[:-1], at[1:])], pa.int64())]
                        if with_ids:
                            cols.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))
                        yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    return based.select("shard", "path", "base").repartitionByRange(shards, "shard").mapInArrow(run, schema)
