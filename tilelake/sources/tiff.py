"""Tiled TIFF slides as Spark data sources: metadata of files, and tiles of pixels by bands of rows.

Only the parts of a file that are asked for are read: its header and tag tables (classic and big ones, either byte
order), and of the pixels the stored tiles or strips under a band, by their offsets. Stored tiles may be plain or
deflated, with or without horizontal differences, of 8-bit gray, RGB or RGBA; other kinds raise. The levels of a slide
are its tiled images in falling size (of a file without tiles, its images).

Two formats are registered by ``register``:

- ``slide_metadata``: a row a file, as in ``schemas.SLIDES`` without slide_id; what cannot be read has an error and null sizes
  (option ``permissive``, else it raises).
- ``slide_tiles``: the tiles of a grid with their pixels (options ``tile``, ``overlap``, ``level``, ``band``), a partition for
  each band of rows of each file; where these are many and small, for several in turn. Options ``x_from``, ``x_to``, ``y_from``, ``y_to`` (of origins, the upper ones excluded) and
  ``only`` (a JSON list of paths) choose partitions and tiles before anything is read. (Conditions are not taken by ``pushFilters``: Spark 4.1
  keeps a relation's pushed conditions for later queries on the same DataFrame.)

Paths may be files or folders on any file system that pyarrow knows. Planning reads the files' headers, by threads of
the driver, but not those of small files among many.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.graph import stored
from ..operators.tiling import step_of, with_tissue
from ..schemas import TILES
from .documents import EXTENSIONS

METADATA = "path string, width bigint, height bigint, levels int, level_downsamples array<double>, mpp double, error string"
PIXELS = "path string, level int, x bigint, y bigint, size int, height int, width int, channels int, image binary"
#: Bytes of pixels handed on at a time, and of stored tiles kept decoded.
AT_A_TIME, KEPT = 1 << 25, 1 << 26
#: Bands go together in a partition up to so many bytes of pixels, a band counting for ``BAND`` more, and as long as there are so many partitions.
TOGETHER, BAND, PARTITIONS = 1 << 28, 1 << 20, 128
#: Of more files than ``MANY``, those of up to ``SMALL`` bytes are not opened for planning; their tasks find out what they hold.
MANY, SMALL = 256, 1 << 18
#: Tags and the sizes of their types in bytes.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, SAMPLES, ROWS_PER_STRIP, X_RESOLUTION, PLANAR, UNIT, PREDICTOR = 256, 257, 258, 259, 262, 277, 278, 282, 284, 296, 317
STRIP_OFFSETS, STRIP_BYTES, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_BYTES = 273, 279, 322, 323, 324, 325
KINDS = {1: ("B", 1), 2: ("c", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 12: ("d", 8), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946


def opened(path: str):
    """A random-access file of any file system that pyarrow knows."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        system, name = fs.FileSystem.from_uri(path)
    else:
        system, name = fs.LocalFileSystem(), path
    return system.open_input_file(name)


def listed(path: str, extensions: tuple[str, ...] = EXTENSIONS) -> list[str]:
    """The slide files under a path, in order; a file is its own listing, a missing path raises."""
    return [name for name, _ in sized(path, extensions)]


def sized(path: str, extensions: tuple[str, ...] = EXTENSIONS) -> list[tuple[str, int]]:
    """``listed`` with the files' bytes."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    prefix = path[: len(path) - len(name)] if path.endswith(name) else ""
    info = system.get_file_info(name)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = system.get_file_info(fs.FileSelector(name, recursive=False))
    return sorted((prefix + f.path, f.size) for f in found if f.type == fs.FileType.File and f.extension.lower() in extensions)


@dataclass
class Level:
    """One stored image: its size and where its tiles (or strips, which are tiles as wide as the image) lie."""

    width: int
    height: int
    tile_width: int
    tile_height: int
    channels: int
    compression: int
    predictor: int
    offsets: list[int]
    sizes: list[int]
    tiled: bool
    mpp: float | None = None

    @property
    def across(self) -> int:
        return -(-self.width // self.tile_width)


class Tiff:
    """A slide file: ``levels_of`` its images, ``read`` pixels of any rectangle of a level."""

    def __init__(self, path: str):
        self.path, self.file = path, opened(path)
        self.kept: OrderedDict[tuple[int, int], np.ndarray] = OrderedDict()
        self.held = 0
        head = self._at(0, 16)
        if head[:2] not in (b"II", b"MM"):
            raise ValueError(f"{path} is no TIFF file")
        self.order = "<" if head[:2] == b"II" else ">"
        (magic,) = struct.unpack(self.order + "H", head[2:4])
        if magic not in (42, 43):
            raise ValueError(f"{path} is no TIFF file")
        self.big = magic == 43
        (at,) = struct.unpack(self.order + ("Q" if self.big else "I"), head[8:16] if self.big else head[4:8])
        found, seen = [], set()
        while at and at not in seen:
            seen.add(at)
            tags, at = self._tags(at)
            found.append(self._level(tags))
        tiled = [v for v in found if v.tiled] or found
        if not tiled:
            raise ValueError(f"{path} holds no image")
        self.levels_of = sorted(tiled, key=lambda v: -v.width)
        top = self.levels_of[0]
        self.width, self.height, self.levels, self.mpp = top.width, top.height, len(self.levels_of), top.mpp
        self.downsamples = [top.width / v.width for v in self.levels_of]

    def _at(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _tags(self, at: int) -> tuple[dict, int]:
        """Tags of one table as numbers, and the place of the next table."""
        count, entry, word = ("Q", 20, "Q") if self.big else ("H", 12, "I")
        size = struct.calcsize("=" + count)
        (n,) = struct.unpack(self.order + count, self._at(at, size))
        if n > 4096:
            raise ValueError(f"{self.path} has a broken table of tags")
        data = self._at(at + size, n * entry + struct.calcsize("=" + word))
        tags = {}
        for i in range(n):
            tag, kind, many = struct.unpack_from(self.order + "HH" + word, data, i * entry)
            if kind not in KINDS:
                continue
            code, each = KINDS[kind]
            inside = entry - 4 - struct.calcsize("=" + word)
            value = data[(i + 1) * entry - inside : (i + 1) * entry]
            if each * many > inside:
                (place,) = struct.unpack(self.order + word, value)
                value = self._at(place, each * many)
            if kind == 2:
                tags[tag] = value[:many].rstrip(b"\0")
            else:
                tags[tag] = struct.unpack(self.order + code * many, value[: each * many])
        (following,) = struct.unpack(self.order + word, data[n * entry :])
        return tags, following

    def _level(self, tags: dict) -> Level:
        one = lambda tag, default: tags.get(tag, (default,))[0]
        channels, bits = one(SAMPLES, 1), tags.get(BITS, (8,))
        if set(bits) != {8} or channels not in (1, 3, 4) or channels > 1 and one(PLANAR, 1) != 1:
            raise ValueError(f"{self.path}: 8-bit pixels of 1, 3 or 4 channels in turn are needed")
        width, height, tiled = one(WIDTH, 0), one(LENGTH, 0), TILE_OFFSETS in tags
        mpp = None
        if X_RESOLUTION in tags and one(UNIT, 2) in (2, 3) and tags[X_RESOLUTION][0]:
            mpp = {2: 25400.0, 3: 10000.0}[one(UNIT, 2)] * tags[X_RESOLUTION][1] / tags[X_RESOLUTION][0]
        return Level(
            width, height, one(TILE_WIDTH, width) if tiled else width, one(TILE_LENGTH, height) if tiled else min(one(ROWS_PER_STRIP, height), height), channels, one(COMPRESSION, 1), one(PREDICTOR, 1),
            list(tags.get(TILE_OFFSETS if tiled else STRIP_OFFSETS, ())), list(tags.get(TILE_BYTES if tiled else STRIP_BYTES, ())), tiled, mpp,
        )

    def _stored(self, level: int, k: int) -> np.ndarray:
        """A stored tile, decoded; the last ones used are kept."""
        if (level, k) in self.kept:
            self.kept.move_to_end((level, k))
            return self.kept[level, k]
        v = self.levels_of[level]
        data = self._at(v.offsets[k], v.sizes[k])
        if v.compression in (DEFLATE, OLD_DEFLATE):
            data = zlib.decompress(data)
        elif v.compression != PLAIN:
            raise ValueError(f"{self.path}: compression {v.compression} is not known")
        rows = v.tile_height if v.tiled else min(v.tile_height, v.height - k // v.across * v.tile_height)
        out = np.frombuffer(data, np.uint8, rows * v.tile_width * v.channels).reshape(rows, v.tile_width, v.channels)
        if v.predictor == 2:
            out = np.cumsum(out, axis=1, dtype=np.uint8)
        self.kept[level, k] = out
        self.held += out.nbytes
        while self.held > KEPT and len(self.kept) > 1:
            self.held -= self.kept.popitem(last=False)[1].nbytes
        return out

    def region(self, x: int, y: int, width: int, height: int, level: int = 0) -> np.ndarray:
        """Pixels of a rectangle of a level; what lies beyond the image is 0."""
        v = self.levels_of[level]
        out = np.zeros((height, width, v.channels), np.uint8)
        x2, y2 = min(x + width, v.width), min(y + height, v.height)
        for j in range(max(y, 0) // v.tile_height, -(-max(y2, 0) // v.tile_height)):
            for i in range(max(x, 0) // v.tile_width, -(-max(x2, 0) // v.tile_width)):
                part = self._stored(level, j * v.across + i)
                ax, ay = max(x, i * v.tile_width, 0), max(y, j * v.tile_height, 0)
                zx, zy = min(x2, (i + 1) * v.tile_width), min(y2, j * v.tile_height + part.shape[0])
                out[ay - y : zy - y, ax - x : zx - x] = part[ay - j * v.tile_height : zy - j * v.tile_height, ax - i * v.tile_width : zx - i * v.tile_width]
        return out

    def read(self, x: int, y: int, size: int) -> np.ndarray:
        return self.region(x, y, size, size)


@dataclass
class Band(InputPartition):
    """Rows of tiles of one file that a task reads; without them, all that are asked for."""

    path: str
    level: int
    ys: tuple[int, int, int] | None = None
    xs: tuple[int, int, int] | None = None


@dataclass
class Bands(InputPartition):
    """Small bands that a task reads in turn."""

    bands: list[Band]


def packed(bands: list[Band], tile: int) -> list[Band | Bands]:
    """Bands in their order, small ones together."""
    weight = [(len(range(*b.ys)) * len(range(*b.xs)) * tile * tile * 3 if b.ys else 0) + BAND for b in bands]
    most = min(TOGETHER, sum(weight) // PARTITIONS)
    heaps, held = [], most + 1
    for b, w in zip(bands, weight):
        if held + w > most:
            heaps.append([])
            held = 0
        heaps[-1].append(b)
        held += w
    return [h[0] if len(h) == 1 else Bands(h) for h in heaps]


def _places(low: int, high: int, extent: int, tile: int, step: int) -> range:
    """Origins of whole tiles along one axis, from low on and below high."""
    return range(-(-max(low, 0) // step) * step, min(high - 1, extent - tile) + 1, step)


def _option(options: dict, name: str, default):
    value = options.get(name.lower(), options.get(name))
    return default if value is None else type(default)(value)


class TileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files = options["path"]
        self.tile, self.level, self.band = _option(options, "tile", 512), _option(options, "level", 0), _option(options, "band", 4096)
        self.step = step_of(self.tile, _option(options, "overlap", 0.0))
        self.x, self.y = ((_option(options, f"{c}_from", 0), _option(options, f"{c}_to", 1 << 40)) for c in "xy")
        self.only = set(json.loads(_option(options, "only", "null")) or ()) or None

    def partitions(self) -> list[Band | Bands]:
        files = [(p, n) for p, n in sized(self.files) if self.only is None or p in self.only]
        unseen = {p for p, n in files if n <= SMALL} if len(files) > MANY else set()
        with ThreadPoolExecutor(32) as pool:
            places = dict(zip(seen := [p for p, _ in files if p not in unseen], pool.map(self._grid, seen)))
        out = []
        rows = max(1, self.band // self.step)
        for path, _ in files:
            if path in unseen:
                out.append(Band(path, self.level))
                continue
            xs, ys = places[path]
            for k in range(0, len(ys) if len(xs) else 0, rows):
                part = ys[k : k + rows]
                out.append(Band(path, self.level, (part.start, part.stop, part.step), (xs.start, xs.stop, xs.step)))
        return packed(out, self.tile)

    def _grid(self, path: str, slide: Tiff | None = None) -> tuple[range, range]:
        """Origins of the tiles of a file, across and down."""
        levels = (slide or Tiff(path)).levels_of
        width, height = (levels[self.level].width, levels[self.level].height) if self.level < len(levels) else (0, 0)
        return _places(*self.x, width, self.tile, self.step), _places(*self.y, height, self.tile, self.step)

    def read(self, part: Band | Bands) -> Iterator[pa.RecordBatch]:
        if not isinstance(part, Band | Bands):  # a source without partitions is given one of Spark's own
            return
        rows, held, slide = [], 0, None
        for band in [part] if isinstance(part, Band) else part.bands:
            if slide is None or slide.path != band.path:
                slide = Tiff(band.path)
            xs, ys = (range(*band.xs), range(*band.ys)) if band.ys else self._grid(band.path, slide)
            for y in ys:
                for x in xs:
                    a = slide.region(x, y, self.tile, self.tile, band.level)
                    a = np.ascontiguousarray(np.repeat(a, 3, axis=2) if a.shape[2] == 1 else a[..., :3])
                    rows.append((band.path, band.level, x, y, self.tile, *a.shape, a.tobytes()))
                    held += a.nbytes
                    if held >= AT_A_TIME:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("path", pa.string()), ("level", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("size", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("channels", pa.int32()), ("image", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])


class TileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "slide_tiles"

    def schema(self) -> str:
        return PIXELS

    def reader(self, schema) -> TileReader:
        return TileReader(dict(self.options))


@dataclass
class Files(InputPartition):
    paths: list[str]


class MetadataReader(DataSourceReader):
    def __init__(self, options: dict):
        self.files, self.permissive = options["path"], str(options.get("permissive", "true")).lower() == "true"

    def partitions(self) -> list[Files]:
        paths = listed(self.files)
        return [Files(paths[i : i + 64]) for i in range(0, len(paths), 64)]

    def read(self, part: Files) -> Iterator[tuple]:
        for path in part.paths if isinstance(part, Files) else ():
            try:
                t = Tiff(path)
                yield path, t.width, t.height, t.levels, t.downsamples, t.mpp, None
            except Exception as e:
                if not self.permissive:
                    raise
                yield path, None, None, None, None, None, f"{type(e).__name__}: {e}"


class MetadataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "slide_metadata"

    def schema(self) -> str:
        return METADATA

    def reader(self, schema) -> MetadataReader:
        return MetadataReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes both formats known to a session."""
    for source in (TileSource, MetadataSource):
        spark.dataSource.register(source)


def metadata(spark: SparkSession, path: str, permissive: bool = True) -> DataFrame:
    """The slides table of a file or folder; slide_id is the CRC-32 of the path."""
    register(spark)
    rows = spark.read.format("slide_metadata").option("permissive", str(permissive).lower()).load(path)
    return rows.select(slide_id(), "*")


def slide_id(path: str = "path"):
    return F.crc32(F.col(path).cast("binary")).alias("slide_id")


def tiles(spark: SparkSession, path: str, tile: int = 512, overlap: float = 0.0, level: int = 0, band: int = 4096, x: tuple[int, int] | None = None, y: tuple[int, int] | None = None, paths: list[str] | None = None) -> DataFrame:
    """All whole tiles of a level with their pixels, and the path they are from; x and y (from, to) and paths prune."""
    register(spark)
    more = {f"{c}_{e}": str(v) for c, ends in (("x", x), ("y", y)) if ends for e, v in zip(("from", "to"), ends)}
    more |= {"only": json.dumps(paths)} if paths is not None else {}
    return spark.read.format("slide_tiles").options(tile=str(tile), overlap=str(overlap), level=str(level), band=str(band), **more).load(path)


def as_tiles(rows: DataFrame, step: int) -> DataFrame:
    """Tiles as in ``schemas.TILES``; the number is the place on the whole grid of 2^20 tiles across."""
    number = (F.col("y") / step).cast("bigint") * (1 << 20) + (F.col("x") / step).cast("bigint")
    return rows.select(slide_id(), number.alias("patch_id"), *[c.split()[0] for c in TILES.split(", ")[2:]])


def encoded(levels: list[np.ndarray], tile: int = 256, deflate: bool = True, difference: bool = False, big: bool = False, mpp: float | None = None) -> bytes:
    """Images of falling size as one tiled TIFF file."""
    if tile % 16:
        raise ValueError("sides of stored tiles are multiples of 16")
    word, inline = ("Q", 8) if big else ("I", 4)
    out = io.BytesIO()
    out.write(b"II" + (struct.pack("<HHHQ", 43, 8, 0, 0) if big else struct.pack("<HI", 42, 0)))
    link = inline  # where the place of the next table is to be written
    for image in levels:
        image = image if image.ndim == 3 else image[..., None]
        height, width, channels = image.shape
        offsets, sizes = [], []
        for y in range(0, height, tile):
            for x in range(0, width, tile):
                part = np.zeros((tile, tile, channels), np.uint8)
                part[: height - y, : width - x] = image[y : y + tile, x : x + tile]
                if difference:
                    part = np.diff(part, axis=1, prepend=np.zeros((tile, 1, channels), np.uint8))
                data = zlib.compress(part.tobytes(), 6) if deflate else part.tobytes()
                offsets.append(out.tell())
                sizes.append(len(data))
                out.write(data)
        tags = {WIDTH: (4, [width]), LENGTH: (4, [height]), BITS: (3, [8] * channels), COMPRESSION: (3, [DEFLATE if deflate else PLAIN]), PHOTOMETRIC: (3, [2 if channels > 1 else 1]), SAMPLES: (3, [channels]), PLANAR: (3, [1])}
        tags |= {PREDICTOR: (3, [2])} if difference else {}
        tags |= {X_RESOLUTION: (5, [10**9, round(1e5 * mpp)]), UNIT: (3, [3])} if mpp else {}
        tags |= {TILE_WIDTH: (3, [tile]), TILE_LENGTH: (3, [tile]), TILE_OFFSETS: (16 if big else 4, offsets), TILE_BYTES: (16 if big else 4, sizes)}
        entries = []
        for tag, (kind, values) in sorted(tags.items()):
            code = KINDS[kind][0]
            data = struct.pack("<" + code[0] * len(values), *values)
            if len(data) > inline:
                place = out.tell()
                out.write(data)
                data = struct.pack("<" + word, place)
            entries.append(struct.pack("<HH" + word, tag, kind, len(values) // len(code)) + data.ljust(inline, b"\0"))
        table = out.tell()
        out.write(struct.pack("<" + ("Q" if big else "H"), len(entries)) + b"".join(entries) + struct.pack("<" + word, 0))
        out.seek(link)
        out.write(struct.pack("<" + word, table))
        out.seek(0, 2)
        link = out.tell() - inline
    return out.getvalue()


def saved(data: bytes, folder: str, name: str) -> str:
    """Writes a file under a name of its own first and then moves it, so that a lost or doubled task leaves whole files only."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    system.create_dir(base, recursive=True)
    own = f"{base}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(own) as f:
        f.write(data)
    system.move(own, f"{base}/{name}")
    return f"{folder.rstrip('/')}/{name}"


def first_kept(spark: SparkSession, path: str, n: int, test: str = "spread", tile: int = 512, overlap: float = 0.0, level: int = 0) -> DataFrame:
    """The first n tiles of each slide, in reading order, that pass a tissue test; what lies below them is not read.

    Rows of tiles are read in rounds, each of twice as many as before, and a slide that has its n tiles is left out of the
    next; the rounds are at most the logarithm of the rows. The driver keeps a number for each slide, as planning does.
    """
    step = step_of(tile, overlap)
    below = {r.path: r.height for r in metadata(spark, path).where("error is null").select("path", "height").toLocalIterator()}
    counts, found, low, rows = dict.fromkeys(below, 0), None, 0, 1
    while below:
        part = tiles(spark, path, tile, overlap, level, step * rows, y=(low, low + rows * step), paths=[*below])
        part = stored(with_tissue(part, test), "kept")
        found = part if found is None else found.unionByName(part)
        for r in part.groupBy("path").count().toLocalIterator():
            counts[r["path"]] += r["count"]
        low, rows = low + rows * step, rows * 2
        below = {p: h for p, h in below.items() if counts[p] < n and low + tile <= h}
    if found is None:
        return tiles(spark, path, tile, overlap, level).limit(0).withColumn("patch_id", F.lit(0).cast("bigint"))
    place = F.row_number().over(Window.partitionBy("path").orderBy("y", "x")) - 1
    return found.withColumn("patch_id", place.cast("bigint")).where(F.col("patch_id") < n)
