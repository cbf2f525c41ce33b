"""SimHash near-duplicates: a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most 3 bits agree in at least 5 of their 8 bytes. The index lists every
distinct fingerprint under combinations of byte positions such that any 5 positions contain one of them, so a linked
pair meets under at least one. For each pair that meets, the shared positional bytes are tallied; pairs below the
guaranteed minimum of 5 go, the rest are verified bit by bit.

Equal fingerprints are one class: the index holds classes, never their copies.

``similar`` groups by the Jaccard similarity of five-word shingles, ``LEAST`` or more, exactly compared. The fingerprints
of such texts may differ in some 10 of 64 bits, beyond any distance that positional bytes can guarantee to find; an
index of sampled bits would need some n^0.24 keys a row for n rows. So the links that the index finds come first, and
what it cannot reach is found in the sets themselves. Texts that may have a partner at all are those that share one of
``BANDS`` hashes of ``ROWS`` minima with another (of similarity s two share none with a probability of (1 - s^5)^32, 3e-6
at 0.8). Among their shingles, rarest first, two sets of the least similarity must share one in the first n - 0.8 n + 1
of each: so a text meets others under these few shingles only, and one whose own are unique meets none. A pair goes on if
enough shingles follow the one under which it meets and if its sketches of 1,024 parities do not differ in more bits
than the sets may in shingles; both bounds lose no pair. No pair is compared whose ends are known to be connected: texts
of equal or linked fingerprints are compared with the least text of their class and texts under a shingle with its least one; then only members of different components meet.

Defined cases: a null or word-less text has fingerprint zero and links like any other; rows may repeat; a null doc_id
is a row of its own and never a component's id unless the whole component has none; an empty table gives no rows;
other columns of the input are ignored; a very long text is taken whole; ``similar`` takes a text of fewer words than a
shingle as one shingle, and null and word-less texts as equal; of a group's rows that of least id stays, then that of
least text hash, and one of equal rows.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import components, gram_hashes, lower_table, mixed, slices, split_words, stored, string_bytes, word_hashes

BITS = 3
SHINGLE, LEAST, BANDS, ROWS, SKETCH = 5, 0.8, 32, 5, 16
#: Beyond so many distinct fingerprints, keys of 40 bits instead of 24: more rows in the index, fewer chance meetings.
WIDE_FROM = 1 << 23
#: Bits of the filter that tells which texts may be needed again (16 MB).
MOST_BITS = 1 << 27
WORD = np.ones(256, bool)
WORD[[9, 10, 11, 12, 13, 32]] = False
LOWER = lower_table()
_SEEDS = mixed(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
TIMES, PLUS = _SEEDS[: BANDS * ROWS] | np.uint64(1), _SEEDS[BANDS * ROWS :]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of whole-text word shingles, lower-cased in A-Z."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
        starts = [0, *(e + 1 for e in ends)]
        hashes = [xxhash.xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :])]
    set_in = np.zeros(64, np.int64)
    flat = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(flat), 1 << 16):
        set_in += np.unpackbits(flat[i : i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > len(hashes)).tobytes(), "big")


def text_hash(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp): fp as a signed long."""
    kind = docs.schema[id_col].dataType

    def run(rows):
        for b in rows:
            fp = np.array([fingerprint(t) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["id", "text_hash", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, text_hash long, fp long")


def byte_keys(wide: bool) -> list[tuple[int, ...]]:
    """Byte positions of the keys; any 5 of the 8 positions contain one of them.

    Narrow: of two halves of 4 positions, one holds 3 of any 5. Wide: all 56 fives.
    """
    return list(combinations(range(8), 5)) if wide else [*combinations(range(4), 3), *combinations(range(4, 8), 3)]


def shared_bytes(x: str) -> str:
    """SQL: how many of the 8 bytes of x, an xor, are zero."""
    return " + ".join(f"int((shiftrightunsigned({x}, {8 * i}) & 255) = 0)" for i in range(8))


def links(classes: DataFrame, bits: int = BITS, wide: bool = False) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints at ``bits`` (3 at most) or fewer differing bits, each once.

    classes: distinct fingerprints, column fp.
    """
    if not 0 <= bits <= BITS:
        raise ValueError("bits must lie in 0..3")
    sets = byte_keys(wide)
    masks = [sum(255 << (56 - 8 * p) for p in s) for s in sets]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = classes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("k", "key"))
    earlier = " or ".join(f"(k > {i} and ((x.fp ^ y.fp) & {m}L) = 0)" for i, m in enumerate(signed[:-1]))
    x, y = keyed.alias("x"), keyed.select(F.col("fp"), F.col("k").alias("k2"), F.col("key").alias("key2")).alias("y")
    tally = f"({shared_bytes('(x.fp ^ y.fp)')}) >= {8 - bits}"
    once = "true" if wide else f"not ({earlier})"
    met = x.join(y, F.expr(f"k = k2 and key = key2 and x.fp < y.fp and {tally} and bit_count(x.fp ^ y.fp) <= {bits} and {once}"))
    found = met.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    return found.distinct() if wide else found


def grouped(own: DataFrame, bits: int = BITS) -> DataFrame:
    """own with label and component_id; own: a stored table with id and fp."""
    classes = own.groupBy("fp").agg(F.min("id").alias("least"))
    wide = classes.count() > WIDE_FROM
    label = components(links(classes.select("fp"), bits, wide))
    classes = classes.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    return own.join(classes.join(least, "label").select("fp", "label", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(id, fingerprint, component_id): one row per document, component_id the smallest id reachable over links."""
    out = grouped(stored(fingerprints(docs, id_col, text_col).select("id", "fp"), "simhash"), bits)
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingles(col: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text; never empty."""
    data, off = string_bytes(col)
    data = LOWER[data]
    first, last, at = split_words(data, off, WORD)
    h = word_hashes(data, first, last)
    out = []
    for a, z in zip(at[:-1], at[1:]):
        own = gram_hashes(h[a:z], min(size, z - a)) if z > a else np.zeros(1, np.uint64)
        out.append(np.unique(own))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(node, bands) of sets: a hash of the set, and one of each band's minima."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    size = np.array([len(s) for s in sets], np.uint64)
    node = mixed(np.add.reduceat(mixed(flat), starts) + size)
    bands = np.zeros((len(sets), BANDS), np.uint64)
    for i in range(BANDS * ROWS):
        x = flat * TIMES[i]
        x += PLUS[i]
        x ^= x >> np.uint64(31)
        x *= TIMES[-1 - i]
        b = i // ROWS
        bands[:, b] = mixed(bands[:, b] * np.uint64(3) + np.minimum.reduceat(x, starts) + np.uint64(i))
    return node.view(np.int64), bands.view(np.int64)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """``SKETCH`` longs of each set: a bit is the parity of the shingles that fall to it, so that two sets differ in at
    least as many shingles as their sketches do in bits."""
    odd = np.stack([np.bincount((s.view(np.uint64) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1 for s in sets]).astype(np.uint8)
    return np.packbits(odd, axis=1).view(np.int64)


def alike(pairs: DataFrame, sets: DataFrame, least: float = LEAST) -> DataFrame:
    """Of pairs (a, b) of nodes, those whose sets are similar enough."""
    x, y = sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    near = pairs.join(x.withColumn("nx", F.size("x")), "a").join(y.withColumn("ny", F.size("y")), "b")
    near = near.where(F.least("nx", "ny") >= least * F.greatest("nx", "ny"))
    both = F.size(F.array_intersect("x", "y"))
    return near.where(both >= least * (F.col("nx") + F.col("ny") - both)).select("a", "b")


def rarest(sets: DataFrame, least: float = LEAST) -> DataFrame:
    """(key, node, n, place): the shingles under which a set must meet any other of the least similarity, its size n, and
    how many of its shingles are rarer."""
    each = sets.select("node", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    common = each.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    own = each.join(common, "gram").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("of"))
    # the set's unique shingles come before these
    first = F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1 - (F.col("n") - F.size("of"))
    found = own.where(first > 0).select(F.posexplode(F.slice("of", F.lit(1), first.cast("int"))).alias("i", "k"), "node", "n", (F.col("n") - F.size("of")).alias("unique"))
    return found.select(F.col("k.gram").alias("key"), "node", "n", (F.col("i") + F.col("unique")).alias("place"))


def among(rows: DataFrame, texts: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """rows (text_hash, text) without most of those whose hash is none of texts', a stored table, and with all others.

    A Bloom filter of 16 bits a text, ``most`` in all: the join that follows decides, but need not send every text. With
    more texts than the filter has room for more rows stay, none is lost.
    """
    bits = min(most, max(1 << 16, 1 << (16 * texts.count()).bit_length()))
    places = texts.select(F.explode(F.array(F.pmod("text_hash", F.lit(bits)), F.pmod(F.shiftright("text_hash", 32), F.lit(bits)))).alias("b"))
    words = places.groupBy(F.shiftright("b", 3).cast("int").alias("w")).agg(F.expr("bit_or(shiftleft(1, cast(b & 7 as int)))").cast("int").alias("m")).toArrow()
    table = np.zeros(bits >> 3, np.uint8)
    table[words["w"].to_numpy()] = words["m"].to_numpy().astype(np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        t = shared.value
        for b in batches:
            h = b.column(0).to_numpy()
            x, y = h & (bits - 1), (h >> 32) & (bits - 1)
            yield b.filter(pa.array(((t[x >> 3] >> (x & 7).astype(np.uint8)) & (t[y >> 3] >> (y & 7).astype(np.uint8)) & 1).astype(bool)))

    return rows.mapInArrow(run, rows.schema)


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """(id, text_hash, node, label): one row per row of docs; label is the same for all rows of a group."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).cast("string").alias("text"))

    def sign(batches):
        for b in batches:
            for lo, hi in slices(b.column(2), 1 << 18):
                part = b.slice(lo, hi - lo)
                node, bands = signatures(shingles(part.column(2), shingle))
                fp = np.array([fingerprint(t, shingle) for t in part.column(2).to_pylist()], np.uint64).view(np.int64)
                values = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS), pa.int32()), pa.array(bands.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(node), pa.array(fp), values], names=["id", "text_hash", "node", "fp", "bands"])

    own = stored(rows.mapInArrow(sign, f"id {kind}, text_hash long, node long, fp long, bands array<long>"), "signed")
    # equal sets may have unequal fingerprints (these count repeats), so a node may stand in several classes
    of_fp = stored(own.select("fp", "node").distinct(), "classes")
    first = of_fp.groupBy("fp").agg(F.min("node").alias("a"))
    same = of_fp.join(first, "fp").where("node <> a").select("a", F.col("node").alias("b"))
    met = links(first.select("fp"), BITS, first.count() > WIDE_FROM).toDF("x", "y")
    near = met.join(first.toDF("x", "n1"), "x").join(first.toDF("y", "n2"), "y").where("n1 <> n2").select(F.least("n1", "n2").alias("a"), F.greatest("n1", "n2").alias("b"))
    # rows of one node give equal keys, which minima and distinct nodes do not mind
    keyed = own.select("node", F.posexplode("bands").alias("k", "v")).select("node", F.xxhash64("k", "v").alias("key"))
    lead = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("key")
    simhash_pairs = stored(same.union(near), "near")
    used = keyed.join(lead, "key").select("node").union(simhash_pairs.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    texts = stored(own.select("node", "text_hash").join(used, "node", "left_semi").groupBy("node").agg(F.min("text_hash").alias("text_hash")), "texts")
    picked = among(rows.select("text_hash", "text"), texts).join(texts, "text_hash").dropDuplicates(["node"]).select("node", "text")

    def expand(batches):
        for b in batches:
            for lo, hi in slices(b.column(1), 1 << 20):
                sets = [s.view(np.int64) for s in shingles(b.column(1)[lo:hi], shingle)]
                values = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets)))
                sketch = sketches(sets)
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], values, *(pa.array(sketch[:, i].copy()) for i in range(SKETCH))], names=["node", "grams", *marks])

    marks = [f"s{i}" for i in range(SKETCH)]
    sets = stored(picked.mapInArrow(expand, "node long, grams array<long>, " + ", ".join(f"{m} long" for m in marks)), "grams")
    shared = stored(rarest(sets, least), "rarest")
    lead = shared.groupBy("key").agg(F.min(F.struct("node", "n")).alias("l"), F.count("*").alias("c")).where("c > 1").select("key", F.col("l.node").alias("a"), F.col("l.n").alias("m"))
    size = F.least("m", "n") >= least * F.greatest("m", "n")
    hubs = shared.join(lead, "key").where((F.col("node") != F.col("a")) & size).select("a", F.col("node").alias("b"))
    found = stored(alike(simhash_pairs.union(hubs).distinct(), sets, least), "links")
    label = components(found)
    named = shared.join(label, "node", "left").select("key", "node", "n", "place", F.coalesce("label", "node").alias("label"))
    split = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    named = stored(named.join(split, "key").join(sets.select("node", *marks), "node"), "split")
    y = named.select("key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("place").alias("other_place"), F.col("label").alias("other"), *[F.col(c).alias(f"o{c}") for c in marks])
    # of two sets so similar at most this share of their shingles differ
    apart = F.expr(" + ".join(f"bit_count({c} ^ o{c})" for c in marks)) <= (F.col("n") + F.col("m")) * ((1 - least) / (1 + least)) + 1e-9
    # from the rarest shingle in both on, enough must be left for all that they share
    left = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("other_place")) >= (F.col("n") + F.col("m")) * (least / (1 + least)) - 1e-9
    more = named.withColumnRenamed("node", "a").join(y, "key").where((F.col("label") < F.col("other")) & size & left & apart).select("a", "b").distinct()
    label = components(found.union(alike(more, sets, least)))
    label = own.select("node").distinct().join(label, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    return own.select("id", "text_hash", "node").join(label, "node")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """docs without all but one row of each group of ``similar``: the row with the smallest id stays, of rows that share
    it the one of least text hash. A null id comes after all others; rows of other groups never matter."""
    return survivors(docs, similar(docs, id_col, text_col, least, shingle), id_col, text_col)


def survivors(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group; groups: (id, text_hash, label) of every row."""
    groups = stored(groups.select("id", "text_hash", "label"), "groups")
    first = groups.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("r"))
    first = first.select(F.col("label").alias("_label"), F.col("r.id").alias("_id"), F.col("r.text_hash").alias("_hash"))
    repeated = groups.groupBy("id", "text_hash").count().where("count > 1").limit(1).count()
    names = [f"c{i}" for i in range(len(docs.columns))]  # the columns of docs may have any names
    own, key, text = docs.toDF(*names), names[docs.columns.index(id_col)], names[docs.columns.index(text_col)]
    kept = own.join(first, F.col(key).eqNullSafe(F.col("_id")) & (text_hash(F.col(text)) == F.col("_hash")))
    return (kept.dropDuplicates(["_label"]) if repeated else kept).select(*names).toDF(*docs.columns)
