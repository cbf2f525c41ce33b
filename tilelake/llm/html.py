"""Main text of web pages: markup first, then a suffix array of each host's blocks, through which every page goes.

Where a page marks its article (``article`` or ``main``), the blocks inside are its text, without those in menus,
headers, footers, sidebars, notices, adverts, forms and comments; what stands outside is not, however long. Structure
and links tell whether an element marks the article: less than half of its characters are links, and an ``article`` has
blocks of its own and is no teaser, whose headings are all links. If none is so, an only ``article`` with linked headings
counts, and any where nothing but links stands outside. Of other pages all blocks outside of layout are undecided, save
three or more in a row that are links by half or more (a menu): their tokens, end to end, are the page's stream.

The suffixes of a host's streams are sorted by their first ``RUN`` tokens, and neighbours with so long a prefix in common
make a repeat. What no other page has in runs of ``RUN`` tokens or more is a page's own. A substring is boilerplate if it stands on ``PAGES`` pages or
more, and on a ``SHARE`` of the host's, counting only pages with own runs, and those with the same own runs once:
pages that differ in less are copies of each other, whose text nothing makes boilerplate. Every token that boilerplate
covers goes and the unique runs stay. A page that would keep no run of ``RUN`` tokens keeps all.

An element is layout if its class, id or role has a name made of words of ``MARKS`` only, or of those and of ``PARTS``:
``cookie-banner`` and ``site-footer`` are, ``has-sidebar`` and ``section-header`` are not. Layout around the only article
of a page does not hide it. A header inside an article goes too, as the contract's list of headers has it.

Of a marked article the array holds a suffix at each block's begin, of all its tokens to the block's end: a block goes as a whole
or not at all. It is a notice, which goes, if it has ``RUN`` tokens or more and stands on ``NOTICE`` pages or more and over
half of the host's, counting only pages most of whose tokens stand in blocks that no other page has. Only those pages lose
blocks, so less than half of their text: copies, and articles that quote each other, stay whole.

Suffixes are sorted by Spark in ranges of (host, first tokens, stream), so a host or a repeat of any size is spread over all
tasks and no task holds a host. Longer substrings cover what their windows of RUN tokens cover, each of which stands on as
many pages or more, so a deeper order would take the same tokens of undecided text.

Defined cases: a null or empty html has empty text; truncated markup is read as browsers do, to the end of the page;
copies of one stream on a host are one page; a page without a host shares one with its like; repeated rows are
extracted row by row; an empty table gives no rows; other columns are ignored. A very long page is read whole by the task
that has it. Of several articles of equal standing all count.
"""

from __future__ import annotations

import html as entities
import itertools
import re
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import stored

RUN = 8
#: Pages with own text that make a run of theirs boilerplate: this many, and one in so many of their host's.
PAGES, SHARE = 3, 50
#: Pages, and more than half of their host's, that make a whole block inside their articles a notice.
NOTICE = 10
TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
NAMES = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
HIDDEN = re.compile(r"(?:^|[\s\"'])(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
#: Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
SPACED = set("br td th option".split())
ARTICLE = re.compile(r"<(?:article|main)[\s/>]", re.I)
DROPPED = set("aside audio button canvas datalist dialog fieldset footer form head header iframe menu nav noscript object search select svg template video".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}
P_STOPS = {"html", "table", "td", "th", "caption", "button", "object", "template"}
#: Words of class, id and role that mark what is not the article.
MARKS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies dialog disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted related replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split())
#: Words that may stand beside them in a name.
PARTS = set("area articles bar block bottom box btn button buttons container content form global group inner item items left link links list main page panel policy post posts primary right secondary site slot top unit user wrap wrapper".split())
COMMENTS = {"comment", "comments", "reply", "replies", "disqus"}


def layout(attrs: str, marks: set) -> bool:
    """Whether a name among an element's classes, id and role says that it is layout."""
    for _, value in NAMES.findall(attrs):
        for name in value.lower().strip("\"'").split():
            words = set(filter(None, re.split(r"[^a-z]+", name)))
            if words & marks and words <= marks | MARKS | PARTS:
                return True
    return False


class Block(NamedTuple):
    text: str
    article: int  # number of the outermost article or main around it, 0 for none
    size: int  # characters but white space
    linked: int  # of them in links
    place: str  # the block element that it stands in


def blocks(page: str) -> tuple[list[str], list[str], bool]:
    """(blocks inside the article, other blocks or undecided ones, whether the page marks an article), in page order."""
    found, names = _blocks(page, False)
    if not any(b.article for b in found) and ARTICLE.search(page):
        found, names = _blocks(page, True)
    chosen = _articles(found, names)
    if chosen:
        return [b.text for b in found if b.article in chosen], [b.text for b in found if b.article not in chosen], True
    kept: list[str] = []
    for linked, row in itertools.groupby(found, lambda b: 2 * b.linked >= b.size):
        run = [b.text for b in row]
        kept += run if not linked or len(run) < 3 else []
    return [], kept, False


def _articles(found: list[Block], names: dict[int, str]) -> set[int]:
    """Numbers of the articles that are the page's text."""
    parts: dict[int, list[Block]] = {}
    for b in found:
        parts.setdefault(b.article, []).append(b)
    outside = parts.pop(0, [])
    prose = {a for a, bs in parts.items() if 2 * sum(b.linked for b in bs) < sum(b.size for b in bs)}
    formed = {a for a in prose if names[a] == "main" or any(b.place not in ("article", "main") for b in parts[a])}

    def teaser(a: int) -> bool:
        heads = [b for b in parts[a] if b.place in HEADINGS]
        return names[a] != "main" and bool(heads) and all(2 * b.linked >= b.size for b in heads)

    full = {a for a in formed if not teaser(a)}
    if full:
        return full
    if all(2 * b.linked >= b.size for b in outside):
        return prose
    return formed if len(parts) == 1 else set()


def _blocks(page: str, through: bool) -> tuple[list[Block], dict[int, str]]:
    """Blocks outside of layout, in page order, and the names of articles by number; through: articles show even inside
    of elements whose names say layout."""
    found: list[Block] = []
    names: dict[int, str] = {}
    stack: list[tuple[str, int, int, bool]] = []  # name; dropped: 0 no, 1 by a name, 2 by the element itself; article; link
    held: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                place = next((x[0] for x in reversed(stack) if x[0] in BLOCK), "")
                found.append(Block(text, stack[-1][2] if stack else 0, len(text) - text.count(" "), linked, place))
            linked = 0

    def unwind(to: int) -> None:
        """Closes what is open from this place of the stack on."""
        if any(x[0] in BLOCK for x in stack[to:]) or any(x[1:3] != (stack[to - 1][1:3] if to else (0, 0)) for x in stack[to:]):
            flush()
        del stack[to:]

    def find(names: set, stops: set) -> int | None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in stops:
                return None
        return None

    at = 0
    while at < len(page):
        m = TAG.search(page, at)
        start = m.start() if m else len(page)
        if start > at and not (stack and stack[-1][1]):
            held.append(entities.unescape(page[at:start]))
            if stack and stack[-1][3]:
                linked += sum(map(len, held[-1].split()))
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name in SPACED:
                held.append(" ")
            if name in BLOCK:
                i = find({name}, P_STOPS - {name} if name == "p" else {"html"} - {name})
            else:
                i = find({name}, BLOCK)
            if i is not None:
                unwind(i)
            continue
        if name in BLOCK and name not in ("body", "html", "head"):
            if (i := find({"p"}, P_STOPS)) is not None:
                unwind(i)
        if name == "body" and (i := find({"head"}, set())) is not None:
            unwind(i)
        if name in CLOSES and (i := find(*CLOSES[name])) is not None:
            unwind(i)
        if name in BLOCK:
            flush()
        elif name in SPACED:
            held.append(" ")
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            continue
        if name in VOID:
            continue
        dropped, article, link = stack[-1][1:] if stack else (0, 0, False)
        opens = name in ("article", "main")
        new_drop = 0 if through and opens and dropped == 1 else dropped
        new_article = article
        if opens and not article and not new_drop:
            new_article = len(names) + 1
            names[new_article] = name
        attrs = m[3]
        if not new_drop and attrs.strip() and name not in ("html", "body"):
            new_drop = 2 if HIDDEN.search(attrs) else int(layout(attrs, COMMENTS if opens else MARKS))
        if name in DROPPED:
            new_drop = 2
        if (new_drop, new_article) != (dropped, article):
            flush()
        stack.append((name, new_drop, new_article, "href" in attrs.lower() if name == "a" else link))
    flush()
    return found, names


def host(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url or "")
    return m[1].rpartition("@")[2].partition(":")[0].lower() if m else ""


def suffixes(parts: list[str], run: int = RUN) -> list[str]:
    """First run tokens (all, if they are fewer) of every suffix of the blocks end to end, a space after each token, so
    that suffixes with any number of first tokens in common stand together in the order of these strings."""
    flat = [t for p in parts for t in p.split()]
    return ["".join(f"{t} " for t in flat[i : i + run]) for i in range(max(1, len(flat) - run + 1))] if flat else []


def block_suffixes(parts: list[str], run: int = RUN) -> list[tuple[str, int, int, int]]:
    """(first run tokens, hash of the block's other tokens, block number, tokens) of the suffix at each block's begin, to the
    block's end; of blocks of run tokens or more."""
    found = []
    for i, p in enumerate(parts):
        t = p.split()
        if len(t) >= run:
            found.append(("".join(f"{x} " for x in t[:run]), _hash(t[run:]), i, len(t)))
    return found


def prefix(a: str, b: str) -> int:
    """How many first tokens two suffixes of ``suffixes`` have in common."""
    return a.count(" ") if a == b else commonprefix((a, b)).count(" ")


def _hash(parts: list[str]) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts).encode()) - (1 << 63)


def _runs(tokens: list[list[str]], repeated: set[int], run: int) -> tuple[list[list[str]], list[list[str]]]:
    """Tokens of each block that no repeated substring of run tokens covers, and the stream's runs of them; repeated:
    the places where those substrings begin."""
    left, own, place, covered, open_ = [], [], 0, -1, False
    for block in tokens:
        kept = []
        for t in block:
            if place in repeated:
                covered = place + run
            if place >= covered:
                kept.append(t)
                if not open_:
                    own.append([])
                own[-1].append(t)
            open_ = place >= covered
            place += 1
        left.append(kept)
    return left, own


def own_text(parts: list[str], repeated: set[int], run: int = RUN) -> int | None:
    """Hash of a page's own runs of run tokens or more, of those that no other page has; null without any."""
    own = [r for r in _runs([p.split() for p in parts], repeated, run)[1] if len(r) >= run]
    return _hash([" ".join(r) for r in own]) if own else None


def unique_runs(parts: list[str], repeated: set[int], run: int = RUN) -> list[str]:
    """Blocks without the tokens that boilerplate covers, or all of them if no run of run tokens would be left."""
    if not repeated:
        return parts
    left, own = _runs([p.split() for p in parts], repeated, run)
    return [" ".join(k) for k in left if k] if any(len(r) >= run for r in own) else parts


def repeats(places: DataFrame, run: int = RUN) -> DataFrame:
    """(host, marked, repeat, stream, place, size): the places of the suffix array's repeats that stand in two streams of a
    host or more, repeat a number for each; places: (host, marked, head, rest, stream, place, size).

    The array is sorted in ranges that a repeat may cross, so that a frequent one is no one task's; what stands before a
    range's first suffix and after its last is not known there, so these two count as repeated until the streams of
    all ranges are compared.
    """
    order = ["host", "marked", "head", "rest", "stream", "place"]
    array = places.select(*order, "size").repartitionByRange(*order).sortWithinPartitions(*order)

    def neighbours(batches):
        def batch(rows):
            cols = list(zip(*[(r[0], r[1], _hash([r[2], str(r[3])]), *r[4:]) for r in rows]))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["host", "marked", "repeat", "stream", "place", "size"])

        types = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        last, given = None, False
        for b in batches:
            rows = []
            for row in zip(*[c.to_pylist() for c in b.columns]):
                long = last is None
                if last and row[:2] == last[:2] and row[3] == last[3]:
                    length = prefix(last[2], row[2])
                    long = length >= run or length == row[2].count(" ") == last[2].count(" ")
                if long and last and not given:
                    rows.append(last)
                if long:
                    rows.append(row)
                last, given = row, long
            if rows:
                yield batch(rows)
        if last and not given:
            yield batch([last])

    met = stored(array.mapInArrow(neighbours, "host string, marked boolean, repeat long, stream long, place int, size int"), "neighbours")
    several = met.groupBy("host", "marked", "repeat").agg(F.min("stream").alias("a"), F.max("stream").alias("z")).where("a <> z").select("host", "marked", "repeat")
    # both sides stored, so that a frequent repeat may be split
    return stored(met.join(stored(several, "repeated"), ["host", "marked", "repeat"]), "hits")


def notices(hits: DataFrame, pages: DataFrame, least: int) -> DataFrame:
    """(host, stream, repeated): numbers of the blocks inside articles that are their host's notices.

    hits: of marked pages; pages: (host, stream, tokens) of all of them.
    """
    hits = hits.select("host", "stream", "repeat", "place", "size").distinct()
    known = pages.distinct()
    echoes = hits.groupBy("host", "stream").agg(F.sum("size").alias("s")).join(known, ["host", "stream"]).where("2 * s >= tokens").select("host", "stream")
    voices = known.join(echoes, ["host", "stream"], "left_anti").groupBy("host").agg(F.count("*").alias("of"))
    said = stored(hits.join(echoes, ["host", "stream"], "left_anti"), "said")
    counts = said.groupBy("host", "repeat").agg(F.count_distinct("stream").alias("n")).where(F.col("n") >= least)
    often = counts.join(voices, "host").where("2 * n > of").select("host", "repeat")
    return said.join(often, ["host", "repeat"]).groupBy("host", "stream").agg(F.collect_set("place").alias("repeated"))


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN, least: int = PAGES, share: int = SHARE, notice: int = NOTICE) -> DataFrame:
    """(id, url, text, n_chars): one row per page."""
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))

    def parse(batches):
        for b in batches:
            of, hosts, marks, keys, sizes = [], [], [], [], []
            for u, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                inside, undecided, marked = blocks(h or "")
                parts = inside if marked else undecided
                of.append(parts)
                hosts.append(host(u))
                marks.append(marked)
                keys.append(_hash(parts))
                sizes.append(sum(len(p.split()) for p in parts))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hosts, pa.string()), pa.array(marks, pa.bool_()), pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(of, pa.list_(pa.string()))], names=["id", "url", "host", "marked", "stream", "tokens", "parts"])

    found = stored(rows.mapInArrow(parse, f"id {kind}, url string, host string, marked boolean, stream long, tokens long, parts array<string>"), "blocks")
    distinct = found.where("not marked and tokens > 0").dropDuplicates(["host", "stream"])

    def cut(batches):
        for b in batches:
            out = []
            for h, marked, stream, parts in zip(*[c.to_pylist() for c in b.columns]):
                own = block_suffixes(parts, run) if marked else [(head, 0, i, run) for i, head in enumerate(suffixes(parts, run))]
                out += [(h, marked, head, rest, stream, i, n) for head, rest, i, n in own]
            types = [pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            cols = list(zip(*out)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["host", "marked", "head", "rest", "stream", "place", "size"])

    texts = found.where("marked").select("host", "marked", "stream", "parts").union(distinct.select("host", "marked", "stream", "parts"))
    # not stored: made again for the sample of the ranges' bounds, which takes less than keeping them
    every = repeats(texts.mapInArrow(cut, "host string, marked boolean, head string, rest long, stream long, place int, size int"), run)
    hits = every.where("not marked").select("host", "repeat", "stream", "place")

    def covered(of: DataFrame) -> DataFrame:
        return of.groupBy("host", "stream").agg(F.collect_list("place").alias("repeated"))

    def owned(batches):
        for b in batches:
            own = [own_text(p, set(r or ()), run) for p, r in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own, pa.int64())], names=["host", "stream", "own"])

    own = distinct.join(covered(hits), ["host", "stream"], "left").select("host", "stream", "parts", "repeated")
    own = stored(own.mapInArrow(owned, "host string, stream long, own long").where("own is not null"), "own")
    sizes = own.groupBy("host").agg(F.count_distinct("own").alias("of"))
    counts = hits.join(own, ["host", "stream"]).groupBy("host", "repeat").agg(F.count_distinct("own").alias("n")).where(F.col("n") >= least)
    boilerplate = stored(counts.join(sizes, "host").where(F.col("n") * share >= F.col("of")).select("host", "repeat"), "boilerplate")
    said = notices(every.where("marked"), found.where("marked and tokens > 0").select("host", "stream", "tokens"), notice)
    at = stored(covered(hits.join(boilerplate, ["host", "repeat"])).withColumn("marked", F.lit(False)).unionByName(said.withColumn("marked", F.lit(True))), "places")

    def strip(batches):
        for b in batches:
            text = []
            for marked, parts, gone in zip(*[c.to_pylist() for c in b.columns[2:]]):
                gone = set(gone or ())
                kept = [p for i, p in enumerate(parts) if i not in gone] if marked else unique_runs(parts, gone, run)
                text.append("\n\n".join(kept))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], names=["id", "url", "text"])

    stripped = found.join(at, ["host", "marked", "stream"], "left").select("id", "url", "marked", "parts", "repeated").mapInArrow(strip, f"id {kind}, url string, text string")
    return stripped.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
