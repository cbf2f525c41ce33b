import collections
import random
import re

from tilelake.llm import html as h


def text(page):
    inside, undecided, marked = h.blocks(page)
    return "\n\n".join(inside if marked else inside + undecided)


PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head>
<body class="has-sidebar"><nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- <p>comment --><div class="ad">buy</div><header>head</header>
<article><h1>Title</h1><p><b>One
  two<br>three<p>Four &lt;b&gt; &eacute;&#33; 1 < 2</p><form>name <input></form><div id="cookie-notice">ok?</div><ul><li>a<li>b <i>c</i>d</ul>
<aside>side</aside><table><tr><td>x<td>y</table><section class="comments"><p>nice</p></section><p hidden>gone</p><p>last</article>
<p>outside</p><footer>&copy; f</footer></body>"""


def test_article():
    assert text(PAGE) == "Title\n\nOne two three\n\nFour <b> é! 1 < 2\n\na\n\nb cd\n\nx y\n\nlast"


def test_truncated_and_odd():
    assert text("<article><p>a<script>x") == "a"
    assert text("<article><p>a <p class=") == "a"
    assert text('<article><p>a<a href="x>b</p>') == "a"
    assert text("<article><p>a<!-- b") == "a"
    assert text("") == "" and text("plain  text") == "plain text" and text("<p></p></div></article>") == ""
    assert text("<main>m<div>n<nav>o</main>p") == "m\n\nn"
    assert text("<article><span>a</span><em>b</em> c &am &amp d</article>") == "ab c &am & d"
    assert text("<article>x<article class='comment'>y</article>z</article>") == "x\n\nz"
    assert text("<article><p>" + "<b>" * 3000 + "deep</article>") == "deep"


def test_url_hosts():
    assert [h.host(u) for u in ("http://u@A.b:80/x", "https://c?x", "no", None)] == ["a.b", "c", "", ""]


def brute(rows, run, least, share):
    """The definition by sets: all windows of all streams of a host against each other."""
    out, open_ = [], {}
    for i, u, p in rows:
        inside, undecided, marked = h.blocks(p or "")
        if marked or not undecided:
            out.append((i, "\n\n".join(inside)))
        else:
            open_.setdefault(h.host(u), []).append((i, undecided))

    def windows(blocks):
        flat = [t for b in blocks for t in b.split()]
        return [tuple(flat[k : k + run]) for k in range(max(1, len(flat) - run + 1))]

    def stripped(blocks, gone):
        """Blocks without covered tokens, and the runs left of the stream."""
        flat = [t for b in blocks for t in b.split()]
        dead = {k + d for k, w in enumerate(windows(blocks)) if w in gone for d in range(run)}
        marks = "".join(" " if k in dead else "x" for k in range(len(flat)))
        own = [tuple(flat[m.start() : m.end()]) for m in re.finditer("x+", marks) if m.end() - m.start() >= run]
        kept, at = [], 0
        for b in blocks:
            n = len(b.split())
            kept.append(" ".join(flat[k] for k in range(at, at + n) if k not in dead))
            at += n
        return [k for k in kept if k], own

    for pages in open_.values():
        streams = {tuple(u): set(windows(u)) for _, u in pages}
        met = collections.Counter(w for ws in streams.values() for w in ws)
        own = {u: tuple(stripped(u, {w for w in ws if met[w] > 1})[1]) for u, ws in streams.items()}
        voices = {o for o in own.values() if o}
        said = {w: {own[u] for u, ws in streams.items() if w in ws and own[u]} for w in met if met[w] > 1}
        gone = {w for w, o in said.items() if len(o) >= least and len(o) * share >= len(voices)}
        for i, u in pages:
            kept, left = stripped(u, gone)
            out.append((i, "\n\n".join(kept if left or not gone & streams[tuple(u)] else u)))
    return sorted(out)


def test_hosts_against_brute_force(spark):
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(60)}"
    shared = [" ".join(word() for _ in range(n)) for n in (3, 8, 20)]
    rows = []
    for i in range(60):
        body = "".join(f"<div>{rng.choice([*shared, ' '.join(word() for _ in range(rng.randrange(25)))])}</div>" for _ in range(rng.randrange(6)))
        rows.append((i, f"http://h{rng.randrange(3)}.org/{i}", f"<body>{body}</body>" if i % 9 else f"<article>{body}</article>"))
    rows += [(100, "http://h1.org/copy", rows[1][2]), (101, None, None), (102, None, ""), (103, rows[2][1], rows[2][2])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, n_chars int")
    for least, share in ((2, 50), (3, 50), (2, 4)):
        got = h.extracted(df, run=4, least=least, share=share)
        assert sorted((r.page_id, r.text) for r in got.collect()) == brute(rows, 4, least, share)
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert h.extracted(df.limit(0)).count() == 0


def test_names_around_and_inside_an_article():
    for around in ('<div class="layout with-sidebar">', '<div class="page no-ads">', '<div class="content has-sidebar">', '<div id="banner">', '<div class="ad-box"><p>buy</p>'):
        assert text(f"<body>{around}<article><p>story</p></article></div></body>") == "story"
    inside = '<article><h2 class="section-header">Part</h2><p>x <math><mi>y</mi></math></p><div class="cookie-banner">ok?</div><div class="site_footer">f</div><p class="share-buttons">s</p></article>'
    assert text(inside) == "Part\n\nx y"
    assert text('<aside><article>side</article></aside><p>text</p>') == "text"


def test_minor_articles_do_not_hide_the_page():
    story = "<div><p>" + "a long story " * 20 + "</p></div>"
    assert text(f"<main></main>{story}") == ("a long story " * 20).strip()
    assert text(f"{story}<article>teaser</article>").startswith("a long story")
    assert h.blocks(f"<article>{story}</article><p>outside</p>")[2]


def test_very_long_page():
    page = "<article>" + "<p>one two</p>" * 50_000 + "</article>"
    assert len(h.blocks(page)[0]) == 50_000


def test_links_and_structure_decide_not_length():
    menu = "<ul>" + "<li><a href='/x'>some menu entry</a></li>" * 60 + "</ul>"
    related = "<div>related stories of all kinds, " + "teased at length " * 60 + "</div>"
    short = "<article><h1>Title</h1><p>Short text.</p></article>"
    assert text(f"<body>{menu}{short}{related}</body>") == "Title\n\nShort text."
    cards = "<article><h3><a href='/1'>One</a></h3><p>teaser</p></article>" * 3
    assert text(f"<body>{short}{cards}</body>") == "Title\n\nShort text."
    assert text(f"<body><div><p>story {'of words ' * 9}</p></div>{cards}</body>").startswith("story of words")
    assert text(f"<article><h1><a href='/me'>Own title</a></h1><p>{'text ' * 9}</p></article>{related}").startswith("Own title\n\ntext")
    assert h.blocks(f"<body>{menu}<p>a story with <a href='/y'>one link</a></p>")[1] == ["a story with one link"]
    assert text("<article><p><a href='/1'>only</a></p></article><p>prose outside</p>") == "only\n\nprose outside"


def test_near_copies_keep_their_text(spark):
    story = [f"s{i}" for i in range(60)]
    pages = [" ".join(story), " ".join([*story[:30], "other", *story[31:]])]
    menu = "home news sport weather contact imprint search help more"
    own = [" ".join(f"p{k}w{i}" for i in range(20)) for k in range(5)]
    rows = [(i, "http://a.org/", f"<p>{p}</p>") for i, p in enumerate(pages)]
    rows += [(10 + i, "http://b.org/", f"<div>{menu}</div><p>{p}</p>") for i, p in enumerate(pages + own)]
    rows += [(20, "http://b.org/menu", f"<div>{menu}</div>")]
    got = {r.page_id: r.text for r in h.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**dict(enumerate(pages)), **{10 + i: p for i, p in enumerate(pages + own)}, 20: menu}


def test_markup_against_a_walk_of_the_tree():
    """Random trees, written as HTML with what may be left out left out, against a walk of the tree itself."""
    rng = random.Random(4)
    count = iter(range(10**9))

    def inline(depth):
        parts = [f"w{next(count)} & <{next(count)}>"]
        while depth and rng.random() < 0.4:
            parts.append((rng.choice("b i em span code".split()), inline(depth - 1)))
        return parts

    def block(depth):
        kind = rng.choice(["p", "div", "ul", "blockquote", "section", "table"] if depth else ["p"])
        if kind == "p" or not depth:
            return (kind, inline(2))
        if kind == "ul":
            return (kind, [("li", inline(1)) for _ in range(rng.randrange(1, 4))])
        if kind == "table":
            return (kind, [("tr", [("td", inline(1)) for _ in range(rng.randrange(1, 3))]) for _ in range(rng.randrange(1, 3))])
        out = [block(depth - 1) for _ in range(rng.randrange(1, 4))]
        if rng.random() < 0.3:
            out.insert(rng.randrange(len(out) + 1), (rng.choice("nav aside footer form header script style".split()), ["gone"]))
        return (kind, out)

    def write(node):
        if isinstance(node, str):
            return node.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&#62;")
        name, children = node
        end = "" if name in ("li", "tr", "td") and rng.random() < 0.5 else f"</{name}>"
        return f"<{name}{rng.choice(['', ' class=plain', ' data-x=\"a>b\"'])}>" + "".join(map(write, children)) + end

    def walk(node, lines):
        if isinstance(node, str):
            lines[-1] += node
            return
        name, children = node
        if name in h.DROPPED | h.RAW:
            lines.append("")
            return
        if name in h.BLOCK:
            lines.append("")
        for c in children:
            walk(c, lines)
        if name == "td":
            lines[-1] += " "
        if name in h.BLOCK:
            lines.append("")

    for _ in range(200):
        tree = ("article", [block(3) for _ in range(rng.randrange(1, 5))])
        lines = [""]
        walk(tree, lines)
        page = f"<html><body><nav>menu</nav><p>before</p>{write(tree)}<p>after</p></body></html>"
        assert h.blocks(page)[0] == [" ".join(x.split()) for x in lines if x.strip()]


def test_suffix_order_and_prefixes():
    heads = h.suffixes(["a b", "c\x01 a b d"], 3)
    assert heads == ["a b c\x01 ", "b c\x01 a ", "c\x01 a b ", "a b d "]
    assert h.suffixes(["a"], 3) == ["a "] and h.suffixes([], 3) == []
    rng = random.Random(2)
    found = sorted(s for _ in range(40) for s in h.suffixes([" ".join(rng.choice(["a", "ab", "a\x01", "b"]) for _ in range(9))], 4))
    for k in (1, 2, 3):
        first = [s.split()[:k] for s in found]
        assert all([h.prefix(x, y) >= k for x, y in zip(found, found[1:])][i] == (first[i] == first[i + 1]) for i in range(len(first) - 1))
        assert sum(x != y for x, y in zip(first, first[1:])) + 1 == len({tuple(f) for f in first})


def test_repeats_across_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), False, f"{rng.choice(['often often'] * 8 + [f'w{i}' for i in range(300)])} a ", 0, rng.randrange(200), i, 2) for i in range(3000)]
    rows += [("x", True, "often often a ", rest, s, 0, 9) for rest, s in ((1, 1), (1, 2), (2, 3), (3, 4), (3, 4))]
    df = spark.createDataFrame(rows, "host string, marked boolean, head string, rest long, stream long, place int, size int")
    streams = collections.defaultdict(set)
    for r in rows:
        streams[r[:4]].add(r[4])
    want = collections.Counter((r[0], r[1], r[4], r[5]) for r in rows if len(streams[r[:4]]) > 1)
    got = h.repeats(df, 2)
    assert collections.Counter((r.host, r.marked, r.stream, r.place) for r in got.collect()) == want
    assert got.select("host", "marked", "repeat").distinct().count() == sum(len(s) > 1 for s in streams.values())


def test_notices_inside_articles(spark):
    notice = "Join our members today and read every story free"
    quote = "to be or not to be that is the question"
    words = lambda k, n: " ".join(f"p{k}w{i}" for i in range(n))
    rows = []
    for k in range(24):  # the notice on 14 of 24, a quote on 12
        middle = f"<p>{notice}</p>" * (k < 14) + f"<p>{quote}</p>" * (k % 2) + "<h2>What to know</h2>"
        rows.append((k, "http://a.org/", f"<article><h1>Title {k}</h1><p>{words(k, 30)}</p>{middle}<p>{words(-k, 30)}</p></article>"))
    rows.append((100, "http://a.org/copy", rows[0][2]))
    rows += [(200 + k, f"http://b{k}.org/", rows[k][2]) for k in range(14)]
    story = [f"s{i} " * 12 for i in range(6)]
    rows += [(300 + k, "http://c.org/", "<article>" + "".join(f"<p>{s}{f' edit{k}' if i == k % 6 else ''}</p>" for i, s in enumerate(story)) + "</article>") for k in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in h.extracted(df).collect()}
    for i, u, p in rows:
        blocks = h.blocks(p)[0]
        assert got[i] == "\n\n".join(b for b in blocks if b != notice or not u.startswith("http://a.org")), i
    assert sum(notice in t for t in got.values()) == 14 and quote in got[1] and len(got) == len(rows)
