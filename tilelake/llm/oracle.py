"""DuckDB's SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
AHEAD = "list(word) over (partition by {0} order by i rows between current row and 9 following)"

#: Windows of ten words, or an item's own number of words if it has fewer, met as strings.
DECONTAMINATE = f"""with d as (select row_number() over () as r, doc_id, {WORDS} as w from documents),
 b as (select row_number() over () as r, item_id, {WORDS} as w from benchmark),
 dw as (select r, i, {AHEAD.format('r')} as l from (select r, unnest(w) as word, generate_subscripts(w, 1) as i from d)),
 bw as (select r, i, {AHEAD.format('r')} as l from (select r, unnest(w) as word, generate_subscripts(w, 1) as i from b)),
 items as (select distinct item_id, least(len(w), 10) as k, array_to_string(l[1:least(len(w), 10)], ' ') as g from bw join b using (r) where len(l) >= least(len(w), 10)),
 hits as (select dw.r, i, k, item_id from dw, (select distinct k from items) ks join items using (k) where len(l) >= k and array_to_string(l[1:k], ' ') = g),
 places as (select r, count(distinct p) as n_hit from (select r, i + unnest(range(0, k)) as p from hits) group by r),
 named as (select r, count(distinct item_id) as n_items, sha256(string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar))) as h from hits where item_id is not null group by r)
 select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, coalesce(h, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
 from d left join places using (r) left join named using (r)"""

_FIVE = "cast('0x' || substr(h, 5*{0}+1, 5) as bigint)"
_DIGITS = " || ".join(f"substr('{UPPER}234567', cast(({_FIVE.format(i)} >> {s}) & 31 as int)+1, 1)" for i in range(8) for s in (15, 10, 5, 0))

#: Equal payloads by their text; SHA-1 in base 32 from its hex digits, five at a time.
WARC = f"""with p as (select page_id, coalesce(html, '') as t from pages), f as (select t, min(page_id) as first from p group by t), s as (select page_id, t, first, sha1(t) as h from p join f using (t))
 select page_id, strlen(t) as payload_bytes, {_DIGITS} as payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from s"""

#: All pairs of a label, and components by a recursive query.
EMBEDDINGS = """with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings where label is not null and len(embedding) > 0
   and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
 l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.98),
 c(n, root) as (select vec_id, vec_id from embeddings union select l.b, c.root from c join l on l.a = c.n where c.root < l.b),
 m as (select n, min(root) as component_id from c group by n), k as (select a, count(*) as n_links from l group by a)
 select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept from embeddings join m on n = vec_id left join k on a = vec_id"""

ORACLE_SQL = {"op3_decontaminate": DECONTAMINATE, "op4_warc": WARC, "op7_embeddings": EMBEDDINGS}

_FIELDS = lambda text: " || ".join(f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in ("doc_id", "source", "lang", "n_chars", text))
#: CRC-32 of a text of ASCII letters: a step for each bit, a mark of -1 stands for one.
_CRC = "xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295)"
#: Levels that are enough for eight to their power rows.
_LEVELS = 10


def _tree(first: str, key: str, p: str) -> str:
    """CTEs {p}0.. of the levels of each group: digest, what stands left and right in its run, and whether it goes up."""
    runs = f"partition by {key}, pos // 8 order by pos rows between"
    seen = f"coalesce(string_agg(digest, '') over ({runs} unbounded preceding and 1 preceding), '') as l, coalesce(string_agg(digest, '') over ({runs} 1 following and unbounded following), '') as r, count(*) over (partition by {key}) > 1 as up"
    out = [f"{p}0 as (select {key}, pos, digest, {seen} from {first})"]
    for k in range(1, _LEVELS + 1):
        out.append(f"{p}{k} as (select {key}, pos, digest, {seen} from (select {key}, case when up then pos // 8 else pos end as pos, case when up then sha256(string_agg(digest, '' order by pos)) else min(digest) end as digest from {p}{k - 1} group by {key}, up, 2))")
    return ",\n ".join(out)


def _climb(p: str, key: str, source: str, name: str) -> str:
    """CTE of source (row, {key}, pos, proof, fold) with the path of its node added to both."""
    out, last = [], source
    for k in range(_LEVELS):
        out.append(f"{name}{k} as (select s.row, s.{key}, case when t.up then s.pos // 8 else s.pos end as pos, case when t.up then proof || t.l || t.r else proof end as proof, case when t.up then sha256(t.l || fold || t.r) else fold end as fold from {last} s join {p}{k} t on s.{key} = t.{key} and s.pos = t.pos)")
        last = f"{name}{k}"
    return ",\n ".join(out)


#: Levels of eight, one CTE each, first of languages and then of their subroots.
MERKLE = f"""with d as (select row_number() over () as row, *, coalesce('=' || lang, '') as g, sha256({_FIELDS('text')}) as leaf,
  sha256({_FIELDS(f"translate(text, '{UPPER}', '{LOWER}')")}) as other, doc_id is not null and {_CRC} % 3 = 0 as hit from documents),
 n as (select row, g, row_number() over (partition by g order by doc_id nulls first, leaf, row) - 1 as pos, leaf as digest, case when hit then other else leaf end as fold, '' as proof from d),
 {_tree('n', 'g', 'a')},
 sub as (select g, digest from a{_LEVELS}), m as (select 0 as k, g, row_number() over (order by g) - 1 as pos, digest from sub),
 {_tree('m', 'k', 'b')},
 {_climb('a', 'g', 'n', 'c')},
 up as (select row, 0 as k, m.pos as pos, proof, fold from c{_LEVELS - 1} c join m using (g)),
 {_climb('b', 'k', 'up', 'e')}
 select doc_id, leaf, sub.digest as subroot, b.digest as root, sha256(e.proof) as proof_sha256, e.fold as folded_root, e.fold = b.digest as verified
 from d join sub using (g) join e{_LEVELS - 1} e using (row) cross join b{_LEVELS} b"""

ORACLE_SQL["op12_merkle"] = MERKLE
