"""The same results in DuckDB's SQL, where SQL can express them over whole tables."""

from __future__ import annotations

#: Blanks that separate words and are stripped from lines.
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def shingle_sets(table: str, key: str, name: str) -> str:
    """Distinct five-word shingles of each row that has words."""
    return f"""
{name}_words as (
  select {key}, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') as w from {table}),
{name} as (
  select distinct {key}, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from {name}_words)"""


ORACLES: dict[str, str] = {}

ORACLES["op2_benchmark_leaks"] = f"""
with {shingle_sets("documents", "doc_id", "d")}, {shingle_sets("benchmark", "item_id", "b")},
sizes as (select item_id, count(*) as n_item from b group by 1),
pairs as (select doc_id, item_id, count(*) as n_shared from d join b using (s) group by 1, 2)
select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment
from pairs join sizes using (item_id) where n_shared * 100 >= n_item * 80"""

ORACLES["op5_line_dedup"] = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place from documents),
keys as (select *, {LOWER.format(f"trim(line, {BLANKS})")} as k from lines),
frequent as (select k from keys where k <> '' group by k having count(distinct doc_id) >= 10),
marked as (select doc_id, line, place, k in (select k from frequent) as gone from keys)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from marked group by doc_id"""

ORACLES["op6_ngram_jaccard"] = f"""
with recursive {shingle_sets("documents", "doc_id", "d")},
sizes as (select doc_id, count(*) as n from d group by 1),
pairs as (select x.doc_id as a, y.doc_id as b, count(*) as c from d x join d y on x.s = y.s and x.doc_id <> y.doc_id group by 1, 2),
links as (
  select a, b from pairs join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * c >= 80 * (p.n + q.n - c)),
reach as (
  select doc_id as v, doc_id as r from documents
  union select b, r from reach join links on a = v)
select doc_id, coalesce(any_value(n), 0) as n_shingles, min(r) as component_id
from documents left join sizes using (doc_id) join reach on v = doc_id group by doc_id"""

ORACLES["op8_pivot_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(cast(q.e as double[]), cast(c.e as double[])) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20"""


#: crc32 of short text, bit by bit; DuckDB has no function for it.
CRC32 = """(xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({}, ''), lambda ch: ascii(ch)::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295))"""


def field(value: str) -> str:
    return f"coalesce(strlen(cast({value} as varchar)) || ':' || cast({value} as varchar), '-')"


def tree_levels(nodes: str, name: str) -> str:
    """All levels of trees of (tree, place, node, total): every 8 nodes become one while more than one remains."""
    return f"""
{name} as (
  select tree, 0 as level, place, node, total from {nodes}
  union all
  select tree, level + 1, place // 8, sha256(string_agg(node, '' order by place)), (total + 7) // 8
  from {name} where total > 1 group by tree, level, place // 8, total)"""


def tree_proofs(levels: str, leaf: str, name: str) -> str:
    """For each leaf place: what stands left and right on every level."""
    return f"""
{name} as (
  select x.tree, x.place, y.level,
         coalesce(string_agg(y.node, '' order by y.place) filter (y.place < (x.place >> (3 * y.level))), '') as l,
         coalesce(string_agg(y.node, '' order by y.place) filter (y.place > (x.place >> (3 * y.level))), '') as r
  from {leaf} x join {levels} y on x.tree = y.tree and y.total > 1 and (y.place >> 3) = (x.place >> (3 * (y.level + 1)))
  group by x.tree, x.place, y.level)"""


_LOW_TEXT = LOWER.format("text")
_LEAF = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
ORACLES["op13_merkle_manifest"] = f"""
with recursive rows as (
  select doc_id, coalesce('=' || lang, '-') as tree, sha256({_LEAF} || {field("text")}) as leaf,
         sha256({_LEAF} || case when {CRC32.format("cast(doc_id as varchar)")} % 3 = 0 then {field(_LOW_TEXT)} else {field("text")} end) as tampered
  from documents),
leaves as (
  select *, row_number() over (partition by tree order by doc_id, leaf) - 1 as place, leaf as node, count(*) over (partition by tree) as total from rows),
{tree_levels("leaves", "inner_levels")},
subroots as (
  select tree as of_tree, '' as tree, node, row_number() over (order by tree) - 1 as place, count(*) over () as total from inner_levels where total = 1),
{tree_levels("subroots", "top_levels")},
top_root as (select node as root from top_levels where total = 1),
{tree_proofs("inner_levels", "leaves", "inner_proofs")},
{tree_proofs("top_levels", "subroots", "top_proofs")},
steps as (
  select tree, place, level, l, r from inner_proofs
  union all
  select leaves.tree, leaves.place, 1000 + level, l, r
  from top_proofs join subroots using (place) join leaves on leaves.tree = subroots.of_tree),
proofs as (select tree, place, list({{'l': l, 'r': r}} order by level) as proof from steps group by tree, place),
known as (
  select doc_id, leaf, s.node as subroot, root, tampered, coalesce(proof, []) as proof
  from leaves join subroots s on s.of_tree = leaves.tree cross join top_root left join proofs on proofs.tree = leaves.tree and proofs.place = leaves.place),
folding as (
  select doc_id, leaf, subroot, root, proof, 0 as done, tampered as node from known
  union all
  select doc_id, leaf, subroot, root, proof, done + 1, sha256(proof[done + 1].l || node || proof[done + 1].r) from folding where done < len(proof))
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(proof, lambda s: s.l || s.r), '')) as proof_sha256,
       node as folded_root, node = root as verified
from folding where done = len(proof)"""

ORACLES["op12_collocations"] = f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
numbered as (select row_number() over () as id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
words as (select id, lang, unnest(w) as w1, generate_subscripts(w, 1) as i from numbered),
runs as materialized (
  select lang, w1, lead(w1, 1) over ahead as w2, lead(w1, 2) over ahead as w3, lead(w1, 3) over ahead as w4
  from words window ahead as (partition by id order by i)),
places as (
  select lang, 1 as k, w1 as phrase from runs
  union all select lang, 2, w1 || ' ' || w2 from runs where w2 is not null
  union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from runs where w3 is not null
  union all select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 from runs where w4 is not null),
f as materialized (select lang, k, phrase, count(*) as a from places group by all),
totals as (select lang, cast(sum(a) as bigint) as n from f where k = 1 group by lang),
candidates as materialized (select *, string_split(phrase, ' ') as w from f where k >= 2 and a >= 30),
cuts as (
  select c.lang, c.k, c.phrase, c.a, cut, x.a as l, y.a as r, cast((2000000::hugeint * c.a) // (x.a + y.a) as bigint) as score
  from candidates c join (values (1), (2), (3)) as cuts(cut) on cut < c.k
  join f x on x.lang = c.lang and x.k = cut and x.phrase = array_to_string(c.w[1:cut], ' ')
  join f y on y.lang = c.lang and y.k = c.k - cut and y.phrase = array_to_string(c.w[cut + 1:], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
kept as (
  select * from best b where not exists (
    select 1 from candidates m where m.lang = b.lang and m.k > b.k and 100 * m.a >= 80 * b.a and contains(' ' || m.phrase || ' ', ' ' || b.phrase || ' '))),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000"""
