"""The SQL, in DuckDB's dialect, of those queries that SQL can express.

Learnt models, grammars and tilings are not among them; tests compare these with brute
force, exact round trips and held-out accuracy.
"""

from __future__ import annotations

from millrace.llm.hilbert import BITS, DIMENSIONS, SHARDS, curve_steps
from millrace.llm.mixing import MOST, SEED, UNIT

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ID_HASH = "('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint"

#: crc32 of a text's bytes, over the table of the reflected polynomial 0xEDB88320.
_CRC_TABLE = """
crc_table as materialized (
  select list(c order by i) as crcs from (
    select i, list_reduce(range(8), lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, i) as c
    from range(256) t(i)))"""
_CRC = """
xor(list_reduce(
  list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint),
  lambda a, x: xor(a >> 8, crcs[(xor(a, x) & 255) + 1]), 4294967295::bigint), 4294967295)"""

NEAR_DUPLICATES = f"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from documents),
sets as (
  select doc_id, case
    when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
  from words),
each as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
links as (
  select a.doc_id as x, b.doc_id as y from each a join each b using (shingle) where a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached as (
  select doc_id as x, doc_id as y from documents
  union select reached.x, links.y from reached join links on reached.y = links.x),
least as (select x, min(y) as component_id from reached group by x)
select doc_id, coalesce(len(s), 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from sets join least on doc_id = x"""


def _curve(rows: str) -> str:
    """``rows`` with the column ``curve`` beside the levels of the dimensions."""
    work = [f"_{name}_level" for name in DIMENSIONS]
    sql = f"select *, {', '.join(f'{w[1:]} as {w}' for w in work)} from ({rows})"
    known = set(work)
    for step in curve_steps(work, BITS):
        old = [f"{expression} as {name}" for name, expression in step.items() if name in known]
        new = [f", {expression} as {name}" for name, expression in step.items() if name not in known]
        known |= set(step)
        sql = f"select * {f'replace ({", ".join(old)})' if old else ''}{''.join(new)} from ({sql})"
    return sql


def _levels(name: str) -> str:
    return f"""
select {name}, coalesce(sum(count(*)) over (order by {name} rows between unbounded preceding and 1 preceding), 0)
  * {1 << BITS} // sum(count(*)) over () as {name}_level from docs group by {name}"""


SHARDED = f"""
with {_CRC_TABLE},
docs as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size, {_CRC} as crc, coalesce(lang, '') as lang,
         coalesce(source, '') as source, {_ID_HASH} as hash from documents, crc_table),
leveled as (
  select docs.*, lang_level::bigint as lang_level, source_level::bigint as source_level,
         least(length(bin(size)) - 1, {(1 << BITS) - 1})::bigint as size_level
  from docs join ({_levels('lang')}) using (lang) join ({_levels('source')}) using (source)),
ranked as (
  select *, row_number() over (order by curve, hash, doc_id nulls first, crc, size) - 1 as place, count(*) over () as n
  from ({_curve('select * from leveled')}))
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'rows' as law, (place * {SHARDS} // n)::int as shard,
       (place - (place * {SHARDS} // n * n + {SHARDS - 1}) // {SHARDS})::bigint as slot, null::int as grown_shard
from ranked"""

MIXED = f"""
with {_CRC_TABLE},
docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size, {_CRC} as crc,
         {_ID_HASH} as hash from documents, crc_table),
sources as (
  select source, sum(size)::bigint as source_size,
         ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double as weight from docs group by source),
limits as (select *, source_size * {MOST}.0::double as most, source_size * {MOST}.0::double / weight as ratio from sources),
levels as (
  select *, (sum(source_size) over ()
    - coalesce(sum(most) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0.0::double))
    / sum(weight) over (order by ratio, source nulls last rows between current row and unbounded following) as level
  from limits),
aims as (
  select source, source_size, least(most, coalesce(max(case when level <= ratio then level end) over () * weight, most)) as target
  from levels),
aimed as (
  select docs.*, source_size, target,
    case when size > 0 then round(target / source_size * {UNIT})::bigint else 0 end as units,
    case when size < 8 then size
         else (length(bin(size)) - 3) * 8 + size // (1::bigint << (length(bin(size)) - 4)) - 8 end as class,
    ('0x' || substr(md5('{SEED}:' || coalesce('=' || docs.source, '')), 1, 8))::bigint >> 6 as begin
  from docs join aims on docs.source is not distinct from aims.source),
placed as (
  select *, begin + coalesce(sum(units) over (partition by source order by class, hash, doc_id nulls first, crc
    rows between unbounded preceding and 1 preceding), 0)::bigint as start from aimed)
select doc_id, size, source_size, target, (((start + units) // {UNIT} - start // {UNIT}) * size)::bigint as taken from placed"""

WITHOUT_REPEATS = f"""
with docs as materialized (
  select row_number() over () as id, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
windows as materialized (
  select id, n, array_to_string(w[n:n + 34], ' ') as run from (select id, w, unnest(range(1, len(w) - 33)) as n from docs)),
starts as (select id, n, 1 as hit from windows where run in (select run from windows group by run having count(*) > 1)),
words as (select id, unnest(range(1, len(w) + 1)) as n, unnest(w) as word from docs),
marked as (
  select id, n, word, coalesce(max(hit) over (partition by id order by n rows between 34 preceding and current row), 0) as gone
  from words left join starts using (id, n)),
left_over as (
  select id, count(*) as n_words, sum(gone) as n_removed, string_agg(word, ' ' order by n) filter (gone = 0) as rest
  from marked group by id)
select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(coalesce(rest, '')) as kept_sha256
from docs left join left_over using (id)"""

_TEXT_CRC = _CRC.replace("coalesce(text, '')", "{}")

TRIE = f"""
with {_CRC_TABLE},
convs as (
  select conv_id, {_TEXT_CRC.format("conv_id::varchar")} % 4 as h
  from (select distinct conv_id from conversations where conv_id is not null), crc_table),
own as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as n,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
rebuilt as (
  select convs.conv_id, n, role, text from convs join own on own.conv_id = convs.conv_id - convs.conv_id % 20 and n <= h
  union all select convs.conv_id, n, role, text from convs join own on own.conv_id = convs.conv_id and n > h),
turns as (
  select conv_id, row_number() over (partition by conv_id order by n) as d, len(role) || ':' || role || text as turn,
         len(regexp_extract_all(text, '{_WORD}')) as words
  from rebuilt),
paths as materialized (
  select conv_id, d, sha256(string_agg(sha256(turn), '') over (partition by conv_id order by d)) as name, words from turns
  union all select conv_id, 0, '', 0 from convs),
ended as (
  select name, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, arg_max(name, d) as name from paths group by conv_id) group by name),
nodes as materialized (
  select name, d, min(conv_id) as conv_id, count(*) as n, any_value(words) as words from paths group by name, d),
linked as materialized (
  select nodes.*, paths.name as parent from nodes left join paths on paths.conv_id = nodes.conv_id and paths.d = nodes.d - 1),
children as (select parent as name, count(*) as n_children from linked where parent is not null group by parent),
sums as (
  select paths.name, sum((nodes.n - 1) * nodes.words) as saved, count(*) filter (children.name is null) as leaves
  from nodes join paths on paths.conv_id = nodes.conv_id and paths.d <= nodes.d left join children on children.name = nodes.name
  group by paths.name)
select a.conv_id, a.d::bigint as depth, b.conv_id as parent_conv_id, a.n::bigint as n_convs,
       coalesce(n_children, 0)::bigint as n_children, leaves::bigint as n_leaves, saved::bigint as saved_tokens,
       sha256(coalesce(ids, '')) as ends_sha256
from linked a left join nodes b on b.name = a.parent left join children on children.name = a.name
join sums on sums.name = a.name left join ended on ended.name = a.name"""

_LEAF = " || ".join(
    f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "{n_chars}", "text")
)


def _merkle(name: str, leaves: str, rows: str, levels: int) -> str:
    """CTEs that climb ``levels`` levels from the table ``leaves`` (tree, pos, node) and fold
    ``rows`` (tree, pos, f, proof and others) along: ``name`` are the folded rows."""
    out = [f"{name}_n0 as materialized (select *, count(*) over (partition by tree) as n from {leaves})", f"{name}_r0 as (select * from {rows})"]
    for k in range(levels):
        out.append(f"""{name}_n{k + 1} as materialized (
  select *, count(*) over (partition by tree) as n from (
    select tree, pos // 2 as pos, case when any_value(n) = 1 then any_value(node) else sha256(string_agg(node, '' order by pos)) end as node
    from {name}_n{k} group by tree, pos // 2))""")
        out.append(f"""{name}_r{k + 1} as materialized (
  select r.* replace (r.pos // 2 as pos, r.proof || coalesce(s.node, '') as proof,
    case when m.n = 1 then f when s.node is null then sha256(f) when r.pos % 2 = 0 then sha256(f || s.node) else sha256(s.node || f) end as f)
  from {name}_r{k} r join {name}_n{k} m on m.tree = r.tree and m.pos = r.pos
  left join {name}_n{k} s on s.tree = r.tree and s.pos = xor(r.pos, 1::bigint))""")
    return ",\n".join(out)


MERKLE = f"""
with {_CRC_TABLE},
docs as materialized (
  select doc_id, coalesce('=' || lang, '') as tree, sha256({_LEAF.format(n_chars="n_chars")}) as leaf,
         sha256({_LEAF.format(n_chars="(n_chars + 1)")}) as changed, {_TEXT_CRC.format("doc_id::varchar")} as crc
  from documents, crc_table),
placed as materialized (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos,
         case when crc % 7 = 0 then changed else leaf end as f, '' as proof from docs),
leaves as (select tree, pos, leaf as node from placed),
{_merkle("lower", "leaves", "placed", 20)},
subroots as materialized (select '' as tree, row_number() over (order by tree) - 1 as pos, node, tree as lang from lower_n20),
tops as (select tree, pos, node from subroots),
lifted as (
  select r.* replace ('' as tree, s.pos as pos), s.node as subroot from lower_r20 r join subroots s on s.lang = r.tree),
{_merkle("upper", "tops", "lifted", 10)}
select doc_id, leaf, subroot, u.node as root, sha256(proof) as proof_sha256, f as folded_root, f = u.node as verified
from upper_r10 r, upper_n10 u"""

ORACLES = {
    "op4_minhash_near_dedup": NEAR_DUPLICATES,
    "op7_hilbert_shards": SHARDED,
    "op10_mix_sources": MIXED,
    "op11_substring_dedup": WITHOUT_REPEATS,
    "op12_conversation_trie": TRIE,
    "op13_merkle_manifest": MERKLE,
}
