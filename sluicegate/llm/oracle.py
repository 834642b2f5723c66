"""Expected results of the operators that SQL can express, for DuckDB."""

from sluicegate.llm.queries import RULES
from sluicegate.llm.url_filter import LOWER, SOFT, SPLIT, STRICT, UPPER, Vocabulary


def _hits(term):
    return f"""regexp_matches(scanned, '(^|[^\\p{{L}}\\p{{N}}]){term}($|[^\\p{{L}}\\p{{N}}])')"""


def _count(term):
    # a boundary between two hits may be shared: put a second one in its place first
    spread = "regexp_replace(scanned, '([^\\p{L}\\p{N}])', '\\1\\1', 'g')"
    pattern = f"(^|[^\\p{{L}}\\p{{N}}]){term}($|[^\\p{{L}}\\p{{N}}])"
    return f"len(regexp_extract_all({spread}, '{pattern}'))"


def _rules(value):
    cases = " ".join(
        f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') "
        f"then '{value(r)}'"
        for r in sorted(RULES, key=lambda r: (-len(r.text), r.text))
    )
    return f"case {cases} end"


OP1 = f"""
with parts as (
    select page_id,
        translate(coalesce(regexp_extract(url, '{SPLIT}', 1), ''), '{UPPER}', '{LOWER}') as host,
        coalesce(regexp_extract(url, '{SPLIT}', 2), '') as path
    from pages
), scans as (
    select *, host || translate(path, '{UPPER}', '{LOWER}') as scanned from parts
), counts as (
    select page_id, host, path, {_rules(lambda r: r.text)} as rule, {_rules(lambda r: r.verdict)} as ruled,
        ({" + ".join(_count(t) for t in STRICT)})::integer as strict_hits,
        ({" + ".join(f"{_hits(t)}::integer" for t in SOFT)})::integer as soft_terms,
        ({" + ".join(f"{_hits(t)}::integer * {w}" for t, w in SOFT.items())})::double as soft_weight
    from scans
)
select page_id, host, path, rule, strict_hits, soft_terms, soft_weight,
    coalesce(ruled, case when strict_hits > 0 or soft_weight >= {Vocabulary().soft_limit}
        then 'block' else 'allow' end) as verdict
from counts
"""

def _distance(a, b):
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _assigned(n, books):
    """Every part's nearest entry, the lower of two as near."""
    near = f"({_distance('p.v', 'b.c')})"
    return f"""assigned{n} as (
    select p.vec_id, p.part, any_value(p.v) as v, arg_min(b.entry, {near} * 64 + b.entry) as entry,
        min({near}) as error
    from parts p join books{books} b on p.part = b.part group by p.vec_id, p.part
)"""


def _moved(n):
    return f"""means{n} as (
    select part, entry, list(mean order by i) as c from (
        select part, entry, i, floor(sum(v[i]) / count(*))::bigint as mean
        from assigned{n}, range(1, (select max(len(v)) from parts) + 1) t(i) group by part, entry, i
    ) group by part, entry
), books{n} as (
    select b.part, b.entry, coalesce(m.c, b.c) as c from books{n - 1} b left join means{n} m using (part, entry)
)"""


OP11 = f"""
with kept as (
    select vec_id, label, row_number() over (order by vec_id) - 1 as place,
        list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as whole
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as (
    select vec_id, place, p as part, whole[p * len(whole) // 16 + 1 : (p + 1) * len(whole) // 16] as v
    from kept, range(16) t(p)
), books0 as (
    select part, place as entry, v as c from parts where place < 64
), {_assigned(1, 0)}, {_moved(1)}, {_assigned(2, 1)}, {_moved(2)}, {_assigned(3, 2)}, coded as (
    select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, sum(error)::bigint as error
    from assigned3 group by vec_id
), sums as (
    select label, sum(error)::bigint as label_error from coded join kept using (vec_id) group by label
)
select vec_id, code, error, label_error,
    (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) from books2) as codebooks_sha256
from coded join kept using (vec_id) join sums on kept.label is not distinct from sums.label
"""


def _value(c):
    return f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"


def _leaf(n_chars):
    return f"sha256({_value('doc_id')} || {_value('source')} || {_value('lang')} || {n_chars} || {_value('text')})"


#: A byte's eight steps of the checksum's division.
_STEPS = "list_reduce([x, 1, 2, 3, 4, 5, 6, 7, 8], lambda a, _: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)"

OP13 = f"""
with recursive bytes as (
    select list({_STEPS} order by x) as steps from (select x::bigint as x from range(256) t(x))
), crcs as (
    select doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(doc_id::varchar) + 1),
        lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint)),
        lambda a, c: xor(a >> 8, steps[(xor(a, c) & 255) + 1])), 4294967295) as crc
    from (select distinct doc_id from documents where doc_id is not null), bytes
), leaves as (
    select documents.doc_id, lang, {_leaf(_value('n_chars'))} as leaf,
        {_leaf("coalesce(strlen((n_chars::hugeint + 1)::varchar)::varchar || ':' || (n_chars::hugeint + 1)::varchar, '-')")} as changed,
        coalesce(crc % 7 = 0, false) as tampers
    from documents left join crcs using (doc_id)
), named as (
    select *, case when tampers then changed else leaf end as start,
        dense_rank() over (order by lang nulls first) - 1 as tree,
        row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx,
        count(*) over (partition by lang) as size
    from leaves
), lower_nodes as (
    select 0 as level, tree, idx, size, leaf as digest from named
    union all
    select level + 1, tree, idx // 2, (size + 1) // 2, sha256(digest || other) from (
        select *, coalesce(lead(digest) over (partition by tree order by idx), '') as other
        from lower_nodes where size > 1
    ) where idx % 2 = 0
), subroots as (
    select tree, digest as subroot from lower_nodes where size = 1
), upper_nodes as (
    select 0 as level, tree as idx, count(*) over () as size, subroot as digest from subroots
    union all
    select level + 1, idx // 2, (size + 1) // 2, sha256(digest || other) from (
        select *, coalesce(lead(digest) over (order by idx), '') as other from upper_nodes where size > 1
    ) where idx % 2 = 0
), paths as (  -- every sibling on the way up, by its step
    select n.tree, n.idx, l.level as step, l.digest, xor(n.idx >> l.level, 1) > (n.idx >> l.level) as after
    from named n join lower_nodes l on n.tree = l.tree and l.idx = xor(n.idx >> l.level, 1) and l.size > 1
    union all
    select n.tree, n.idx, 1000 + u.level, u.digest, xor(n.tree >> u.level, 1) > (n.tree >> u.level)
    from named n join upper_nodes u on u.idx = xor(n.tree >> u.level, 1) and u.size > 1
), steps as (  -- levels without a sibling count as well
    select n.tree, n.idx, l.level as step from named n join lower_nodes l on n.tree = l.tree and l.idx = n.idx >> l.level and l.size > 1
    union all
    select n.tree, n.idx, 1000 + u.level from named n join upper_nodes u on u.idx = n.tree >> u.level and u.size > 1
), proofs as (
    select tree, idx, list({{'digest': digest, 'after': after}} order by step) as siblings,
        string_agg(digest, '' order by step) as proof
    from steps left join paths using (tree, idx, step) group by tree, idx
)
select doc_id, leaf, subroot, r.root, sha256(coalesce(proof, '')) as proof_sha256, folded as folded_root, folded = r.root as verified
from (
    select *, list_reduce(list_prepend({{'digest': start, 'after': false}}, coalesce(siblings, [])), lambda a, s: {{
        'digest': sha256(case when s.digest is null then a.digest when s.after then a.digest || s.digest else s.digest || a.digest end),
        'after': false}}).digest as folded
    from named left join proofs using (tree, idx)
) join subroots using (tree), (select digest as root from upper_nodes where size = 1) r
"""

ORACLE = {"op1_url_filter": OP1, "op11_vector_codes": OP11, "op13_merkle_manifest": OP13}
