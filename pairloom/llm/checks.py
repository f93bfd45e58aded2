"""SQL for the numbered operators' queries, where SQL can express them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pairloom.llm.licenses import Template


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """All distances, in integers; each round names its assignment and its code books."""
    steps = [
        f"""whole as materialized (
      select vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""parts as materialized (
      select vec_id, j, list_slice(v, j * (len(v) // {parts}) + 1, (j + 1) * (len(v) // {parts})) as p
      from whole, (select unnest(range({parts})) as j))""",
        f"""book0 as materialized (
      select j, row_number() over (partition by j order by vec_id) - 1 as e, p from parts
      where vec_id in (select vec_id from whole order by vec_id limit {entries}))""",
    ]
    for k in range(rounds + 1):
        steps.append(f"""near{k} as materialized (
      select vec_id, parts.j, any_value(parts.p) as p,
        min(struct_pack(d := list_sum(list_transform(list_zip(parts.p, b.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, e := e)) as b
      from parts join book{k} b on b.j = parts.j group by vec_id, parts.j)""")
        if k < rounds:
            steps.append(f"""mean{k} as (
      select j, e, list(((s - ((s % n) + n) % n) // n)::bigint order by pos) as p
      from (select j, b.e as e, pos, sum(x)::bigint as s, count(*) as n
            from (select j, b, unnest(p) as x, generate_subscripts(p, 1) as pos from near{k}) group by j, b.e, pos) group by j, e)""")
            steps.append(f"""book{k + 1} as materialized (
      select o.j, o.e, coalesce(m.p, o.p) as p from book{k} o left join mean{k} m on m.j = o.j and m.e = o.e)""")
    return f"""with {", ".join(steps)},
    coded as (
      select vec_id, string_agg(printf('%02x', (b.e)::int), '' order by j) as code, sum(b.d)::bigint as error from near{rounds} group by vec_id),
    books as (
      select sha256(string_agg(array_to_string(p, ','), ',' order by j, e)) as codebooks_sha256 from book{rounds})
    select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
    from coded join whole using (vec_id), books"""


def audit_sql(filters: str = "ABCDE") -> str:
    """Failures as one flag each; what a filter does at a step depends on the flags of the filters before it."""
    orders = ", ".join(f"('{''.join(o)}')" for o in permutations(filters))
    flags = ", ".join(filters)
    return f"""with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
    listed as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w from texts),
    flags as (
      select doc_id, part, len(w) < 100 as A, 100 * len(list_distinct(w)) < 80 * len(w) as B,
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) as C, regexp_matches(t, '[#$%&*|]') as D,
        coalesce(doc_id > min(doc_id) over (partition by t), false) as E from listed),
    known as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
    counted as (
      select part, list_filter(['{"', '".join(filters)}'], lambda x: list_contains([{", ".join(f"case when {f} then '{f}' end" for f in filters)}], x)) as failed,
        count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic
      from flags left join known using (doc_id) group by part, {flags}),
    orders as (select o as filter_order, generate_series as step, o[generate_series:generate_series] as own, string_split(o[1:generate_series - 1], '') as before
      from (values {orders}) x(o), generate_series(1, {len(filters)})),
    placed as (select *, list_contains(failed, own) as failing, list_has_any(failed, before) as earlier from counted, orders),
    steps as (
      select part, filter_order, step, own, (sum(case when not failing and not earlier then n else 0 end))::bigint as kept,
        (sum(case when failing and not earlier then n else 0 end))::bigint as removed, (sum(case when failing and earlier then n else 0 end))::bigint as redundant,
        (sum(case when failing and len(failed) = 1 then n else 0 end))::bigint as unique_fails,
        (sum(case when failing and not earlier then good else 0 end))::bigint as good_lost, (sum(case when failing and not earlier then toxic else 0 end))::bigint as toxic_lost
      from placed group by part, filter_order, step, own)
    select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
      (sum(removed) over (partition by part, own))::bigint as shapley from steps"""


def licenses_sql(templates: Sequence[Template], slack: int, percent: int) -> str:
    """Word pairs as text, joined with those of the templates."""
    rows, sizes = [], []
    for t, template in enumerate(templates):
        listed = template.text.split()
        sizes.append(f"({t}, '{template.label}', {template.exact}, {template.base}, {len(listed)})")
        rows += [f"({t}, {place}, '{a} {b}')" for place, (a, b) in enumerate(zip(listed, listed[1:]))]
    return f"""with texts as (
      select row_number() over () as r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
    pairs as (
      select r, i - 1 as word, w[i] || ' ' || w[i + 1] as gram from (select r, w, unnest(range(1, len(w))) as i from texts)),
    places(t, place, gram) as (values {", ".join(rows)}),
    sizes(t, label, exact, base, size) as (values {", ".join(sizes)}),
    votes as (
      select r, t, label, exact, base, size, word - place as diagonal, bit_or(1::bigint << place) as mask, min(word) as first_word
      from pairs join places using (gram) join sizes using (t) group by all),
    merged as (
      select r, label, base, size, bit_count(m | (m << 1))::bigint as covered, null::bigint as first_word
      from (select *, bit_or(mask) over (partition by r, t order by diagonal range between {slack} preceding and {slack} following) as m from votes where not exact)),
    found as (
      select r, label, base, first_word, 1.0::double as share from votes where exact and bit_count(mask) = size - 1
      union all select r, label, base, first_word, covered::double / size from merged where covered * 100 >= size * {percent}),
    summed as (
      select r, count(*) filter (where base) as n_base, min(first_word) filter (where base) as first_word, max(first_word) filter (where base) as last_word,
        string_agg(distinct label, ',' order by label) filter (where base) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(share) as score
      from found group by r)
    select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0) as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
      coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
    from texts left join summed using (r)"""
