"""Pieces of the SQL checks: the views of the tables, written independently of the Spark plans."""

from __future__ import annotations

BLANK = r"[\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def tok(x: str) -> str:
    spaced = rf"regexp_replace({x}, '([^A-Za-z0-9_])', ' \1 ', 'g')"
    camel = rf"regexp_replace({spaced}, '([a-z])([A-Z])', '\1 \2', 'g')"
    collapsed = f"regexp_replace({camel}, '{BLANK}+', ' ', 'g')"
    quotes = f"replace(replace({collapsed}, '\"', '`'), '''', '`')"
    return f"list_filter(string_split({quotes}, ' '), lambda t: t <> '')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{BLANK}+'), lambda t: t <> '')"


def joined(x: str, by: str = " ") -> str:
    return f"array_to_string({x}, '{by}')"


DOCS = f"docs as (select doc_id, lang, source, text, {tok('text')} as tokens from documents)"
TOKS = "toks as (select doc_id, unnest(tokens) as token, generate_subscripts(tokens, 1) - 1 as pos from docs)"


def exploded(source: str, tokens: str, name: str, *keys: str) -> str:
    listed = ", ".join(keys)
    return (
        f"{name} as (select {listed}, unnest({tokens}) as token, "
        f"generate_subscripts({tokens}, 1) - 1 as pos from {source})"
    )


def vocabulary(tokens: str, cutoff: int, order: tuple[str, ...] = ("doc_id",), name: str = "vocab") -> str:
    keys = ", ".join(order)
    first = ", ".join(f"first.{k}" for k in order)
    packed = ", ".join(f"{k} := {k}" for k in order)
    return f"""
{name}_counts as (
  select token, count(*) as freq, min(struct_pack({packed}, p := pos)) as first from {tokens} group by token),
{name}_ranked as (
  select token as word, 3 + row_number() over (order by freq desc, {first}, first.p) as id, freq
  from {name}_counts
  where freq >= {cutoff} and token not in ('[PAD]', '<s>', '</s>', '<unk>')),
{name} as (
  select word, cast(id as bigint) as id, cast(freq as bigint) as freq from (
    values ('[PAD]', 0, 0), ('<s>', 1, 0), ('</s>', 2, 0), ('<unk>', 3, 0)) s(word, id, freq)
  union all select word, id, freq from {name}_ranked
  union all select 'Reduce_primitif', (select coalesce(max(id), 3) from {name}_ranked) + 1, 0
  where not exists (select 1 from {name}_ranked where word = 'Reduce_primitif'))"""


PAIRS = """
pairs as (
  select conv_id, turn, text as intent, next_text as snippet from (
    select conv_id, turn, role, text, lead(role) over w as next_role, lead(text) over w as next_text
    from conversations window w as (partition by conv_id order by turn))
  where role = 'user' and next_role = 'assistant')"""
TPAIRS = f"""{PAIRS},
tpairs as (
  select conv_id, turn, {tok('intent')} as intent_tokens, {tok('snippet')} as snippet_tokens from pairs)"""
ANNOT = f"""{PAIRS},
annot as (
  select *, case when (conv_id + turn) % 7 <> 0 then upper(replace(intent, 'ß', 'ss')) end as rewritten_intent from pairs)"""
PREDS = f"""{PAIRS},
preds as (
  select conv_id, turn, intent, {tok('snippet')} as truth,
    {tok("replace(snippet, ' the ', ' a ')")} as prediction from pairs)"""
SLOTS = """
slots as (
  select p_partkey, replace(p_name, ' ', '_') as name, p_name as phrase, cast(p_size as varchar) as size,
    p_type as type,
    'set `' || replace(p_name, ' ', '_') || '` of "' || p_name || '" to `' || cast(p_size as varchar)
      || '` and ''' || p_type || ''' not `' || replace(p_name, ' ', '_') || '`' as intent
  from part)"""
CODE = """
code as (
  select p_partkey, cast(p_partkey % 8 as int) as template, cast(p_size as varchar) as size,
    replace(case p_partkey % 8
      when 0 then 'x = foo({n})'
      when 1 then 'def f(a, b=1):' || chr(10) || '    \"\"\"doc {n}\"\"\"' || chr(10) || '    return a + b  # note'
      when 2 then 'for i in range({n}):' || chr(10) || '    print(i)'
      when 3 then 'if x == {n}: pass'
      when 4 then '[y for y in z if y > {n}]'
      when 5 then 'elif x:'
      when 6 then '@dec'
      else 'return foo(' end, '{n}', cast(p_size as varchar)) as code
  from part)"""


def bleu(source: str, candidate: str, target: str, name: str = "score") -> str:
    """Corpus BLEU as CTEs: windows of both sides counted per row, clipped by a join, combined at the end."""

    def grams(side: str) -> str:
        return (
            f"select conv_id, turn, n, {side}[i:i + n - 1] as gram, count(*) as c from ("
            f"select conv_id, turn, n, {side}, unnest(range(1, len({side}) - n + 2)) as i "
            f"from {source}, range(1, 5) t(n)) group by all"
        )

    return f"""
{name}_cand as ({grams(candidate)}),
{name}_target as ({grams(target)}),
{name}_hits as (
  select n, sum(least(a.c, b.c)) as m from {name}_cand a join {name}_target b using (conv_id, turn, n, gram) group by n),
{name}_totals as (select n, sum(c) as t from {name}_cand group by n),
{name}_logs as (select count(*) as widths, sum(ln(m / t)) / 4 as logs from {name}_hits join {name}_totals using (n)),
{name}_sizes as (select sum(len({candidate})) as c, sum(len({target})) as r from {source}),
{name} as (
  select case when widths = 4 then exp(logs) * exp(least(1 - r / c, 0)) else 0.0 end as bleu
  from {name}_logs, {name}_sizes)"""


LOG = """
log as (
  select user_id as run, row_number() over (partition by user_id order by ts, event_id) as epoch, value as metric
  from events),
better as (
  select *, greatest(coalesce(max(metric) over (
      partition by run order by epoch rows between unbounded preceding and 1 preceding), -0.1), -0.1) as best_before
  from log),
flagged as (select *, metric > best_before as is_better from better)"""
