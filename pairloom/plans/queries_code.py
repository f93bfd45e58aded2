"""Jobs over code columns. The views' code is made from templates, so the checks know each answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.text import array_text, tokenize_ws
from pairloom.operators import code, counts
from pairloom.plans import sql
from pairloom.plans.registry import query
from pairloom.sources import views

# The actions of each template (word, flag, place it fills), printed once and read against the grammar.
TEMPLATE_ACTIONS = (
    (
        'Assign -; Name + expr.targets+; x - identifier.id-; Store - expr_context.ctx-; Reduce - expr.targets+; '
        'Call - expr.value-; Name - expr.func-; foo - identifier.id-; Load - expr_context.ctx-; Num + expr.args+; '
        '{n} - object.n-; Reduce - expr.args+; Reduce + keyword.keywords+'
    ),
    (
        'FunctionDef -; f - identifier.name-; arguments - arguments.args-; arg + arg.args+; a - identifier.arg-; '
        'Reduce ? expr.annotation?; arg * arg.args+; b - identifier.arg-; Reduce ? expr.annotation?; Reduce - '
        'arg.args+; Reduce ? arg.vararg?; Reduce + arg.kwonlyargs+; Reduce + expr.kw_defaults+; Reduce ? '
        'arg.kwarg?; Num + expr.defaults+; 1 - object.n-; Reduce - expr.defaults+; Expr + stmt.body+; Str - '
        'expr.value-; doc {n} - string.s-; Return * stmt.body+; BinOp - expr.value?; Name - expr.left-; a - '
        'identifier.id-; Load - expr_context.ctx-; Add - operator.op-; Name - expr.right-; b - identifier.id-; '
        'Load - expr_context.ctx-; Reduce - stmt.body+; Reduce + expr.decorator_list+; Reduce ? expr.returns?'
    ),
    (
        'For -; Name - expr.target-; i - identifier.id-; Store - expr_context.ctx-; Call - expr.iter-; Name - '
        'expr.func-; range - identifier.id-; Load - expr_context.ctx-; Num + expr.args+; {n} - object.n-; Reduce -'
        ' expr.args+; Reduce + keyword.keywords+; Expr + stmt.body+; Call - expr.value-; Name - expr.func-; print '
        '- identifier.id-; Load - expr_context.ctx-; Name + expr.args+; i - identifier.id-; Load - '
        'expr_context.ctx-; Reduce - expr.args+; Reduce + keyword.keywords+; Reduce - stmt.body+; Reduce + '
        'stmt.orelse+'
    ),
    (
        'If -; Compare - expr.test-; Name - expr.left-; x - identifier.id-; Load - expr_context.ctx-; Eq + '
        'cmpop.ops+; Reduce - cmpop.ops+; Num + expr.comparators+; {n} - object.n-; Reduce - expr.comparators+; '
        'Pass + stmt.body+; Reduce - stmt.body+; Reduce + stmt.orelse+'
    ),
    (
        'Expr -; ListComp - expr.value-; Name - expr.elt-; y - identifier.id-; Load - expr_context.ctx-; '
        'comprehension + comprehension.generators+; Name - expr.target-; y - identifier.id-; Store - '
        'expr_context.ctx-; Name - expr.iter-; z - identifier.id-; Load - expr_context.ctx-; Compare + expr.ifs+; '
        'Name - expr.left-; y - identifier.id-; Load - expr_context.ctx-; Gt + cmpop.ops+; Reduce - cmpop.ops+; '
        'Num + expr.comparators+; {n} - object.n-; Reduce - expr.comparators+; Reduce - expr.ifs+; 0 - '
        'int.is_async-; Reduce - comprehension.generators+'
    ),
    (
        'If -; NameConstant - expr.test-; True - singleton.value-; Pass + stmt.body+; Reduce - stmt.body+; If + '
        'stmt.orelse+; Name - expr.test-; x - identifier.id-; Load - expr_context.ctx-; Pass + stmt.body+; Reduce '
        '- stmt.body+; Reduce + stmt.orelse+; Reduce - stmt.orelse+'
    ),
    (
        'FunctionDef -; dummy - identifier.name-; arguments - arguments.args-; Reduce + arg.args+; Reduce ? '
        'arg.vararg?; Reduce + arg.kwonlyargs+; Reduce + expr.kw_defaults+; Reduce ? arg.kwarg?; Reduce + '
        'expr.defaults+; Pass + stmt.body+; Reduce - stmt.body+; Name + expr.decorator_list+; dec - '
        'identifier.id-; Load - expr_context.ctx-; Reduce - expr.decorator_list+; Reduce ? expr.returns?'
    ),
)


def _listed(lines: list[str]) -> str:
    return "[" + ", ".join("'" + line.replace("'", "''") + "'" for line in lines) + "]"


# One row per template and action, {n} still open.
EXPECTED = f"""
lines as (select unnest({_listed(list(TEMPLATE_ACTIONS))}) as line, unnest(range({len(TEMPLATE_ACTIONS)})) as template),
cells as (select template, unnest(string_split(line, '; ')) as cell, unnest(range(len(string_split(line, '; ')))) as step from lines),
expected as (
  select template, step, regexp_extract(cell, '^(.*?) [-+*?]( |$)', 1) as action,
    regexp_extract(cell, ' ([-+*?])( [a-z_]+[.][a-z_]+[-+?])?$', 1) as flag,
    nullif(regexp_extract(cell, '([a-z_]+)[.]([a-z_]+)([-+?])$', 1), '') as parent_type,
    nullif(regexp_extract(cell, '([a-z_]+)[.]([a-z_]+)([-+?])$', 2), '') as parent_field,
    nullif(regexp_extract(cell, '([a-z_]+)[.]([a-z_]+)([-+?])$', 3), '') as cardinality
  from cells)"""


@query(
    "code_validity",
    f"""with {sql.CODE}
    select case when template < 5 then 'ok' else 'SyntaxError' end as status, count(*) as n from code group by 1""",
)
def code_validity(spark: SparkSession, folder: str) -> DataFrame:
    return code.status_counts(code.with_facts(views.code_rows(spark, folder), "code"))


@query(
    "code_depth_stats",
    f"""with {sql.CODE},
    sized as (select list_extract([5, 6, 6, 5, 7], template + 1) as depth, list_extract([8, 15, 14, 8, 15], template + 1) as nodes
      from code where template < 5)
    select count(*) as n, cast(max(depth) as bigint) as longest, round(avg(depth), 9) as mean, round(var_pop(depth), 9) as variance,
      cast(sum(nodes) as bigint) as nodes from sized""",
)
def code_depth_stats(spark: SparkSession, folder: str) -> DataFrame:
    parsed = code.with_facts(views.code_rows(spark, folder), "code", "depth", "nodes").where("status = 'ok'")
    depth = F.col("depth").cast("bigint")
    return parsed.agg(
        F.count(depth).alias("n"),
        F.max(depth).alias("longest"),
        F.round(F.avg(depth), 9).alias("mean"),
        F.round(F.var_pop(depth), 9).alias("variance"),
        F.sum("nodes").alias("nodes"),
    )


@query(
    "code_actions",
    f"""with {sql.CODE}, {EXPECTED}
    select p_partkey, cast(step as int) as step, replace(action, '{{n}}', size) as action, flag, parent_type, parent_field, cardinality
    from code join expected using (template)""",
)
def code_actions(spark: SparkSession, folder: str) -> DataFrame:
    parsed = code.with_facts(views.code_rows(spark, folder), "code", "actions", wrap=True).where("status = 'ok'")
    return code.action_rows(parsed, "p_partkey")


@query(
    "action_stats",
    f"""with {sql.CODE}, {EXPECTED},
    worded as (select p_partkey, step, replace(action, '{{n}}', size) as word from code join expected using (template)),
    shifted as (
      select word as a, lead(word, 1) over w as b, lead(word, 2) over w as c, lead(word, 3) over w as d
      from worded window w as (partition by p_partkey order by step))
    select a || ' ' || b || ' ' || c as gram, count(*) as freq from shifted where d is not null group by a, b, c""",
)
def action_stats(spark: SparkSession, folder: str) -> DataFrame:
    parsed = code.with_facts(views.code_rows(spark, folder), "code", "actions", wrap=True).where("status = 'ok'")
    words = parsed.select("p_partkey", code.action_words().alias("words"))
    grams = counts.ngram_counts(words, "words", 3)
    return grams.select(counts.gram_text(3).alias("gram"), "freq")


@query(
    "code_comments",
    f"""with {sql.CODE}
    select cast(case when template = 1 then 1 else 0 end as bigint) as comments, template = 1 as commented, count(*) as n
    from code group by all""",
)
def code_comments(spark: SparkSession, folder: str) -> DataFrame:
    found = code.with_facts(views.code_rows(spark, folder), "code", "comments")
    sized = found.select(F.size("comments").cast("bigint").alias("comments"))
    return sized.withColumn("commented", F.col("comments") > 0).groupBy("comments", "commented").agg(F.count(F.lit(1)).alias("n"))


@query(
    "code_strip_docstrings",
    f"""with {sql.CODE}
    select p_partkey, case template
      when 1 then 'def f(a, b=1):' || chr(10) || '    return a + b'
      when 3 then 'if x == ' || size || ':' || chr(10) || '    pass'
      when 5 then 'if True:' || chr(10) || '    pass' || chr(10) || 'elif x:' || chr(10) || '    pass'
      when 6 then '@dec' || chr(10) || 'def dummy():' || chr(10) || '    pass'
      else code end as stripped from code where template < 7""",
)
def code_strip_docstrings(spark: SparkSession, folder: str) -> DataFrame:
    parsed = code.with_facts(views.code_rows(spark, folder), "code", "stripped", wrap=True)
    return parsed.where("status = 'ok'").select("p_partkey", "stripped")


@query(
    "code_slots",
    f"""with {sql.CODE}
    select p_partkey, case template
      when 0 then 'x = var_0(' || size || ')'
      when 1 then 'def var_1(a, b=1):' || chr(10) || '    \"\"\"doc ' || size || '\"\"\"' || chr(10) || '    return a + b'
      when 2 then 'for var_2 in range(' || size || '):' || chr(10) || '    print(var_2)'
      when 3 then 'if x == ' || size || ':' || chr(10) || '    pass'
      when 5 then 'if True:' || chr(10) || '    pass' || chr(10) || 'elif x:' || chr(10) || '    pass'
      when 6 then '@dec' || chr(10) || 'def dummy():' || chr(10) || '    pass'
      else code end as slotted from code where template < 7""",
)
def code_slots(spark: SparkSession, folder: str) -> DataFrame:
    entries = F.array(
        *[F.struct(F.lit(v).alias("value"), F.lit(s).alias("slot")) for v, s in (("foo", "var_0"), ("f", "var_1"), ("i", "var_2"))]
    )
    slotted = code.with_facts(views.code_rows(spark, folder), "code", "slotted", wrap=True, slots=entries)
    return slotted.where("status = 'ok'").select("p_partkey", "slotted")


@query(
    "code_prepare",
    f"""with {sql.CODE}
    select case when template = 7 then 'SyntaxError' else 'kept' end as status, count(*) as n from code group by 1""",
)
def code_prepare(spark: SparkSession, folder: str) -> DataFrame:
    intent = tokenize_ws(F.concat_ws(" ", F.lit("part"), "p_partkey"))
    return code.status_counts(code.prepare_pairs(views.code_rows(spark, folder), intent, "code"))
