"""Array columns worked on inside the row, so that no shuffle is needed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pairloom.functions.text import _col


def ngrams(tokens: Column | str, width: int, include_last: bool = True) -> Column:
    """Array of structs of ``width`` consecutive items.

    Built by zipping shifted slices, so a window is compared item by item and no separator is needed.
    ``include_last=False`` leaves the last window out.
    """
    items = _col(tokens)
    count = F.greatest(F.size(items) - F.lit(width - 1 if include_last else width), F.lit(0))
    return F.arrays_zip(*[F.slice(items, F.lit(i + 1), count) for i in range(width)])


def bind(value: Column, use) -> Column:
    """Work ``value`` out once per row and hand it to ``use``; a lambda would work it out per item."""
    return F.element_at(F.transform(F.array(value), use), 1)


# The in-row algorithms below are written as SQL text: as one parsed expression they cost one call to
# the JVM, where the same tree built node by node costs a few hundred. Names of lambdas start with two
# underscores, so that they do not hide a column.


def _let(name: str, value: str, body: str) -> str:
    """SQL: work ``value`` out once per row and use it by name in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _next(items: str, last: str) -> str:
    """SQL: each item's successor; ``last`` follows the last one."""
    return f"slice(concat({items}, array({last})), 2, size({items}))"


def _run_starts(ordered: str) -> str:
    """SQL: places, from 0, at which a sorted list changes its value."""
    prior = f"concat(slice({ordered}, 1, 1), slice({ordered}, 1, greatest(size({ordered}) - 1, 0)))"
    changes = f"zip_with({ordered}, {prior}, (__x, __p) -> __x <> __p)"
    return f"array_compact(transform({changes}, (__new, __i) -> if(__new or __i = 0, __i, null)))"


def _runs(items: str, cut: str) -> str:
    """SQL: sort items with their places; ``cut`` makes one value of each run (``__a`` to ``__b`` of ``__q``).

    Items and places are taken apart once, so that a run is cut out without touching the other runs.
    """
    places = f"if(size({items}) > 0, sequence(0, size({items}) - 1), cast(array() as array<int>))"
    ranked = f"sort_array(zip_with({items}, {places}, (__t, __i) -> named_struct('item', __t, 'pos', __i)))"
    spans = f"zip_with(__s, {_next('__s', 'size(__q.item)')}, (__a, __b) -> {cut})"
    apart = "named_struct('item', __r.item, 'pos', __r.pos)"
    return _let("__r", ranked, _let("__q", apart, _let("__s", _run_starts("__q.item"), spans)))


_RUN_PLACES = "slice(__q.pos, __a + 1, __b - __a)"


def group_positions(tokens: str) -> Column:
    """Per distinct item its ascending positions: array<struct<item, positions>>, in item order.

    One in-row sort, then the runs of equal items are cut out; no shuffle, n log n in the row.
    """
    return F.expr(_runs(f"`{tokens}`", f"named_struct('item', __q.item[__a], 'positions', {_RUN_PLACES})"))


def target_spots(source: str, target: str) -> Column:
    """Per distinct target item: array<struct<token, positions, steps>>, its source positions and target steps.

    Both lists are grouped together, so finding each target item in the source costs one sort.
    """
    n = f"size(`{source}`)"
    positions = f"filter({_RUN_PLACES}, __p -> __p < {n})"
    steps = f"transform(filter({_RUN_PLACES}, __p -> __p >= {n}), __p -> __p - {n})"
    cut = f"named_struct('token', __q.item[__a], 'positions', {positions}, 'steps', {steps})"
    return F.expr(f"filter({_runs(f'concat(`{source}`, `{target}`)', cut)}, __g -> size(__g.steps) > 0)")


def shared_distinct(a: Column | str, b: Column | str) -> Column:
    return F.array_intersect(_col(a), _col(b))


def quoted_singles(tokens: Column | str, quote: str = "`") -> Column:
    """Pair up the positions of the quote token in order; keep pairs with exactly one token between."""
    spots = F.array_compact(F.transform(_col(tokens), lambda t, i: F.when(t == quote, i)))

    def singles(s: Column) -> Column:
        following = F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0)))
        gaps = F.zip_with(following, s, lambda after, at: after - at)
        return F.filter(gaps, lambda gap, i: (i % 2 == 0) & (gap == 2))

    return bind(spots, singles)


_SEPARATOR = "\x1f"
_TARGET, _CANDIDATE = "0", "1"


def joinable(tokens: Column | str) -> Column:
    """Tokens in which the separator of joined windows cannot occur; different tokens stay different."""

    def escaped(t: Column) -> Column:
        doubled = F.replace(t, F.lit("\\"), F.lit("\\\\"))
        return F.replace(doubled, F.lit(_SEPARATOR), F.lit("\\s"))

    return F.transform(
        _col(tokens),
        lambda t: F.when(F.contains(t, F.lit(_SEPARATOR)) | F.contains(t, F.lit("\\")), escaped(t)).otherwise(t),
    )


def clipped_matches(candidate: str, target: str, width: int) -> Column:
    """Windows of the candidate that also occur in the target, each at most as often as it does there.

    Both sides must be ``joinable``. Windows of both sides are sorted together, each marked with its
    side, so that equal windows are two neighbouring runs, the target's first; the shorter run of the
    two counts. Work is n log n in the row and nothing is shuffled.
    """

    def marked(items: str, side: str) -> str:
        count = f"greatest(size(`{items}`) - {width - 1}, 0)"
        slices = ", ".join(f"slice(`{items}`, {i + 1}, {count})" for i in range(width))
        parts = ", ".join(f"__g.`{i}`" for i in range(width))
        return f"transform(arrays_zip({slices}), __g -> concat_ws(char(31), {parts}, '{side}'))"

    merged = f"sort_array(concat({marked(target, _TARGET)}, {marked(candidate, _CANDIDATE)}))"
    lengths = f"zip_with(__s, {_next('__s', 'size(__w)')}, (__a, __b) -> __b - __a)"
    twin = f"endswith(__h, '{_TARGET}') and concat(substring(__h, 1, length(__h) - 1), '{_CANDIDATE}') = __k"
    twins = f"zip_with(__heads, {_next('__heads', repr(''))}, (__h, __k) -> {twin})"
    shorter = f"zip_with(__n, {_next('__n', '0')}, (__a, __b) -> least(__a, __b))"
    total = f"aggregate(zip_with({twins}, {shorter}, (__t, __k) -> if(__t, __k, 0)), 0, (__sum, __k) -> __sum + __k)"
    body = _let("__heads", "transform(__s, __i -> __w[__i])", _let("__n", lengths, total))
    return F.expr(_let("__w", merged, _let("__s", _run_starts("__w"), body)))


def pad_to(ids: Column | str, length: Column, pad: int = 0) -> Column:
    values = _col(ids)
    return F.concat(values, F.array_repeat(F.lit(pad).cast("bigint"), (length - F.size(values)).cast("int")))


def length_mask(size: Column, length: Column, valid_is_one: bool = False) -> Column:
    """0/1 per step up to ``length``: 1 past the end (padding), or the other way round."""
    inside, outside = (1, 0) if valid_is_one else (0, 1)
    steps = F.when(length > 0, F.sequence(F.lit(1), length.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda t: F.when(t <= size, F.lit(inside)).otherwise(F.lit(outside)))


def sort_by_length(tokens: Column | str) -> Column:
    """Longest first; equal lengths keep their order."""
    keyed = F.transform(_col(tokens), lambda t, i: F.struct((-F.length(t)).alias("k"), i.alias("i"), t.alias("t")))
    return F.transform(F.sort_array(keyed), lambda x: x["t"])
