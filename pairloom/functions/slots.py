"""Quoted terms to slots and back.

A slot map is an array of entries in the order they were made. Entries keep repeats and order, which
a map cannot; ``entry_map`` gives the map view when one is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pairloom.functions.arrays import bind
from pairloom.functions.text import _col, strip

# A term between two equal quotes; the empty pair '' counts as a quote too.
QUOTED_TERM = r"(?d)(''|[`'\"])(.*?)\1"
# A literal between two equal quotes, the closing one not escaped.
QUOTED_LITERAL = r"(?d)(['\"])(.*?)(?<!\\)\1"
# The shape of an identifier of any script.
IDENTIFIER = r"\A[\p{L}\p{Nl}_][\p{L}\p{Nl}\p{Mn}\p{Mc}\p{Nd}\p{Pc}]*\z"

# What opens and closes a list, tuple, set or dict in text.
OPENERS = ("{", "(", "[")
CLOSERS = ("}", ")", "]")


def _replace_each(c: Column, pairs: Column, old, new) -> Column:
    """Replace one pair after the other, in order; an empty search text changes nothing."""
    return F.aggregate(pairs, c, lambda text, p: F.replace(text, old(p), new(p)))


def slot_type(quote: Column, value: Column) -> Column:
    return F.when((quote == "`") & value.rlike(IDENTIFIER), F.lit("var")).otherwise(F.lit("str"))


def quoted_terms(c: Column | str) -> Column:
    """array<struct<quote, value>> of the quoted terms, left to right."""
    quotes = F.regexp_extract_all(_col(c), F.lit(QUOTED_TERM), F.lit(1))
    values = F.regexp_extract_all(_col(c), F.lit(QUOTED_TERM), F.lit(2))
    return F.zip_with(quotes, values, lambda q, v: F.struct(q.alias("quote"), v.alias("value")))


def slot_entries(c: Column | str) -> Column:
    """array<struct<slot, value, quote, type, quoted>>: the n-th term of its type becomes ``type_n``."""
    typed = F.transform(
        quoted_terms(c),
        lambda m, i: F.struct(
            i.alias("at"), slot_type(m["quote"], m["value"]).alias("type"), m["quote"].alias("quote"), m["value"].alias("value")
        ),
    )

    def numbered(terms: Column, kind: str) -> Column:
        return F.transform(
            F.filter(terms, lambda m: m["type"] == kind),
            lambda m, n: F.struct(
                m["at"].alias("at"),
                F.concat(F.lit(f"{kind}_"), n.cast("string")).alias("slot"),
                strip(m["value"]).alias("value"),
                m["quote"].alias("quote"),
                m["type"].alias("type"),
                F.concat(m["quote"], m["value"], m["quote"]).alias("quoted"),
            ),
        )

    ordered = bind(typed, lambda terms: F.sort_array(F.concat(numbered(terms, "var"), numbered(terms, "str"))))
    return F.transform(ordered, lambda e: e.dropFields("at"))


def slot_text(c: Column | str, entries: Column) -> Column:
    """The text with each quoted term replaced by its slot; a repeated term takes the first slot everywhere."""
    return _replace_each(_col(c), entries, lambda e: e["quoted"], lambda e: e["slot"])


def is_enumerable(value: Column | str) -> Column:
    """Looks like a list, tuple, set or dict: long enough, opened and closed (not necessarily alike)."""
    v = _col(value)
    first, last = F.substring(v, 1, 1), F.substring(v, -1, 1)
    return (F.length(v) > 2) & first.isin(*OPENERS) & last.isin(*CLOSERS)


def fake_list_entries(entries: Column) -> Column:
    """Entries whose value is a list, renamed to the slot between the same brackets."""
    lists = F.filter(entries, lambda e: is_enumerable(e["value"]))
    return F.transform(
        lists,
        lambda e: e.withField(
            "slot", F.concat(F.substring(e["value"], 1, 1), e["slot"], F.substring(e["value"], -1, 1))
        ),
    )


def fake_list_text(code: Column | str, fakes: Column) -> Column:
    """Code with each list literal that the request quotes replaced by its bracketed slot."""
    return _replace_each(_col(code), fakes, lambda e: e["value"], lambda e: e["slot"])


def literal_slots(c: Column | str, variables: Column | None = None) -> Column:
    """array<struct<literal, slot>> for a request: quoted literals first, then variables, longest first.

    A repeated literal keeps its slot; ``%s`` gets none.
    """
    found = F.array_distinct(F.regexp_extract_all(_col(c), F.lit(QUOTED_LITERAL), F.lit(2)))
    literals = F.transform(
        F.array_remove(found, "%s"),
        lambda v, i: F.struct(v.alias("literal"), F.concat(F.lit("str_"), i.cast("string")).alias("slot")),
    )
    if variables is None:
        return literals
    named = F.transform(
        variables,
        lambda v, i: F.struct(v.alias("literal"), F.concat(F.lit("var_"), i.cast("string")).alias("slot")),
    )
    return F.concat(literals, named)


def query_text(c: Column | str, slots: Column, variables: Column | None = None) -> Column:
    """The request with quoted literals, then variables, replaced by their slots."""
    text = _col(c)
    quotes = F.regexp_extract_all(text, F.lit(QUOTED_LITERAL), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(QUOTED_LITERAL), F.lit(2))
    occurrences = F.zip_with(quotes, values, lambda q, v: F.struct(v.alias("v"), F.concat(q, v, q).alias("quoted")))

    def fill(known: Column) -> Column:
        strings = F.filter(known, lambda e: F.startswith(e["slot"], F.lit("str_")))
        replaced = bind(
            entry_map(strings, "literal", "slot"),
            lambda slot_of: F.aggregate(
                occurrences,
                text,
                lambda acc, o: F.coalesce(F.replace(acc, o["quoted"], F.try_element_at(slot_of, o["v"])), acc),
            ),
        )
        if variables is None:
            return replaced
        named = F.filter(known, lambda e: F.startswith(e["slot"], F.lit("var_")))
        return _replace_each(replaced, named, lambda e: e["literal"], lambda e: e["slot"])

    return bind(slots, fill)


def entry_map(entries: Column, key: str, value: str) -> Column:
    """Map view of entries; when a key repeats, its last entry counts."""

    def last_only(all_entries: Column) -> Column:
        backwards = F.reverse(F.transform(all_entries, lambda e: e[key]))
        return bind(
            F.struct(all_entries.alias("all"), backwards.alias("keys")),
            lambda b: F.filter(b["all"], lambda e, i: F.size(b["keys"]) - F.array_position(b["keys"], e[key]) == i),
        )

    pairs = F.transform(bind(entries, last_only), lambda e: F.struct(e[key].alias("k"), e[value].alias("v")))
    return F.map_from_entries(pairs)


def map_invert(m: Column | str) -> Column:
    """Swap keys and values; of equal values the last key stays."""
    swapped = F.transform(
        F.map_entries(_col(m)), lambda e: F.struct(e["value"].alias("k"), e["key"].alias("v"))
    )
    return entry_map(swapped, "k", "v")


def map_lookup(m: Column | str, key: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(_col(m), key), default)


def map_lines(m: Column | str) -> Column:
    """A map as sorted ``key=value`` lines, for output and comparison."""
    entries = F.sort_array(F.transform(F.map_entries(_col(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.array_join(entries, "\n")


def unslot_words(c: Column | str, slots: Column) -> Column:
    """Slot names back to values: bracketed slots as text first, then whole words.

    Whole words only, so that var_1 never eats the head of var_10.
    """
    lists = F.filter(F.map_entries(slots), lambda e: is_enumerable(e["key"]))
    text = _replace_each(_col(c), lists, lambda e: e["key"], lambda e: e["value"])
    pieces = F.split(text, r"(?<![A-Za-z0-9_])|(?![A-Za-z0-9_])")
    return F.array_join(F.transform(pieces, lambda p: F.coalesce(F.try_element_at(slots, p), p)), "")


def unslot_literals(c: Column | str, slots: Column) -> Column:
    """Every slot name back to its literal, in the order of the literal-to-slot entries."""
    return _replace_each(_col(c), slots, lambda e: e["slot"], lambda e: e["literal"])


def is_slot_name(token: Column) -> Column:
    """Whether a token is a slot's name, whatever its number."""
    return token.rlike("^(var|str)_[0-9]+$")


def without_slot_names(tokens: Column | str) -> Column:
    return F.filter(_col(tokens), lambda t: ~is_slot_name(t))
