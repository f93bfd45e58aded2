"""Tokenizing, fragments, markers and other text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The blanks that Python's str.split and \s see, as a regex class body.
BLANKS = r"\t\n\x0b\f\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Markers around a token sequence.
SENTENCE_MARKERS = ("<s>", "</s>")
MODEL_MARKERS = ("[CLS]", "[SEP]")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def texts(values: Sequence[str]) -> Column:
    """A constant array of strings (also when empty)."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def tokenize_code(c: Column | str) -> Column:
    """Words split at aB boundaries, every other visible character alone, both quotes as backtick.

    The pattern tries a word, a visible ASCII character and all else in turn: most matches need no look at the long list of blanks.
    """
    quoted = F.replace(F.replace(_col(c), F.lit('"'), F.lit("`")), F.lit("'"), F.lit("`"))
    spaced = F.regexp_replace(quoted, "([a-z])([A-Z])", "$1 $2")
    return F.regexp_extract_all(spaced, F.lit(rf"\w++|[!-~]|[^\w{BLANKS}]"), F.lit(0))


def tokenize_ws(c: Column | str) -> Column:
    return F.array_remove(F.split(_col(c), f"[{BLANKS}]+"), "")


def strip(c: Column | str) -> Column:
    """Trim every kind of blank, not only the space."""
    return F.regexp_replace(_col(c), rf"\A[{BLANKS}]+|[{BLANKS}]+\z", "")


def lower_text(c: Column | str) -> Column:
    return F.lower(_col(c))


def wrap_markers(tokens: Column | str, markers: tuple[str, str] = SENTENCE_MARKERS) -> Column:
    return F.concat(texts(markers[:1]), _col(tokens), texts(markers[1:]))


def sentence_line(tokens: Column | str) -> Column:
    return F.concat_ws(" ", wrap_markers(tokens))


def break_dotted(tokens: Column | str) -> Column:
    """After a token with a dot that is not its last character, add its parts in brackets."""

    def parts(token: Column) -> Column:
        pieces = F.split(F.replace(token, F.lit("."), F.lit(" . ")), " ")
        dot = F.instr(token, ".")
        whole = F.array(token)
        broken = F.concat(whole, F.array(F.lit("[")), pieces, F.array(F.lit("]")))
        return F.when((dot > 0) & (dot < F.length(token)), broken).otherwise(whole)

    return F.flatten(F.transform(_col(tokens), parts))


def percent_s_fix(c: Column | str) -> Column:
    """Undo the spacing that tokenizing puts inside a quoted %s."""
    single = F.replace(_col(c), F.lit("' % s '"), F.lit("%s"))
    return F.replace(single, F.lit('" % s "'), F.lit("%s"))


# The shapes of names worth a vocabulary entry of their own: a_b, a.b, ABc.
WORD = r"[\p{L}\p{N}_]+"  # letters and digits of every script
NAME_PATTERNS = (f"[a-zA-Z.]*_{WORD}", rf"[a-zA-Z.]*\.{WORD}", f"[A-Z.]+{WORD}")


def extract_identifiers(c: Column | str) -> Column:
    return F.concat(*[F.regexp_extract_all(_col(c), F.lit(p), F.lit(0)) for p in NAME_PATTERNS])


def wrap_fragment(c: Column | str) -> Column:
    """Complete a loose line of code so that it can be parsed by itself."""
    code = _col(c)

    def opens(*words: str) -> Column:
        hit = F.startswith(code, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.startswith(code, F.lit(word))
        return hit

    completed = (
        F.when(opens("elif", "else"), F.concat(F.lit("if True: pass\n"), code))
        .when(opens("try"), F.concat(code, F.lit("pass\nexcept: pass")))
        .when(opens("except", "finally"), F.concat(F.lit("try: pass\n"), code))
        .when(opens("@"), F.concat(code, F.lit("\ndef dummy(): pass")))
        .otherwise(code)
    )
    return F.when(F.endswith(completed, F.lit(":")), F.concat(completed, F.lit("pass"))).otherwise(completed)


def param_terms(c: Column | str) -> Column:
    """Parameter names that a docstring declares: ``:param name:``, ``:param type name:``, ``:param *name:``."""
    return F.array_distinct(F.regexp_extract_all(_col(c), F.lit(r":param (?:[^:\n]*?[ *])?(\w+)(?=\s*:)"), F.lit(1)))


def mark_terms(c: Column | str, terms: Column) -> Column:
    """Put every listed term between backticks, all terms in one pass over the text."""
    escaped = F.transform(terms, lambda t: F.regexp_replace(t, r"([\\.\[\]{}()*+\-?^$|])", r"\\$1"))
    pattern = F.array_join(escaped, "|")
    return F.when(F.size(terms) == 0, _col(c)).otherwise(F.regexp_replace(_col(c), pattern, F.lit("`$0`")))


def request(rewritten: Column | str, original: Column | str) -> Column:
    """The rewritten request, or the original one where that is missing or empty."""
    return F.coalesce(F.nullif(_col(rewritten), F.lit("")), _col(original))


def array_text(tokens: Column | str) -> Column:
    return F.array_join(_col(tokens), " ")


def map_other(tokens: Column | str, known: Sequence[str], other: str = "id") -> Column:
    """Tokens outside ``known`` become ``other``."""
    return F.transform(_col(tokens), lambda t: F.when(t.isin(*known), t).otherwise(F.lit(other)))


def without(tokens: Column | str, dropped: Sequence[str]) -> Column:
    """Tokens of the list that are not in ``dropped``; repeats stay."""
    return F.filter(_col(tokens), lambda t: ~t.isin(*dropped))
