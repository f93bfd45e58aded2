"""Literals, durations, run folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from pairloom.functions.text import _col, strip

# The text that reads as a decimal number, and as a special number.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER = rf"\A[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"
SPECIAL_NUMBER = r"(?i)\A[+-]?(?:inf|infinity|nan)\z"
# Quoted text without escapes or inner quotes.
PLAIN_QUOTED = r"(?d)\A(?:'[^'\\\n]*'|\"[^\"\\\n]*\")\z"

_LONG_LIMIT = 9.2233720368547e18


def literal_value(c: Column | str, keep_fraction: bool = False) -> Column:
    """Typed reading of a literal: struct<kind, long, double, string>.

    Numbers lose their fraction unless ``keep_fraction``; NaN, infinities and numbers past the range of
    a long stay doubles. True, False, None and plainly quoted text are read; anything else stays text.
    """
    raw = _col(c)
    text = strip(raw)
    number = F.regexp_replace(text, "_", "").try_cast("double")
    lowered = F.lower(text)
    special = (
        F.when(lowered.contains("nan"), F.lit(float("nan")))
        .when(F.startswith(lowered, F.lit("-")), F.lit(float("-inf")))
        .otherwise(F.lit(float("inf")))
    )
    fits = F.abs(number) < _LONG_LIMIT
    keeps = F.lit(keep_fraction) & (number != F.floor(number))

    def value(kind: str, long: Column | None = None, double: Column | None = None, string: Column | None = None) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            (F.lit(None) if long is None else long).cast("bigint").alias("long"),
            (F.lit(None) if double is None else double).cast("double").alias("double"),
            (F.lit(None) if string is None else string).cast("string").alias("string"),
        )

    return (
        F.when(raw.isNull(), value("none"))
        .when(text.rlike(NUMBER) & fits & ~keeps, value("long", long=number.try_cast("bigint")))
        .when(text.rlike(NUMBER), value("double", double=number))
        .when(text.rlike(SPECIAL_NUMBER), value("double", double=special))
        .when(raw == "True", value("bool", long=F.lit(1)))
        .when(raw == "False", value("bool", long=F.lit(0)))
        .when(raw == "None", value("none"))
        .when(raw.rlike(PLAIN_QUOTED), value("string", string=F.substring(raw, F.lit(2), F.length(raw) - 2)))
        .otherwise(value("string", string=raw))
    )


def elapsed(seconds: Column) -> tuple[Column, Column]:
    """Whole minutes, and the whole seconds left over."""
    minutes = F.floor(seconds / 60)
    return minutes.cast("bigint"), F.floor(seconds - minutes * 60).cast("bigint")


# The parameters in a run folder's name, in order.
RUN_PARAMETERS = (
    "model",
    "dataset",
    "word_freq",
    "nl_embed_size",
    "action_embed_size",
    "att_size",
    "hidden_size",
    "epochs",
    "dropout_encoder",
    "dropout_decoder",
    "batch_size",
    "parent_feeding_type",
    "parent_feeding_field",
    "change_term_name",
    "seed",
)
# Fixed value: the name of a run's folder.
RUN_FOLDER = (
    "%s.dataset_%s._word_freq_%s.nl_embed_%s.action_embed_%s.att_size_%s.hidden_size_%s.epochs_%s.dropout_enc_%s.dropout_dec_%s"
    ".batch_size%s.parent_feeding_type_%s.parent_feeding_field_%s.change_term_name_%s.seed_%s/"
)


def run_path(parameters: Sequence[Column | str] = RUN_PARAMETERS, root: str = "./outputs/") -> Column:
    """Folder of a run, named by its parameters; null if one of them is."""
    values = [_col(p).cast("string") for p in parameters]
    return F.when(F.concat(*values).isNotNull(), F.concat(F.lit(root), F.format_string(RUN_FOLDER, *values)))
