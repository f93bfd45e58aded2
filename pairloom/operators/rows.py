"""Opening lists into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def open_list(df: DataFrame, items: Column | str, *keep: str, item: str = "token", pos: str = "pos") -> DataFrame:
    """One row per list item with its position from 0; an empty list gives no row.

    The outer form and a test on the position, not the plain form: for that one the optimizer adds a
    test of the list's size below every exchange, which works out a computed list two more times.
    """
    opened = df.select(*keep, F.posexplode_outer(items).alias(pos, item))
    return opened.where(F.col(pos).isNotNull())


def open_structs(df: DataFrame, items: Column | str, *keep: str, pos: str = "pos") -> DataFrame:
    """One row per struct of a list, its fields as columns."""
    return open_list(df, items, *keep, item="_item", pos=pos).select(*keep, pos, "_item.*")
