"""Column helpers shared by the operators of this subpackage (JVM-side, no UDFs)."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "__row"  # the caller's columns travel packed in one struct, so no internal name can clash with them


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside the lambdas of ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on pure ASCII and is the faster one there."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def text_of(df: DataFrame, text_col: str) -> Column:
    """The text as a string, null as the empty text."""
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct column named ``ROW``."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(ROW)


def unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The caller's ``columns`` back from ``ROW``; ``new`` columns replace those of the same name or follow."""
    kept = [new[c].alias(c) if c in new else F.col(ROW)[c].alias(c) for c in columns]
    return df.select(*kept, *[v.alias(c) for c, v in new.items() if c not in columns])


def count_below(ordered: Column, size: Column, most: int, low: Column) -> Column:
    """How many elements of the sorted array ``ordered`` (``size``, at most ``most``) are below ``low``: binary search."""
    powers = F.array(*[F.lit(1 << b) for b in range(most.bit_length() - 1, -1, -1)] or [F.lit(1)])

    def step(at: Column, power: Column) -> Column:
        to = at + power
        return F.when((to <= size) & (F.get(ordered, to - 1) < low), to).otherwise(at)
    return F.aggregate(powers, F.lit(0), step)
