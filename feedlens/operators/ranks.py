"""Exact order statistics of any number of columns and groups, without a value map in one task.

Values are counted by (group, column, value), the counts are range-partitioned in that order, and prefix sums per
partition (``ordered.running_sum``) give each distinct value its ranks.  Only the values that hold a wanted rank go on:
at most two per group, column and probability.  A value that most rows share is one counted row.

Nulls are not counted; a group without values has null statistics; NaN is above all numbers, as Spark orders it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators import ordered
from feedlens.session import materialize


def _ranked(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """(keys, name, value, first, n, total): ``n`` rows hold the value, from rank ``first`` on, among ``total``."""
    part = [f"k{i}" for i in range(len(keys))]
    values = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    rows = df.select(*[F.col(f"`{k}`").alias(p) for k, p in zip(keys, part)], F.explode(values).alias("x")).select(*part, "x.*")
    counts = rows.where("value is not null").groupBy(*part, "name", "value").agg(F.count("*").alias("n"))
    cum = materialize(ordered.running_sum(counts, [*part, "name", "value"], ["n"], "_before", exclusive=True), "ranks")
    groups = cum.groupBy(*part, "name").agg(F.min("n_before").alias("start"), F.sum("n").alias("total"))
    other = groups.toDF(*[f"g{i}" for i in range(len(part))], "gname", "start", "total")
    same = F.col("name") == F.col("gname")
    for i, p in enumerate(part):
        same = same & F.col(p).eqNullSafe(F.col(f"g{i}"))
    joined = cum.join(other, same)
    return joined.select(*part, "name", "value", (F.col("n_before") - F.col("start")).alias("first"), "n", "total"), part


def order_statistics(df: DataFrame, wanted: dict[str, tuple[str, float | None]], keys: Sequence[str] = ()) -> DataFrame:
    """``keys`` and one column per entry of ``wanted``: output name -> (column, probability).

    A probability gives the interpolated percentile (as ``percentile``), None the upper median: the value at
    rank n // 2 of the sorted values.
    """
    ranked, part = _ranked(df, sorted({c for c, _ in wanted.values()}), keys)
    last = F.col("total") - 1

    def ends(p: float | None) -> tuple[Column, Column]:
        if p is None:
            at = F.floor(F.col("total") / 2)
            return at, at
        return F.floor(last * F.lit(p)), F.ceil(last * F.lit(p))

    def holds(rank: Column) -> Column:
        return (F.col("first") <= rank) & (rank < F.col("first") + F.col("n"))
    hit, aggs, out = F.lit(False), [], []
    for i, (name, (column, p)) in enumerate(wanted.items()):
        lo, hi = ends(p)
        mine = F.col("name") == column
        hit = hit | (mine & (holds(lo) | holds(hi)))
        aggs += [F.max(F.when(mine & holds(lo), F.col("value"))).alias(f"lo{i}"), F.max(F.when(mine & holds(hi), F.col("value"))).alias(f"hi{i}"),
                 F.max(F.when(mine, F.col("total"))).alias(f"n{i}")]
        at = (F.col(f"n{i}") - 1) * F.lit(0.0 if p is None else p)
        between = (F.ceil(at) - at) * F.col(f"lo{i}") + (at - F.floor(at)) * F.col(f"hi{i}")
        exact = F.lit(True) if p is None else F.floor(at) == F.ceil(at)
        out.append(F.when(exact | (F.col(f"lo{i}") == F.col(f"hi{i}")), F.col(f"lo{i}")).otherwise(between).alias(name))
    rows = ranked.where(hit)
    found = rows.groupBy(*part).agg(*aggs) if part else rows.agg(*aggs)
    return found.select(*[F.col(p).alias(k) for p, k in zip(part, keys)], *out)


def one_row(frames: Sequence[DataFrame]) -> DataFrame:
    """One-row frames side by side, without a join: each row is tagged, unioned and folded into one."""
    names = [(f"_f{i}", frame) for i, frame in enumerate(frames)]
    out = None
    for name, frame in names:
        row = frame.select(*[F.struct(*[F.col(f"`{c}`") for c in f.columns]).alias(n) if n == name else
                             F.lit(None).cast(T.StructType(f.schema.fields)).alias(n) for n, f in names])
        out = row if out is None else out.unionByName(row)
    folded = out.agg(*[F.first(n, ignorenulls=True).alias(n) for n, _ in names])
    return folded.select(*[F.col(n)[c].alias(c) for n, f in names for c in f.columns])
