"""Sampling and first-n (M1, M2, T4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.hashing import MODULUS, seeded_key

_BUCKETS = 4096


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Approximate-size sample without replacement (per-partition Bernoulli, no shuffle)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all) with the smallest seeded hash key, ties by id (any orderable id type).

    The cut-off key is found by at most three bucket-count passes (4096 buckets
    each, partial aggregation); no global sort, no row reaches the driver beyond
    the bucket counts and the handful of ids that share the cut-off key.
    """
    from pyspark.sql import types as T
    integral = isinstance(df.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    # integer ids use the portable key (reproducible in SQL); other ids are hashed to a non-negative long first
    base = F.col(id_col) if integral else F.pmod(F.xxhash64(F.col(id_col)), F.lit(2 ** 62))
    keyed = df.withColumn("_key", seeded_key(base, seed))
    total = keyed.count()
    if n >= total:
        return keyed.drop("_key")
    if n <= 0:
        return keyed.limit(0).drop("_key")
    lo, hi, need = 0, MODULUS, n
    while hi - lo > 1:
        width = -(-(hi - lo) // _BUCKETS)
        counts = (keyed.where((F.col("_key") >= lo) & (F.col("_key") < hi))
                  .groupBy(F.floor((F.col("_key") - lo) / width).alias("b")).count().collect())
        acc = 0
        for row in sorted(counts, key=lambda r: r["b"]):
            if acc + row["count"] >= need:
                lo, hi = lo + row["b"] * width, min(hi, lo + (row["b"] + 1) * width)
                need -= acc
                break
            acc += row["count"]
    cut = lo
    ties = [r[0] for r in keyed.where(F.col("_key") == cut).select(id_col).orderBy(id_col).limit(need).collect()]
    last = ties[-1]
    return keyed.where((F.col("_key") < cut) | ((F.col("_key") == cut) & (F.col(id_col) <= last))).drop("_key")


def stratified_sample(df: DataFrame, strata: Sequence[str], id_col: str, per_stratum: int,
                      total: int | None = None, seed: int = 42) -> DataFrame:
    """Up to ``per_stratum`` rows per stratum in seeded order; optionally the first ``total`` in strata order.

    ``row_number() <= k`` is planned as a WindowGroupLimit, so each map task
    keeps only k rows per stratum before the shuffle: a hot stratum costs no
    more than a small one.
    """
    w = Window.partitionBy(*strata).orderBy(seeded_key(id_col, seed), F.col(id_col))
    picked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_stratum)
    if total is not None:
        picked = picked.orderBy(*[F.col(s).asc_nulls_last() for s in strata], "_rn").limit(total)
    return picked.drop("_rn")


def first_n(df: DataFrame, id_col: str, n: int, as_string: bool = False) -> DataFrame:
    """First ``n`` rows by id (numeric order, or string order of the id as the reference's dict keys)."""
    key = F.col(id_col).cast("string") if as_string else F.col(id_col)
    return df.orderBy(key).limit(n)
