"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame expressions.

The shard of a row is a function of its key and the number of shards alone: no ring, no table, and with
one more shard only the rows that move into it change place.  ``slot`` numbers the rows of a shard
without gaps.  A shard may hold any share of the rows, so it is numbered in many small buckets whose
offsets come from a count per bucket; no task ever sees a whole shard.

Defined results: a null key is a key like any other (all null keys share a shard); equal keys share a
shard and get different slots; an empty table gives an empty table; columns of the caller are kept, and
those named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlens.llm.columns import packed, unpacked

MULTIPLIER = 2862933555777941757  # of the published generator
STEPS = 64


def stable_key(c: Column) -> Column:
    """64-bit key of any column type; null has a key of its own."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null")))


def _next_key(key: Column) -> Column:
    """``key * MULTIPLIER + 1`` modulo 2**64, in 22-bit limbs: no product or sum overflows a long."""
    low = (1 << 22) - 1
    a = [MULTIPLIER & low, MULTIPLIER >> 22 & low, MULTIPLIER >> 44]
    k = [key.bitwiseAND(low), F.shiftrightunsigned(key, 22).bitwiseAND(low), F.shiftrightunsigned(key, 44)]
    r0 = k[0] * a[0] + 1
    r1 = k[0] * a[1] + k[1] * a[0] + F.shiftrightunsigned(r0, 22)
    r2 = k[0] * a[2] + k[1] * a[1] + k[2] * a[0] + F.shiftrightunsigned(r1, 22)
    return (r0.bitwiseAND(low).bitwiseOR(F.shiftleft(r1.bitwiseAND(low), 22))
            .bitwiseOR(F.shiftleft(r2.bitwiseAND((1 << 20) - 1), 44)))


def jump_hash(key: Column, n_shards: int) -> Column:
    """Shard 0 to ``n_shards`` - 1 of a 64-bit key.

    Each jump moves at least one shard on, so ``n_shards`` jumps suffice; they are done in groups of
    ``STEPS``, and a group costs one comparison once a key has arrived (after about ln n jumps).
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")

    def state(k: Column, b: Column, j: Column) -> Column:
        return F.struct(k.alias("k"), b.alias("b"), j.alias("j"))

    def jump(s: Column) -> Column:
        k = _next_key(s["k"])
        step = (s["j"] + 1).cast("double") * (
            F.lit(float(1 << 31)) / (F.shiftrightunsigned(k, 33) + 1).cast("double"))
        return F.when(s["j"] >= n_shards, s).otherwise(state(k, s["j"], F.floor(step).cast("long")))

    start = state(key, F.lit(-1).cast("long"), F.lit(0).cast("long"))
    group = F.sequence(F.lit(1), F.lit(min(STEPS, n_shards)))
    groups = F.sequence(F.lit(1), F.lit(-(-n_shards // STEPS)))
    end = F.aggregate(groups, start, lambda s, _: F.when(s["j"] >= n_shards, s).otherwise(
        F.aggregate(group, s, lambda t, _: jump(t))))
    return end["b"].cast("int")


def shard(docs: DataFrame, key_col: str, n_shards: int, order: list[str] | None = None) -> DataFrame:
    """``docs`` with ``shard``, ``grown_shard`` (with one more shard) and ``slot`` (0, 1, ... in each shard).

    ``order``: further columns that order equal keys, to make their slots repeatable.
    """
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = stable_key(docs[key_col])
    ties = [docs[c].alias(f"__o{i}") for i, c in enumerate(order or [])]
    placed = docs.select(packed(docs), key.alias("__key"), docs[key_col].alias("__id"), *ties,
                         jump_hash(key, n_shards).alias("__shard"), jump_hash(key, n_shards + 1).alias("__grown"))
    spread = F.pmod(F.xxhash64(F.lit(11), "__key"), F.lit(buckets)).cast("int")
    placed = placed.withColumn("__bucket", spread)
    counts = placed.groupBy("__shard", "__bucket").agg(F.count("*").alias("__n"))
    ahead = W.partitionBy("__shard").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(  # one row per shard and bucket: the size does not follow the input
        F.col("__shard").alias("__s"), F.col("__bucket").alias("__b"),
        F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__ahead"))
    inside = W.partitionBy("__shard", "__bucket").orderBy("__id", *[f"__o{i}" for i in range(len(ties))])
    numbered = placed.withColumn("__rank", F.row_number().over(inside) - 1).join(
        offsets, (F.col("__shard") == F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    return unpacked(numbered, docs.columns, shard=F.col("__shard"), grown_shard=F.col("__grown"),
                    slot=(F.col("__ahead") + F.col("__rank")).cast("long"))
