"""Aspect analytics.

Input is the flattened aspect table ``(…, aspect, sentiment, evidence,
confidence, seq)`` where ``seq`` is the order of first appearance.  Every
operator is a grouped aggregate with map-side partial aggregation; top-k
reports use ``orderBy().limit()`` (distributed top-k) and rank only the k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions import text
from feedlens.operators import ranks


def _rank_small(df: DataFrame, order: Sequence, name: str = "rank") -> DataFrame:
    """Rank an already-limited (k-row) frame."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("int"))


def top_k_by_count(df: DataFrame, key: str, k: int, seq: str = "seq") -> DataFrame:
    """Top-k keys by count; ties go to the key seen first (stable Counter order)."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"), F.min(seq).alias("first_seq"))
    top = counts.orderBy(F.desc("n"), F.asc("first_seq")).limit(k)
    return _rank_small(top, [F.desc("n"), F.asc("first_seq")])


def extraction_summary(ex: DataFrame, top_n: int = 20) -> DataFrame:
    """Flat summary rows ``(section, key, rank, value)``: total, sentiment counts, top aspects.

    One grouped aggregate per (aspect, sentiment) feeds all three sections, so
    the input is read and shuffled once (the exchange is reused).
    """
    per = ex.groupBy("aspect", "sentiment").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
    total = per.agg(F.lit("total_aspects").alias("section"), F.lit(None).cast("string").alias("key"),
                    F.lit(None).cast("int").alias("rank"), F.sum("n").cast("long").alias("value"))
    sent = per.groupBy("sentiment").agg(F.sum("n").cast("long").alias("value")).select(
        F.lit("sentiment").alias("section"), F.col("sentiment").alias("key"), F.lit(None).cast("int").alias("rank"),
        "value")
    by_aspect = per.groupBy("aspect").agg(F.sum("n").cast("long").alias("n"), F.min("first_seq").alias("first_seq"))
    top = by_aspect.orderBy(F.desc("n"), F.asc("first_seq")).limit(top_n)
    top = _rank_small(top, [F.desc("n"), F.asc("first_seq")]).select(
        F.lit("top_aspect").alias("section"), F.col("aspect").alias("key"), "rank", F.col("n").alias("value"))
    return total.unionByName(sent).unionByName(top)


def confidence_stats(df: DataFrame, col: str = "confidence", keys: Sequence[str] = ()) -> DataFrame:
    """mean, median, population std, min, max (numpy semantics); the median by exact ranks, per group if asked for."""
    x = F.col(col).cast("double")
    aggs = [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]
    median = ranks.order_statistics(df, {"median": (col, 0.5)}, keys)
    columns = [*keys, "n", "mean", "median", "std", "min", "max"]
    if not keys:
        return ranks.one_row([df.agg(*aggs), median]).select(*columns)
    other = median.toDF(*[f"_m{i}" for i in range(len(keys))], "median")
    same = [F.col(k).eqNullSafe(F.col(f"_m{i}")) for i, k in enumerate(keys)]
    return df.groupBy(*keys).agg(*aggs).join(other, same, "left").select(*columns)


def confidence_tiers(df: DataFrame, col: str = "confidence") -> DataFrame:
    """Tier shares: (a) >0.80 / [0.60, 0.80] / <0.60 in %, (b) >0.5 / [0.35, 0.5] / <0.35 counts."""
    x = F.col(col)
    n = F.count(x)
    return df.agg(
        (F.lit(100.0) * F.count_if(x > 0.80) / n).alias("high_pct"),
        (F.lit(100.0) * F.count_if((x >= 0.60) & (x <= 0.80)) / n).alias("medium_pct"),
        (F.lit(100.0) * F.count_if(x < 0.60) / n).alias("low_pct"),
        F.count_if(x > 0.5).alias("high_n"),
        F.count_if((x >= 0.35) & (x <= 0.5)).alias("medium_n"),
        F.count_if(x < 0.35).alias("low_n"))


def sentiment_distribution(df: DataFrame, col: str = "sentiment") -> DataFrame:
    """Open sentiment counts with share of total (any label, not only three)."""
    agg = df.groupBy(col).agg(F.count("*").alias("n"))
    return agg.withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()))


def aspects_per_comment(counts: DataFrame, n_col: str = "num_aspects") -> DataFrame:
    """Profile of aspects per successful comment (zeros included): mean, median, pop std, min, max."""
    x = F.col(n_col).cast("double")
    return counts.agg(F.count(x).alias("total_comments"), F.avg(x).alias("mean_aspects"),
                      F.percentile(x, 0.5).alias("median_aspects"), F.stddev_pop(x).alias("std_dev"),
                      F.min(n_col).alias("min_aspects"), F.max(n_col).alias("max_aspects"))


def dedup_potential(df: DataFrame, col: str = "aspect") -> DataFrame:
    """total, unique (lower+strip key), duplicate %, redundancy ratio."""
    per_key = df.groupBy(text.dedup_key(col).alias("k")).agg(F.count("*").alias("c"))
    agg = per_key.agg(F.sum("c").cast("long").alias("total_aspects"), F.count("*").alias("unique_aspects"))
    dup = (F.lit(1.0) - F.col("unique_aspects") / F.col("total_aspects")) * 100.0
    return (agg.withColumn("duplicate_pct", dup)
            .withColumn("redundancy_ratio", F.lit(1.0) - F.col("duplicate_pct") / 100.0))


def dedup_keep_best(df: DataFrame, col: str = "aspect", seq: str = "seq", conf: str = "confidence") -> DataFrame:
    """One row per lower+strip key: the highest confidence, the first seen on ties.

    ``max_by`` over ``(confidence, -seq)`` is a hash aggregate with a partial
    (map-side) phase, so a key that holds a third of all rows is reduced inside
    each map task before the shuffle.
    """
    keyed = df.withColumn("dedup_key", text.dedup_key(col))
    cols = [c for c in keyed.columns if c != "dedup_key"]
    best = keyed.groupBy("dedup_key").agg(
        F.max_by(F.struct(*cols), F.struct(F.col(conf), -F.col(seq))).alias("best"))
    return best.select("dedup_key", "best.*")


def normalize_names(df: DataFrame, col: str = "aspect", word_boundary: bool = False, rededup: bool = False,
                    seq: str = "seq", conf: str = "confidence") -> DataFrame:
    """Strip, lower-case, drop 'the ' (Q5).  ``rededup=True`` merges names that collide after
    normalising (the reference does not), keeping the most confident, first seen on ties."""
    out = df.withColumn(col, text.normalize_name(col, word_boundary))
    if rededup:
        out = dedup_keep_best(out.drop("dedup_key") if "dedup_key" in out.columns else out, col, seq, conf)
    return out


def top_aspect_sentiment(df: DataFrame, k: int = 10, col: str = "aspect", seq: str = "seq") -> DataFrame:
    """Sentiment cross-tab (long form) for the top-k aspects: count and row %."""
    top = top_k_by_count(df, col, k, seq).select(col, "rank")
    picked = df.join(F.broadcast(top.select(col)), col, "left_semi")  # k rows: broadcast is bounded
    counts = picked.groupBy(col, "sentiment").agg(F.count("*").alias("n"))
    per_aspect = Window.partitionBy(col)
    return (counts.withColumn("row_pct", F.lit(100.0) * F.col("n") / F.sum("n").over(per_aspect))
            .join(F.broadcast(top), col))


def cluster_drilldown(df: DataFrame, cluster_id: int, cluster_col: str = "cluster_id",
                      conf: str = "confidence") -> DataFrame:
    """One cluster: size, confidence mean/min/max and upper median, sentiment counts as a map.

    Aggregates per sentiment first, then folds the (few) sentiment rows into one
    row; the upper median (``sorted(x)[n // 2]``) comes from exact ranks.
    """
    one = df.where(F.col(cluster_col) == cluster_id)
    median = ranks.order_statistics(one, {"upper_median_confidence": (conf, None)})
    per_sent = one.groupBy("sentiment").agg(
        F.count("*").alias("n"), F.sum(conf).alias("s"), F.count(conf).alias("c"),
        F.min(conf).alias("lo"), F.max(conf).alias("hi"))
    folded = per_sent.agg(
        F.lit(cluster_id).alias(cluster_col), F.sum("n").cast("long").alias("size"),
        (F.sum("s") / F.sum("c")).alias("mean_confidence"), F.min("lo").alias("min_confidence"),
        F.max("hi").alias("max_confidence"), F.map_from_entries(F.collect_list(F.struct("sentiment", "n"))).alias("sentiment_counts"))
    return ranks.one_row([folded, median]).select(cluster_col, "size", "mean_confidence", "min_confidence", "max_confidence",
                                             "upper_median_confidence", "sentiment_counts")


def sentiment_rollup(per_cluster_maps: DataFrame, map_col: str = "sentiments") -> DataFrame:
    """Roll per-cluster sentiment maps back into overall counts."""
    return (per_cluster_maps.select(F.explode(map_col).alias("sentiment", "n"))
            .groupBy("sentiment").agg(F.sum("n").cast("long").alias("n")))


def final_summary(ex: DataFrame, successful_comments: DataFrame) -> DataFrame:
    """The notebook's closing table: totals, averages and sentiment shares (one row).

    Aspect rows and comment rows are tagged and unioned, then folded by one
    aggregate with conditional terms (no join of one-row frames).
    """
    a = ex.select(F.lit(True).alias("_asp"), "aspect", "sentiment", F.col("confidence").cast("double").alias("confidence"))
    c = successful_comments.select(F.lit(False).alias("_asp"), F.lit(None).cast("string").alias("aspect"),
                                   F.lit(None).cast("string").alias("sentiment"),
                                   F.lit(None).cast("double").alias("confidence"))
    asp = F.col("_asp")
    n_asp = F.count_if(asp)
    share = lambda label: F.lit(100.0) * F.count_if(asp & (F.col("sentiment") == label)) / n_asp
    out = a.unionByName(c).agg(
        n_asp.alias("total_aspects"), F.countDistinct(F.when(asp, F.col("aspect"))).alias("unique_aspects"),
        F.avg(F.when(asp, F.col("confidence"))).alias("avg_confidence"),
        share("positive").alias("positive_pct"), share("negative").alias("negative_pct"),
        share("neutral").alias("neutral_pct"), F.count_if(~asp).alias("total_comments"))
    return out.withColumn("avg_aspects_per_comment", F.col("total_aspects") / F.col("total_comments"))
