"""Corpus profiling: per-text metrics, bins, numeric profiles, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions import binning, text
from feedlens.operators import ranks


def profile_text(df: DataFrame, text_col: str = "comment", edges: Sequence[float] = binning.SAMPLE_BINS[0],
                 labels: Sequence[str] = binning.SAMPLE_BINS[1]) -> DataFrame:
    """Add ``length, word_count, rough_sentiment, length_bin, length_bin_ord`` (narrow, no shuffle)."""
    counted = text.lexicon_counts(df, text_col, pos_out="_pos", neg_out="_neg")
    return (counted
            .withColumn("length", text.char_length(text_col))
            .withColumn("word_count", text.word_count(text_col))
            .withColumn("rough_sentiment", text.polarity("_pos", "_neg"))
            .withColumn("length_bin", binning.bin_column("length", edges, labels))
            .withColumn("length_bin_ord", binning.bin_ordinal("length", edges))
            .drop("_pos", "_neg"))


def share_pct(count_col: str = "n") -> F.Column:
    """Percentage of the column total; use only on already-aggregated (small) frames."""
    return F.lit(100.0) * F.col(count_col) / F.sum(count_col).over(Window.partitionBy())


def bin_sentiment_table(profiled: DataFrame) -> DataFrame:
    """Length bin x rough sentiment: count, share of all texts, mean words (the flagship report)."""
    agg = (profiled.groupBy("length_bin_ord", "length_bin", "rough_sentiment")
           .agg(F.count("*").alias("n"), F.avg("word_count").alias("avg_words")))
    return agg.withColumn("share_pct", share_pct("n"))


def length_bins(df: DataFrame, value_col: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Histogram over right-closed bins: ``bin_ord, bin, n, pct`` (values outside the edges -> null bin)."""
    agg = (df.select(binning.bin_ordinal(value_col, edges).alias("bin_ord"),
                     binning.bin_column(value_col, edges, labels).alias("bin"))
           .groupBy("bin_ord", "bin").agg(F.count("*").alias("n")))
    return agg.withColumn("pct", share_pct("n"))


def numeric_profile(df: DataFrame, cols: Sequence[str], sample_std: bool = True, approx: bool = False) -> DataFrame:
    """One row per column: n, min, max, mean, median, std, p25, p75 - from a single scan.

    ``percentile`` is exact with linear interpolation (pandas ``quantile``); its
    state is a value->count map, so it stays small for low-cardinality columns
    such as lengths.  ``approx=True`` switches to ``percentile_approx`` for
    high-cardinality columns at very large N.
    """
    std = F.stddev_samp if sample_std else F.stddev_pop
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        q = (F.percentile_approx(x, [0.25, 0.5, 0.75], 10000).cast("array<double>") if approx
             else F.percentile(x, [0.25, 0.5, 0.75]))
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.avg(x).alias(f"mean{i}"), std(x).alias(f"std{i}"), q.alias(f"q{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("metric"), F.col(f"n{i}").alias("n"), F.col(f"lo{i}").alias("min"),
                     F.col(f"hi{i}").alias("max"), F.col(f"mean{i}").alias("mean"),
                     F.col(f"q{i}")[1].alias("median"), F.col(f"std{i}").alias("std"),
                     F.col(f"q{i}")[0].alias("p25"), F.col(f"q{i}")[2].alias("p75")) for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def text_digest(col) -> F.Column:
    """SHA-256 of a text: an exact (collision-free in practice) 32-byte key for whole-text distinct counts."""
    return F.sha2(F.col(col) if isinstance(col, str) else col, 256)


def dup_counts(df: DataFrame, col: str) -> DataFrame:
    """Total, distinct, duplicate rows and duplicate % of one text column.

    Texts are grouped by their SHA-256 digest, so the shuffle moves 32 bytes per
    row instead of the whole text.
    """
    per_value = df.groupBy(text_digest(col).alias("_k")).agg(F.count("*").alias("c"))
    return per_value.agg(
        F.sum("c").cast("long").alias("total"),
        F.count("*").alias("unique"),
        (F.sum("c") - F.count("*")).cast("long").alias("duplicates"),
        (F.lit(100.0) * (F.sum("c") - F.count("*")) / F.sum("c")).alias("duplicate_pct"))


def _min_max(df: DataFrame, col: str) -> tuple[float, float]:
    row = df.agg(F.min(F.col(col).cast("double")).alias("lo"), F.max(F.col(col).cast("double")).alias("hi")).first()
    return row["lo"], row["hi"]


def equal_width_histogram(df: DataFrame, col: str, n_bins: int) -> DataFrame:
    """``n_bins`` equal-width bins over [min, max] with numpy's rules (as matplotlib's ``hist``).

    Index = floor((x - min) / (max - min) * n), the max value falls in the last
    bin, then one correction step against the ``linspace`` edges so a value on
    an edge lands where numpy puts it.  Every bin is reported (0 counts too).
    The two bounds are a one-row aggregate read on the driver; the counting is
    a partial aggregation over the data.
    """
    lo, hi = _min_max(df, col)
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, n long")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / n_bins
    edge = lambda i: F.when(i >= n_bins, F.lit(hi)).otherwise(i * F.lit(step) + F.lit(lo))
    x = F.col(col).cast("double")
    first = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(n_bins)))
    first = F.when(first >= n_bins, n_bins - 1).otherwise(first)
    keyed = df.where(x.isNotNull()).select(x.alias("_x"), first.alias("_i"))
    xi, i = F.col("_x"), F.col("_i")
    fixed = (F.when(xi < edge(i), i - 1)
             .when((xi >= edge(i + 1)) & (i != n_bins - 1), i + 1)
             .otherwise(i)).cast("int")
    counts = keyed.groupBy(fixed.alias("bin")).agg(F.count("*").alias("n"))
    bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    bins = bins.select("bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"))
    return (bins.join(F.broadcast(counts), "bin", "left")
            .select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def boxplot_summary(df: DataFrame, col: str, whisker: float = 1.5) -> DataFrame:
    """Five-number summary with 1.5 IQR whiskers and the outlier count (matplotlib rules)."""
    x = F.col(col).cast("double")
    q = ranks.order_statistics(df, {"q1": (col, 0.25), "median": (col, 0.5), "q3": (col, 0.75)}).first()
    if q["q1"] is None:
        return df.sparkSession.createDataFrame(
            [], "q1 double, median double, q3 double, iqr double, whisker_lo double, whisker_hi double, "
                "n_outliers long, n long")
    iqr = q["q3"] - q["q1"]
    lo_fence, hi_fence = q["q1"] - whisker * iqr, q["q3"] + whisker * iqr
    return df.agg(
        F.lit(q["q1"]).alias("q1"), F.lit(q["median"]).alias("median"), F.lit(q["q3"]).alias("q3"),
        F.lit(iqr).alias("iqr"),
        F.min(F.when(x >= lo_fence, x)).alias("whisker_lo"),
        F.max(F.when(x <= hi_fence, x)).alias("whisker_hi"),
        F.count_if((x < lo_fence) | (x > hi_fence)).alias("n_outliers"),
        F.count(x).alias("n"))


def data_summary(profiled: DataFrame, text_col: str) -> DataFrame:
    """One-row corpus summary (counts, length and word statistics)."""
    return profiled.agg(
        F.count("*").alias("total_comments"), F.countDistinct(text_digest(text_col)).alias("unique_comments"),
        F.min("length").alias("min_length"), F.max("length").alias("max_length"),
        F.avg("length").alias("mean_length"), F.percentile("length", 0.5).alias("median_length"),
        F.min("word_count").alias("min_words"), F.max("word_count").alias("max_words"),
        F.avg("word_count").alias("mean_words"), F.percentile("word_count", 0.5).alias("median_words"))
