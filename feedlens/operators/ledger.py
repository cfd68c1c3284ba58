"""Batches, cost and budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import cost
from feedlens.operators.ordered import dense_index, running_sum


def assign_batches(df: DataFrame, order: Sequence[str], batch_size: int = 500) -> DataFrame:
    """``batch_no`` (0-based) and ``idx_in_batch`` (1-based, restarts each batch) in ``order``."""
    idx = dense_index(df, order, "_row_idx")
    return (idx.withColumn("batch_no", F.floor(F.col("_row_idx") / batch_size).cast("long"))
            .withColumn("idx_in_batch", (F.pmod(F.col("_row_idx"), F.lit(batch_size)) + 1).cast("long"))
            .drop("_row_idx"))


def cost_summary(df: DataFrame, input_col: str = "input_tokens", output_col: str = "output_tokens",
                 keys: Sequence[str] = (), counts: str | None = None) -> DataFrame:
    """Token totals and USD cost, rounded to 4 places (8 per token); ``counts`` names a column with the number of rows."""
    cols = [F.sum(input_col).cast("long").alias("input_tokens"), F.sum(output_col).cast("long").alias("output_tokens")]
    if counts:
        cols.append(F.count("*").alias(counts))
    agg = df.groupBy(*keys).agg(*cols) if keys else df.agg(*cols)
    return priced(agg)


def priced(agg: DataFrame) -> DataFrame:
    inc = cost.input_cost(F.col("input_tokens"))
    outc = cost.output_cost(F.col("output_tokens"))
    total_tokens = F.col("input_tokens") + F.col("output_tokens")
    return (agg.withColumn("total_tokens", total_tokens)
            .withColumn("input_cost_usd", F.round(inc, 4))
            .withColumn("output_cost_usd", F.round(outc, 4))
            .withColumn("total_cost_usd", F.round(inc + outc, 4))
            .withColumn("cost_per_token_usd",
                        F.when(total_tokens > 0, F.round((inc + outc) / total_tokens, 8)).otherwise(F.lit(0.0))))


def budget_cutoff(usage: DataFrame, limit_usd: float, batch_col: str = "batch_no") -> DataFrame:
    """Per batch: tokens, cumulative cost, and ``run`` = whether the budgeted loop would process it.

    Batches run in order until the cumulative (rounded) cost exceeds the limit;
    the batch that crosses the limit is still run.  Aggregates to batches first,
    then a distributed running sum over the batch table.
    """
    per_batch = usage.groupBy(batch_col).agg(F.count("*").alias("n_requests"),
                                            F.sum("input_tokens").cast("long").alias("input_tokens"),
                                            F.sum("output_tokens").cast("long").alias("output_tokens"))
    cum = running_sum(per_batch, [batch_col], ["input_tokens", "output_tokens"], suffix="_cum")
    spent = F.round(cost.request_cost(F.col("input_tokens_cum"), F.col("output_tokens_cum")), 4)
    before = F.round(cost.request_cost(F.col("input_tokens_cum") - F.col("input_tokens"),
                                       F.col("output_tokens_cum") - F.col("output_tokens")), 4)
    return cum.select(batch_col, "n_requests", "input_tokens", "output_tokens",
                      spent.alias("cumulative_cost_usd"),
                      (before <= F.lit(limit_usd)).alias("run"))


def cost_ledger(runs: DataFrame, order: Sequence[str], budget_usd: float = cost.BUDGET_USD) -> DataFrame:
    """Running ``total_spent`` and ``budget_remaining`` over a table of runs (each with ``cost``)."""
    cum = running_sum(runs, order, ["cost"], suffix="_total")
    return (cum.withColumnRenamed("cost_total", "total_spent")
            .withColumn("budget_remaining", F.lit(budget_usd) - F.col("total_spent"))
            .withColumn("over_budget", F.col("budget_remaining") < 0))


def append_run(runs: DataFrame, path: str) -> None:
    """Append runs to the ledger table (append-only parquet)."""
    runs.write.mode("append").parquet(path)


def cost_efficiency(df: DataFrame, budget_usd: float = cost.BUDGET_USD) -> DataFrame:
    """Cost per comment / aspect / cluster and budget use, from a one-row frame of totals
    (``total_cost_usd, n_comments, n_aspects, n_clusters``)."""
    total = F.col("total_cost_usd")
    return df.select(
        total.alias("total_cost_usd"),
        F.try_divide(total, F.col("n_comments")).alias("cost_per_comment"),
        F.try_divide(total, F.col("n_aspects")).alias("cost_per_aspect"),
        F.try_divide(total, F.col("n_clusters")).alias("cost_per_cluster"),
        (total / F.lit(budget_usd) * 100.0).alias("budget_used_pct"),
        (F.lit(budget_usd) - total).alias("budget_remaining"))
