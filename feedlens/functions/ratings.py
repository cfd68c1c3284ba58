"""Threshold rating ladders and the overall verdict, kept as data.

A ladder is an ordered list of ``(label, condition)`` rungs compared top-down
(first match wins) plus a fallback label.  Conditions are SQL boolean
expressions over the placeholders ``{x}`` and ``{y}``; the same text builds the
Spark column (``F.expr``) and the DuckDB oracle, so there is one definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXCELLENT, GOOD, FAIR, POOR = "EXCELLENT", "GOOD", "FAIR", "POOR"

# The rating ladders of the three evaluation stages.
LADDERS: dict[str, tuple[list[tuple[str, str]], str]] = {
    "extraction_success_rate": ([(EXCELLENT, "{x} > 0.95"), (GOOD, "{x} > 0.90"), (FAIR, "{x} > 0.80")], POOR),
    "mean_aspect_confidence": ([(EXCELLENT, "{x} > 0.85"), (GOOD, "{x} > 0.75"), (FAIR, "{x} > 0.65")], POOR),
    "mean_aspects_per_comment": ([
        (EXCELLENT, "{x} >= 3 AND {x} <= 5"),
        (GOOD, "({x} >= 2.5 AND {x} < 3) OR ({x} > 5 AND {x} <= 6)"),
        (FAIR, "{x} < 2.5 OR {x} > 6")], POOR),
    # x = negative %, y = positive %; POOR is tested before FAIR.
    "sentiment_balance": ([
        (EXCELLENT, "{x} >= 45 AND {x} <= 65 AND {y} >= 25 AND {y} <= 40"),
        (GOOD, "{x} >= 40 AND {x} <= 70 AND {y} >= 20 AND {y} <= 45"),
        (POOR, "{x} < 40 OR {y} < 15")], FAIR),
    "duplicate_pct": ([(EXCELLENT, "{x} > 40"), (GOOD, "{x} > 30"), (FAIR, "{x} > 20")], POOR),
    "cost_per_comment": ([(EXCELLENT, "{x} < 0.005"), (GOOD, "{x} < 0.01"), (FAIR, "{x} < 0.02")], POOR),
    "silhouette": ([(EXCELLENT, "{x} > 0.5"), (GOOD, "{x} > 0.3"), (FAIR, "{x} > 0.1"), (FAIR, "{x} > 0.0")], POOR),
    "davies_bouldin": ([(EXCELLENT, "{x} < 1.0"), (GOOD, "{x} < 2.0"), (FAIR, "{x} < 3.0")], POOR),
    "size_ratio": ([(EXCELLENT, "{x} < 5"), (GOOD, "{x} < 10"), (FAIR, "{x} < 20")], POOR),
    "mean_dominant_sentiment_pct": ([(EXCELLENT, "{x} > 80"), (GOOD, "{x} > 70"), (FAIR, "{x} > 60")], POOR),
    "cluster_coverage_pct": ([(EXCELLENT, "{x} >= 100"), (GOOD, "{x} > 95"), (FAIR, "{x} > 90")], POOR),
    "interpretability_rate": ([(EXCELLENT, "{x} > 0.95"), (GOOD, "{x} > 0.85"), (FAIR, "{x} > 0.70")], POOR),
    "mean_mapping_confidence": ([(EXCELLENT, "{x} > 0.85"), (GOOD, "{x} > 0.75"), (FAIR, "{x} > 0.65")], POOR),
    "high_confidence_share_pct": ([(EXCELLENT, "{x} >= 90"), (GOOD, "{x} >= 70"), (FAIR, "{x} >= 50")], POOR),
    # x = coverage % of the catalogue, y = categories used (of 5)
    "theme_coverage": ([
        (EXCELLENT, "{x} >= 80 AND {y} = 5"),
        (GOOD, "{x} >= 60 AND {y} >= 4"),
        (FAIR, "{x} >= 40 AND {y} >= 3")], POOR),
    # x = largest category %, y = smallest category %
    "category_balance": ([
        (EXCELLENT, "{x} < 50 AND {y} > 10"),
        (GOOD, "{x} < 60 AND {y} > 5"),
        (FAIR, "{x} < 70 AND {y} > 2")], POOR),
    "consistency_score": ([(EXCELLENT, "{x} > 0.7"), (GOOD, "{x} > 0.5"), (FAIR, "{x} > 0.3")], POOR),
    "cost_per_cluster": ([(EXCELLENT, "{x} < 0.05"), (GOOD, "{x} < 0.10"), (FAIR, "{x} < 0.20")], POOR),
    # coherence label of a clustering from its silhouette
    "coherence_label": ([("High", "{x} > 0.3"), ("Medium", "{x} > 0.1")], "Low"),
}

# Which sub-ratings feed each stage verdict and how they are counted.
STAGE_METRICS = {
    "extraction": ("extraction_success_rate", "mean_aspect_confidence", "mean_aspects_per_comment",
                   "sentiment_balance"),
    "clustering": ("silhouette", "davies_bouldin", "size_ratio", "mean_dominant_sentiment_pct",
                   "cluster_coverage_pct", "interpretability_rate"),
    "mapping": ("mean_mapping_confidence", "high_confidence_share_pct", "theme_coverage", "category_balance",
                "consistency_score", "business_logic", "cost_per_cluster"),
}
VERDICT_RULES = {
    # stage -> [(label, condition over e = #EXCELLENT, g = #GOOD)], fallback
    "extraction": ([(EXCELLENT, "{e} >= 3"), (GOOD, "{e} >= 2")], FAIR),
    "clustering": ([(EXCELLENT, "{e} >= 4"), (GOOD, "{e} >= 2 AND {g} >= 2")], FAIR),
    "mapping": ([(EXCELLENT, "{e} >= 6"), (GOOD, "{e} >= 4")], FAIR),
}


def ladder_sql(metric: str, x: str, y: str | None = None) -> str:
    rungs, fallback = LADDERS[metric]
    whens = " ".join(f"WHEN {cond.format(x=x, y=y)} THEN '{label}'" for label, cond in rungs)
    return f"CASE {whens} ELSE '{fallback}' END"


def rate(metric: str, x: str, y: str | None = None) -> Column:
    """Rating label of the value in column ``x`` (and ``y`` for two-input ladders)."""
    q = lambda c: None if c is None else f"`{c}`"
    return F.expr(ladder_sql(metric, q(x), q(y)))


def verdict_sql(stage: str, e: str, g: str) -> str:
    rules, fallback = VERDICT_RULES[stage]
    whens = " ".join(f"WHEN {cond.format(e=e, g=g)} THEN '{label}'" for label, cond in rules)
    return f"CASE {whens} ELSE '{fallback}' END"


def overall_verdict(ratings: DataFrame, keys: list[str], stage_col: str = "stage",
                    rating_col: str = "rating") -> DataFrame:
    """Count EXCELLENT/GOOD sub-ratings per (keys, stage) and apply the stage's verdict rule."""
    counted = ratings.groupBy(*keys, stage_col).agg(
        F.count_if(F.col(rating_col) == EXCELLENT).alias("n_excellent"),
        F.count_if(F.col(rating_col) == GOOD).alias("n_good"),
        F.count("*").alias("n_ratings"),
    )
    verdict = None
    for stage in VERDICT_RULES:
        expr = F.expr(verdict_sql(stage, "n_excellent", "n_good"))
        verdict = (F.when(F.col(stage_col) == stage, expr) if verdict is None
                   else verdict.when(F.col(stage_col) == stage, expr))
    return counted.withColumn("verdict", verdict)
