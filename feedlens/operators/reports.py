"""One-row evaluation reports (A32): metric tables assembled into a nested document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import ratings
from feedlens.operators import quality
from feedlens.session import materialize


def _section(df: DataFrame, name: str) -> DataFrame:
    """A one-row metric frame as ``(name, json)``."""
    return df.select(F.lit(name).alias("section"), F.to_json(F.struct(*df.columns)).alias("json"))


def assemble(*sections: DataFrame) -> DataFrame:
    """Union ``(name, json)`` sections and fold them into one JSON document (no joins).

    Sections keep their given order; the fold is a global aggregate over as
    many rows as there are sections.
    """
    tagged = [s.withColumn("_i", F.lit(i)) for i, s in enumerate(sections)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("_i", F.concat(F.lit('"'), F.col("section"),
                                                                            F.lit('":'), F.col("json")).alias("p")))),
                        lambda x: x["p"])
    return u.agg(F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("report"))


def verdict(stage: str, **rated: DataFrame) -> DataFrame:
    """Stage verdict from the sections' ratings: ``section`` -> a one-row frame with its ``rating`` columns' frame."""
    from feedlens.operators import ranks
    one = ranks.one_row([f.toDF(f"_r{i}") for i, f in enumerate(rated.values())])
    entries = F.array(*[F.struct(F.lit(stage).alias("stage"), F.col(f"_r{i}").alias("rating")) for i in range(len(rated))])
    found = ratings.overall_verdict(one.select(F.explode(entries).alias("e")).select("e.*"), [])
    return found.select("n_excellent", "n_good", "n_ratings", "verdict")


def efficiency(usage: DataFrame, n_comments: int | None = None, n_aspects: int | None = None, n_clusters: int | None = None) -> DataFrame:
    """Cost section of a stage from its token usage (``input_tokens``, ``output_tokens`` per request), with the cost rating."""
    from feedlens.operators import ledger
    total = ledger.cost_summary(usage, counts="n_requests")
    given = {"n_comments": n_comments, "n_aspects": n_aspects, "n_clusters": n_clusters}
    out = ledger.cost_efficiency(total.withColumns({c: F.lit(v).cast("long") for c, v in given.items()}))
    return out.withColumn("rating", ratings.rate("cost_per_cluster", "cost_per_cluster"))


def clustering_report(members: DataFrame, points: DataFrame, insights: DataFrame, usage: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """Statistics, balance, sentiment coherence, silhouette, Davies-Bouldin, coverage, interpretability, cost and verdict.

    ``insights``: one row per cluster with ``status``; ``usage``: tokens of the requests that made them.
    """
    from feedlens.operators.insights import insight_success
    sizes = quality.cluster_sizes(members)
    stats = materialize(quality.size_stats(sizes), "report-stats")
    bal = quality.size_balance(sizes).withColumn("rating", ratings.rate("size_ratio", "range_ratio"))
    coh = quality.sentiment_coherence(members).withColumn(
        "rating", ratings.rate("mean_dominant_sentiment_pct", "mean_dominant_pct"))
    sil = quality.silhouette_exact(points, id_col).withColumn("rating", ratings.rate("silhouette", "silhouette")) \
        .withColumn("coherence", ratings.rate("coherence_label", "silhouette"))
    db = quality.davies_bouldin(points).withColumn("rating", ratings.rate("davies_bouldin", "davies_bouldin"))
    cov = quality.coverage(points).withColumn("rating", ratings.rate("cluster_coverage_pct", "coverage_pct"))
    named = insight_success(insights).withColumn("rating", ratings.rate("interpretability_rate", "success_rate"))
    cost = efficiency(usage, n_clusters=stats.first()["num_clusters"])
    rated = {"size_balance": bal, "sentiment_coherence": coh, "silhouette": sil, "davies_bouldin": db, "coverage": cov,
             "interpretability": named}
    rated = {k: materialize(v, f"report-{k}") for k, v in rated.items()}
    return assemble(_section(stats, "cluster_statistics"), *[_section(v, k) for k, v in rated.items()],
                    _section(cost, "efficiency"),
                    _section(verdict("clustering", **{k: v.select("rating") for k, v in rated.items()}), "overall_assessment"))


def extraction_report(parsed: DataFrame, ex: DataFrame, cost: DataFrame, n_comments_col: str = "status") -> DataFrame:
    """Extraction evaluation: success rate, confidence, aspects per comment, sentiment balance, dedup, cost and verdict."""
    from feedlens.operators import aspects, responses
    parsed = materialize(parsed.select("status", "num_aspects"), "report-parsed")
    ex = materialize(ex.select("aspect", "sentiment", "confidence"), "report-aspects")
    succ = responses.success_counts(parsed).withColumn("rating", ratings.rate("extraction_success_rate", "success_rate"))
    conf = aspects.confidence_stats(ex).withColumn("rating", ratings.rate("mean_aspect_confidence", "mean"))
    apc = aspects.aspects_per_comment(parsed.where(F.col("status") == "success")) \
        .withColumn("rating", ratings.rate("mean_aspects_per_comment", "mean_aspects"))
    bal = ex.agg((F.lit(100.0) * F.count_if(F.col("sentiment") == "negative") / F.count("*")).alias("negative_pct"),
                 (F.lit(100.0) * F.count_if(F.col("sentiment") == "positive") / F.count("*")).alias("positive_pct")) \
        .withColumn("rating", ratings.rate("sentiment_balance", "negative_pct", "positive_pct"))
    dup = aspects.dedup_potential(ex).withColumn("rating", ratings.rate("duplicate_pct", "duplicate_pct"))
    rated = {"success_rate": succ, "confidence_scores": conf, "aspects_per_comment": apc, "sentiment_distribution": bal}
    rated = {k: materialize(v, f"report-{k}") for k, v in rated.items()}
    return assemble(*[_section(v, k) for k, v in rated.items()], _section(dup, "deduplication"), _section(cost, "cost_summary"),
                    _section(verdict("extraction", **{k: v.select("rating") for k, v in rated.items()}), "overall_assessment"))


#: Fixed value: the reference rates the business logic of a mapping by hand.
BUSINESS_LOGIC = ratings.EXCELLENT


def mapping_report(m: DataFrame, themes: DataFrame, insights: DataFrame, usage: DataFrame, n_samples: int = 5) -> DataFrame:
    """Mapping evaluation: confidence, tiers, theme coverage, category balance, consistency, samples, cost and verdict."""
    from feedlens.operators import mapping
    m = materialize(m, "report-mappings")
    conf = mapping.confidence_report(m).withColumn("rating", ratings.rate("mean_mapping_confidence", "mean")) \
        .withColumn("tier_rating", ratings.rate("high_confidence_share_pct", "high_pct"))
    cov = mapping.theme_coverage(m, themes).withColumn(
        "rating", ratings.rate("theme_coverage", "coverage_pct", "categories_used"))
    bal = mapping.category_balance(m).withColumn(
        "rating", ratings.rate("category_balance", "max_category_pct", "min_category_pct"))
    con = mapping.mapping_consistency(m).withColumn("rating", ratings.rate("consistency_score", "consistency_score"))
    cost = efficiency(usage, n_clusters=m.where(F.col("status") == "success").count())
    rated = {"confidence": conf, "theme_coverage": cov, "category_balance": bal, "consistency": con, "cost_efficiency": cost}
    rated = {k: materialize(v, f"report-{k}") for k, v in rated.items()}
    sample = mapping.sample_mappings(m, insights, n_samples).agg(F.sort_array(F.collect_list(F.struct(
        "rank", "cluster_id", "cluster_name", "primary_theme", "primary_category", "primary_confidence"))).alias("mappings"))
    scores = {k: v.select("rating") for k, v in rated.items()}
    scores["tiers"] = rated["confidence"].select("tier_rating")
    scores["business_logic"] = rated["confidence"].select(F.lit(BUSINESS_LOGIC))
    return assemble(*[_section(v, k) for k, v in rated.items()], _section(sample, "sample_mappings"),
                    _section(verdict("mapping", **scores), "overall_assessment"))


def theme_distribution(m: DataFrame) -> DataFrame:
    """Distribution file as rows: (kind, name, n) of the themes and categories in use (K6)."""
    from feedlens.operators import mapping
    t = mapping.theme_usage(m).select(F.lit("themes").alias("kind"), F.col("theme").alias("name"), "n")
    return t.unionByName(mapping.category_usage(m).select(F.lit("categories").alias("kind"), F.col("category").alias("name"), "n"))


def confidence_file(m: DataFrame) -> DataFrame:
    """Confidence file (K6) as rows that each are a line of JSON: the statistics, then each mapping with its tier."""
    from feedlens.operators import mapping
    stats = mapping.confidence_report(m)
    lines = mapping.tier_lists(m).select("tier", F.to_json(F.struct(
        "cluster_id", F.col("primary_theme").alias("theme"), F.col("primary_confidence").alias("confidence"))).alias("json"))
    return stats.select(F.lit("statistics").alias("tier"), F.to_json(F.struct(*stats.columns)).alias("json")).unionByName(lines)
