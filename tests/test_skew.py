"""Hot keys: one cluster / key holding a third of all rows must not become one unbounded group."""

from pyspark.sql import functions as F

from feedlens.operators import aspects, insights, quality


def _skewed(spark, n=3000):
    # cluster 0 holds a third of all rows, the rest spread over 20 clusters
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 20 + 1).cast("int").alias("cluster_id"),
        F.concat(F.lit("aspect "), (F.col("id") % 50).cast("string")).alias("aspect"),
        F.when(F.col("id") % 4 == 0, "negative").otherwise("positive").alias("sentiment"),
        (F.col("id") % 100 / 100.0).alias("confidence"))


def test_hot_cluster_prompts_are_chunked_and_complete(spark):
    df = _skewed(spark)
    p = insights.cluster_prompts(df, max_lines=100)
    rows = p.select("cluster_id", "chunk", "n_lines").collect()
    hot = [r for r in rows if r["cluster_id"] == 0]
    assert len(hot) == 10                                   # ceil(1000 / 100) chunks for the hot cluster
    assert max(r["n_lines"] for r in rows) <= 160           # hash chunks stay near the target size
    assert sum(r["n_lines"] for r in rows) == 3000          # every aspect is in exactly one prompt


def test_hot_key_dedup_and_cluster_stats(spark):
    df = _skewed(spark).withColumn("aspect", F.when(F.col("cluster_id") == 0, F.lit("hot")).otherwise(F.col("aspect")))
    best = {r["dedup_key"]: r["seq"] for r in aspects.dedup_keep_best(df).collect()}
    # highest confidence in the hot key is 0.99 (ids % 100 == 99 and % 3 == 0): the first such id is 99
    assert best["hot"] == 99
    sizes = {r["cluster_id"]: r["size"] for r in quality.cluster_sizes(df).collect()}
    assert sizes[0] == 1000 and sum(sizes.values()) == 3000
    coh = quality.sentiment_coherence(df).first()
    assert coh["total_clusters"] == 21


def test_dedup_plan_reduces_before_the_shuffle(spark):
    df = _skewed(spark)
    plan = aspects.dedup_keep_best(df)._jdf.queryExecution().executedPlan().toString()
    # partial aggregation runs before the exchange, so a hot key is combined map-side
    assert plan.index("partial_max_by") > plan.index("Exchange")  # tree text: child (partial) printed below
