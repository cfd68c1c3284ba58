"""Insights of clusters whose merge prompts are equal, and of answers that belong to a cluster."""

from pyspark.sql import functions as F

from feedlens.operators import completion, insights


def _members(spark, clusters, n):
    return spark.createDataFrame([(c * 1000 + i, c, f"aspect {i}", "neutral", 0.5) for c in clusters for i in range(n)],
                                 "seq long, cluster_id int, aspect string, sentiment string, confidence double")


def test_equal_prompts_of_several_clusters_keep_their_own_answers(spark):
    good = '```json\n{"cluster_name": "name %d", "summary": "s", "primary_sentiment": "mixed", "key_themes": [], "business_impact": null}\n```'
    # the parts of 1 and 2 fail, so their merge prompts are equal; 3 and 4 have the same members but answers of their own
    answers = spark.createDataFrame([(1, "cut"), (2, "cut"), (3, good % 3), (4, good % 4), (5, None)], "cluster_id int, text string")
    members = _members(spark, [1, 2, 3, 4, 5], 12).withColumn("seq", F.col("seq") % 1000)
    levels = []

    def answer(requests):
        levels.append(requests.count())
        assert len(levels) < 5 and levels[-1] <= levels[0]
        return completion.stored(requests, answers, ["cluster_id"], keep=True)
    found = insights.cluster_insights(members, answer, max_lines=4).collect()
    assert sorted((r["cluster_id"], r["status"], r["cluster_name"]) for r in found) == [
        (1, "error", None), (2, "error", None), (3, "success", "name 3"), (4, "success", "name 4"), (5, "error", None)]
    assert len(levels) == 2


def test_completions_without_the_cluster_are_shared_by_equal_prompts(spark):
    members = _members(spark, [1, 2, 3], 9).withColumn("seq", F.col("seq") % 1000)
    levels = []

    def answer(requests):
        levels.append(requests.count())
        assert len(levels) < 5
        return requests.select("request_id", F.lit("cut").alias("text"), F.lit(1).cast("long").alias("input_tokens"),
                               F.lit(1).cast("long").alias("output_tokens"), F.lit("success").alias("status"),
                               F.lit(None).cast("string").alias("error"))  # one row per request, so equal ids come more than once
    found = insights.cluster_insights(members, answer, max_lines=4).collect()
    assert sorted((r["cluster_id"], r["status"]) for r in found) == [(1, "error"), (2, "error"), (3, "error")]
