"""Readers and writers as queries: given tables are written in each file format, read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.operators import sampling
from feedlens.plans.corpus import PROFILE_CTE, profiled
from feedlens.plans.fixtures import cte
from feedlens.plans.registry import query, r6, shared_path
from feedlens.plans.responses import parsed, EXPLODE_SQL
from feedlens.operators import responses
from feedlens.sinks import files as sinks
from feedlens.sources import files as sources


@query("comments_csv_roundtrip", """
SELECT length(text) AS length, concat(sha256(text), CASE WHEN n = 0 THEN '' ELSE concat('-', CAST(n AS VARCHAR)) END) AS comment_id
FROM (SELECT text, row_number() OVER (PARTITION BY text) - 1 AS n FROM documents)""")
def q_comments_csv_roundtrip(spark, sf_dir):
    """All comments through the quoted, multi-line CSV format; ids follow from the content."""
    path = shared_path(spark, "comments")
    sinks.write_comments_csv(spark.table("v_comments").select("comment"), path)
    return sources.read_comments_csv(spark, path).select(F.length("comment").cast("long").alias("length"), "comment_id")


@query("insights_file_roundtrip", cte("v_insights") + """
SELECT cluster_id, cluster_name, summary, primary_sentiment, key_themes FROM v_insights""")
def q_insights_file_roundtrip(spark, sf_dir):
    """Insights written as a keyed JSON file and read back."""
    path = shared_path(spark, "insights")
    value = F.struct("cluster_name", "summary", "primary_sentiment", F.array("key_themes").alias("key_themes"))
    sinks.write_json_map(spark.table("v_insights"), "cluster_id", value, path)
    back = sources.read_insights(spark, path, lines=True)
    return back.select("cluster_id", "cluster_name", "summary", "primary_sentiment",
                       F.get("key_themes", F.lit(0)).alias("key_themes"))


@query("clusters_file_roundtrip", cte("v_aspects") + f"""
SELECT cluster_id, aspect, sentiment, {r6("confidence")} AS confidence FROM v_aspects""")
def q_clusters_file_roundtrip(spark, sf_dir):
    """Cluster members written as a keyed JSON file, one entry per member, and read back."""
    path = shared_path(spark, "clusters")
    members = F.array(F.struct("aspect", "sentiment", "confidence"))
    sinks.write_json_map(spark.table("v_aspects"), "cluster_id", members, path)
    return sources.read_clusters(spark, path, lines=True).select("cluster_id", "aspect", "sentiment", "confidence")


@query("clusters_table_roundtrip", cte("v_aspects") + f"""
SELECT cluster_id, aspect, sentiment, {r6("confidence")} AS confidence FROM v_aspects""")
def q_clusters_table_roundtrip(spark, sf_dir):
    """Cluster members as a table partitioned by cluster, without evidence (K5)."""
    path = shared_path(spark, "clusters-table")
    sinks.write_clusters(spark.table("v_aspects"), path)
    return spark.read.parquet(path).select("cluster_id", "aspect", "sentiment", "confidence")


@query("mappings_file_roundtrip", cte("v_mappings") + f"""
SELECT cluster_id, primary_theme, primary_category, {r6("primary_confidence")} AS primary_confidence, status FROM v_mappings""")
def q_mappings_file_roundtrip(spark, sf_dir):
    """Mapping results written as a keyed JSON file and read back."""
    path = shared_path(spark, "mappings")
    value = F.struct("cluster_id", "primary_theme", "primary_category", "primary_confidence", "status")
    sinks.write_json_map(spark.table("v_mappings"), "cluster_id", value, path, field="mappings")
    _, rows = sources.read_mappings(spark, path, lines=True)
    return rows.select("cluster_id", "primary_theme", "primary_category", "primary_confidence", "status")


@query("results_table_roundtrip", EXPLODE_SQL)
def q_results_table_roundtrip(spark, sf_dir):
    """Parsed results written as a table, read back and flattened (K1)."""
    path = shared_path(spark, "results")
    sinks.write_extraction_results(parsed(spark), path)
    return responses.explode_aspects(spark.read.parquet(path), ["comment_id"])


@query("sample_csv_roundtrip", PROFILE_CTE + """
SELECT sha256(comment) AS comment_sha256, CAST(length AS INT) AS length, CAST(word_count AS INT) AS word_count,
       rough_sentiment, length_bin FROM pb ORDER BY comment_id LIMIT 20""")
def q_sample_csv_roundtrip(spark, sf_dir):
    """A 20-row sample with all its columns written as CSV and read back (K8)."""
    path = shared_path(spark, "sample")
    sample = sampling.first_n(profiled(spark), "comment_id", 20)
    sinks.write_sample_csv(sample.select("comment", "length", "word_count", "rough_sentiment", "length_bin"), path)
    back = sources.read_sample_csv(spark, path)
    return back.select(F.sha2("comment", 256).alias("comment_sha256"), "length", "word_count", "rough_sentiment", "length_bin")


# ---------------------------------------------------------------- the published one-document form

@query("insights_document", cte("v_insights") + """
SELECT cluster_id, cluster_name, summary, primary_sentiment, key_themes FROM v_insights""")
def q_insights_document(spark, sf_dir):
    """The published one-document insights file, read in parallel by byte ranges."""
    path = shared_path(spark, "insights-doc")
    value = F.struct("cluster_name", "summary", "primary_sentiment", F.array("key_themes").alias("key_themes"))
    sinks.write_json_document(spark.table("v_insights"), "cluster_id", value, path)
    back = sources.read_insights(spark, path)
    return back.select("cluster_id", "cluster_name", "summary", "primary_sentiment", F.get("key_themes", F.lit(0)).alias("key_themes"))


@query("clusters_document", cte("v_aspects") + f"""
SELECT cluster_id, aspect, sentiment, {r6("confidence")} AS confidence FROM v_aspects""")
def q_clusters_document(spark, sf_dir):
    """The published one-document clusters file, read in parallel by byte ranges."""
    path = shared_path(spark, "clusters-doc")
    sinks.write_json_document(spark.table("v_aspects"), "cluster_id", F.struct("aspect", "sentiment", "confidence"), path, many="seq")
    return sources.read_clusters(spark, path).select("cluster_id", "aspect", "sentiment", "confidence")


@query("mappings_document", cte("v_mappings") + f"""
SELECT cluster_id, primary_theme, primary_category, {r6("primary_confidence")} AS primary_confidence, status FROM v_mappings""")
def q_mappings_document(spark, sf_dir):
    """The published one-document mapping results, read in parallel by byte ranges."""
    path = shared_path(spark, "mappings-doc")
    value = F.struct("cluster_id", "primary_theme", "primary_category", "primary_confidence", "status")
    sinks.write_json_document(spark.table("v_mappings"), "cluster_id", value, path, field="mappings",
                              metadata={"method": "a, {b}", "total_clusters": 2})
    _, rows = sources.read_mappings(spark, path)
    return rows.select("cluster_id", "primary_theme", "primary_category", "primary_confidence", "status")
