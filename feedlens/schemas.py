"""Explicit schemas for every file the pipeline reads or writes (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

COMMENT_CSV = T.StructType([T.StructField("comment", T.StringType())])

SAMPLE_CSV = T.StructType([
    T.StructField("comment", T.StringType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("rough_sentiment", T.StringType()),
    T.StructField("length_bin", T.StringType()),
])

THEMES_FILE = T.StructType([T.StructField("themes", T.ArrayType(T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("themes", T.ArrayType(T.StringType())),
])))])

ASPECT = T.StructType([
    T.StructField("aspect", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("evidence", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])

COST_SUMMARY = T.StructType([
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
    T.StructField("total_tokens", T.LongType()),
    T.StructField("input_cost_usd", T.DoubleType()),
    T.StructField("output_cost_usd", T.DoubleType()),
    T.StructField("total_cost_usd", T.DoubleType()),
    T.StructField("cost_per_token_usd", T.DoubleType()),
])

EXTRACTION_RESULT = T.StructType([
    T.StructField("idx", T.LongType()),
    T.StructField("comment", T.StringType()),
    T.StructField("extraction", T.StructType([T.StructField("aspects", T.ArrayType(ASPECT))])),
    T.StructField("num_aspects", T.LongType()),
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])

EXTRACTION_FILE = T.StructType([
    T.StructField("metadata", T.StructType([
        T.StructField("timestamp", T.StringType()),
        T.StructField("total_comments", T.LongType()),
        T.StructField("successful", T.LongType()),
        T.StructField("failed", T.LongType()),
        T.StructField("total_aspects", T.LongType()),
        T.StructField("avg_aspects_per_comment", T.DoubleType()),
        T.StructField("cost_summary", COST_SUMMARY),
    ])),
    T.StructField("results", T.ArrayType(EXTRACTION_RESULT)),
])

CLUSTER_MEMBER = T.StructType([
    T.StructField("aspect", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])

TOP_MATCH = T.StructType([
    T.StructField("theme", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("method", T.StringType()),
])

MAPPING = T.StructType([
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("primary_theme", T.StringType()),
    T.StructField("primary_category", T.StringType()),
    T.StructField("primary_confidence", T.DoubleType()),
    T.StructField("top_matches", T.ArrayType(TOP_MATCH)),
    T.StructField("reasoning", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("validated", T.BooleanType()),
    T.StructField("error", T.StringType()),
])

MAPPING_FILE = T.StructType([
    T.StructField("metadata", T.StructType([
        T.StructField("timestamp", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("total_clusters", T.LongType()),
        T.StructField("successful", T.LongType()),
    ])),
    T.StructField("mappings", T.MapType(T.StringType(), MAPPING)),
])
