"""Readers for the reference's file formats (S1-S6), all with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens import schemas
from feedlens.functions import jsonparse
from feedlens.session import materialize
from feedlens.sources.json_map import keyed_entries, keyed_members


def read_comments_csv(spark: SparkSession, path: str, with_id: bool = True) -> DataFrame:
    """Quoted, multi-line comment CSV with a ``comment`` column.

    Cells are kept as literal text ("NA" stays "NA"); empty cells become null
    and null comments are dropped by callers that need text.  ``comment_id`` is
    the hash of the text and the number of its occurrence, so it does not depend
    on how the file is split or ordered.
    """
    df = (spark.read.option("header", True).option("multiLine", True).option("quote", '"')
          .option("escape", '"').option("nullValue", None).option("emptyValue", None)
          .schema(schemas.COMMENT_CSV).csv(path))
    return with_stable_id(df, "comment") if with_id else df


def with_stable_id(df: DataFrame, text_col: str, out: str = "comment_id") -> DataFrame:
    """``out`` = hex SHA-256 of the text, with ``-n`` for its n-th copy after the first (null: ``null``).

    Copies of one text may be any share of the rows: they are numbered in buckets of a few rows' hash, and
    the buckets' offsets come from a count, so no task holds all of them.
    """
    buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.sha2(F.col(text_col), 256), F.lit("null"))
    rows = materialize(df.withColumn("_key", key).withColumn(
        "_bucket", F.pmod(F.monotonically_increasing_id(), F.lit(buckets))), "stable-id")
    counts = rows.groupBy("_key", "_bucket").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_key", "_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("_key", "_bucket").orderBy(F.lit(0))
    n = F.col("_ahead") + F.row_number().over(inside) - 1
    return rows.join(offsets, ["_key", "_bucket"]).withColumn(
        out, F.when(n == 0, F.col("_key")).otherwise(F.concat("_key", F.lit("-"), n.cast("string")))).drop(
            "_key", "_bucket", "_ahead")


def read_sample_csv(spark: SparkSession, path: str) -> DataFrame:
    """The profiled sample CSV: comment, length, word_count, rough_sentiment, length_bin."""
    return (spark.read.option("header", True).option("multiLine", True).option("quote", '"')
            .option("escape", '"').schema(schemas.SAMPLE_CSV).csv(path))


def read_themes(spark: SparkSession, path: str) -> DataFrame:
    """Two-level theme JSON -> ``(theme_pos, theme, category_pos, category)`` in file order."""
    raw = spark.read.option("multiLine", True).schema(schemas.THEMES_FILE).json(path)
    return flatten_themes(raw)


def flatten_themes(raw: DataFrame) -> DataFrame:
    cats = raw.select(F.posexplode("themes").alias("category_pos", "c"))
    th = cats.select("category_pos", F.col("c.category").alias("category"),
                     F.posexplode("c.themes").alias("pos_in_category", "theme"))
    # global position: categories in order, themes in order inside each category
    sizes = cats.select("category_pos", F.size("c.themes").alias("n"))
    from pyspark.sql import Window
    starts = sizes.withColumn("start", F.sum("n").over(Window.orderBy("category_pos")
                                                       .rowsBetween(Window.unboundedPreceding, -1)))
    return (th.join(F.broadcast(starts.select("category_pos", "start")), "category_pos")
            .select((F.coalesce("start", F.lit(0)) + F.col("pos_in_category")).cast("int").alias("theme_pos"),
                    "theme", "category_pos", "category"))


def read_extraction_results(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Full results file -> (metadata one-row DF, results rows) (S3)."""
    doc = spark.read.option("multiLine", True).schema(schemas.EXTRACTION_FILE).json(path)
    meta = doc.select("metadata.*")
    rows = doc.select(F.explode("results").alias("r")).select("r.*")
    return meta, rows


def explode_results(rows: DataFrame) -> DataFrame:
    """Successful results -> flattened aspects with source comment; evidence '' and confidence 0.5 defaults."""
    ok = rows.where(F.col("status") == "success")
    ex = ok.select("idx", F.col("comment").alias("source_comment"),
                   F.posexplode("extraction.aspects").alias("pos", "a"))
    return ex.select("idx", "pos", F.col("a.aspect").alias("aspect"), F.col("a.sentiment").alias("sentiment"),
                     F.coalesce("a.evidence", F.lit("")).alias("evidence"),
                     F.coalesce(F.col("a.confidence").cast("double"), F.lit(0.5)).alias("confidence"),
                     "source_comment")


def _read_json_map(spark: SparkSession, path: str, value_type: T.DataType, lines: bool, field: str | None = None) -> DataFrame:
    """A JSON object keyed by id: one document, read by byte ranges, or with ``lines`` an object per line."""
    if lines:
        text = spark.read.text(path)
    else:
        text = keyed_entries(spark, path, field).select(F.concat(F.lit("{"), F.col("text"), F.lit("}")).alias("value"))
    return text.select(F.explode(F.from_json("value", T.MapType(T.StringType(), value_type))).alias("key", "v"))


def read_insights(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Insights file (map id -> insight) -> one row per cluster."""
    m = _read_json_map(spark, path, jsonparse.INSIGHT_SCHEMA, lines)
    return m.select(F.col("key").cast("int").alias("cluster_id"), "v.*")


def read_clusters(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Clusters file (map id -> aspects) -> long form ``(cluster_id, pos, aspect, sentiment, confidence)``."""
    if not lines:  # by members: a cluster may be larger than a task can hold
        name = F.get(F.from_json(F.concat(F.lit('["'), F.col("key"), F.lit('"]')), "array<string>"), F.lit(0))
        return keyed_members(spark, path).select(
            name.cast("int").alias("cluster_id"), F.col("pos").cast("int").alias("pos"),
            F.from_json("text", schemas.CLUSTER_MEMBER).alias("a")).select("cluster_id", "pos", "a.*")
    m = _read_json_map(spark, path, T.ArrayType(schemas.CLUSTER_MEMBER), lines)
    ex = m.select(F.col("key").cast("int").alias("cluster_id"), F.posexplode("v").alias("pos", "a"))
    return ex.select("cluster_id", "pos", "a.*")


def read_mappings(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Mapping results file -> (metadata one-row DF, one row per cluster mapping)."""
    if lines:
        doc = spark.read.schema(schemas.MAPPING_FILE).json(path)
        return (doc.where("metadata is not null").select("metadata.*"),
                doc.select(F.explode("mappings").alias("key", "m")).select("m.*"))
    kinds = {f.name: f.dataType for f in schemas.MAPPING_FILE}
    rows = _read_json_map(spark, path, kinds["mappings"].valueType, False, "mappings").select("v.*")
    meta = keyed_entries(spark, path, "metadata").groupBy("file").agg(F.concat(
        F.lit("{"), F.array_join(F.array_sort(F.collect_list("text")), ","), F.lit("}")).alias("doc"))  # a few fields of one document
    return meta.select(F.from_json("doc", kinds["metadata"]).alias("m")).select("m.*"), rows


def read_success_jsonl(spark: SparkSession, path: str, keys: list[tuple[str, str]]) -> DataFrame:
    """JSON Lines written by ``write_success_jsonl``; rows come back as successes with ``parsed``."""
    schema = T.StructType([T.StructField(k, T.StringType() if t == "string" else T.LongType()) for k, t in keys] +
                          [T.StructField("aspects", T.ArrayType(jsonparse.ASPECT_FIELDS))])
    df = spark.read.schema(schema).json(path)
    return (df.withColumn("parsed", F.struct(F.col("aspects").alias("aspects")))
            .withColumn("status", F.lit("success")).drop("aspects"))
