"""Model responses -> typed rows (P7-P10, P20, S3, A4): strict parse, error rows, explode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions import jsonparse, text
from feedlens.functions.prompts import PARSE_ERROR


def parse_responses(df: DataFrame, text_col: str = "response_text", schema: T.StructType = jsonparse.EXTRACTION_SCHEMA,
                    fence: str = "a", out: str = "parsed") -> DataFrame:
    """Add ``out`` (struct or null), ``status`` ('success'/'error') and ``error``.

    A row whose text does not hold exactly one JSON object becomes an error
    row; the job never fails on bad model output.
    """
    strip = jsonparse.strip_fence_a if fence == "a" else jsonparse.strip_fence_b
    clean = df.withColumn("_clean", strip(text_col))
    parsed = jsonparse.parse_strict(clean, "_clean", schema, out).drop("_clean")
    return (parsed
            .withColumn("status", F.when(F.col(out).isNull(), "error").otherwise("success"))
            .withColumn("error", F.when(F.col(out).isNull(), F.lit(PARSE_ERROR))))


def with_aspect_count(df: DataFrame, parsed: str = "parsed") -> DataFrame:
    """``num_aspects``: number of aspects, 0 for ``{}`` or a missing list (successes only)."""
    arr = F.col(f"{parsed}.aspects")
    # size(NULL) is -1 when ANSI mode is off: test for null explicitly
    n = F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr))
    return df.withColumn("num_aspects", F.when(F.col("status") == "success", n))


def explode_aspects(df: DataFrame, keys: list[str], parsed: str = "parsed",
                    default_evidence: str = "", default_confidence: float = 0.5) -> DataFrame:
    """Successful rows -> one row per aspect with position; evidence/confidence defaults applied."""
    # error rows carry a null struct and explode to nothing: no filter needed (a
    # status filter would be pushed below the parse and repeat it).
    ex = df.select(*keys, F.posexplode(F.col(f"{parsed}.aspects")).alias("pos", "a"))
    return ex.select(
        *keys, "pos",
        F.col("a.aspect").alias("aspect"),
        F.col("a.sentiment").alias("sentiment"),
        F.coalesce(F.col("a.evidence"), F.lit(default_evidence)).alias("evidence"),
        F.coalesce(jsonparse.to_double("a.confidence"), F.lit(default_confidence)).alias("confidence"))


def failed_rows(df: DataFrame, id_col: str, comment_col: str, chars: int = 200) -> DataFrame:
    """Error rows for the failure file: id, first ``chars`` characters of the comment, error."""
    return (df.where(F.col("status") == "error")
            .select(id_col, text.prefix(comment_col, chars).alias("comment"), F.coalesce("error", F.lit("unknown"))
                    .alias("error")))


def success_counts(df: DataFrame) -> DataFrame:
    """total / successful / failed / success_rate over response rows (A4)."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") != "success").alias("failed"),
        F.try_divide(F.count_if(F.col("status") == "success"), F.count("*")).alias("success_rate"))
