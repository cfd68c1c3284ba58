"""Model-response handling: markdown fence stripping and strict JSON parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions.text import strip_ws

FENCE = "```"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


_WS = r"[\s\x1c-\x1f]"
# Variant A as one pattern: strip, optional leading ```json / ```, optional trailing ```, strip.
FENCE_A = r"(?sU)^" + _WS + r"*(?:```json|```)?" + _WS + r"*(.*?)" + _WS + r"*(?:```)?" + _WS + r"*$"
# Variant B: text between the first fence and the next one (or the end), minus a leading 'json'.
FENCE_B_START = r"(?sU)^" + _WS + r"*```"
FENCE_B = r"(?sU)^" + _WS + r"*```(?:json)?(.*?)(?:```|\z)"


def strip_fence_a(col) -> Column:
    """Variant A: strip; drop a leading ```json or ``` and a trailing ```; strip again."""
    return F.regexp_extract(_c(col), FENCE_A, 1)


def strip_fence_b(col) -> Column:
    """Variant B: strip; when fenced keep the text between the first two fences, drop a leading 'json'."""
    c = _c(col)
    return F.when(c.rlike(FENCE_B_START), F.regexp_extract(c, FENCE_B, 1)).otherwise(strip_ws(c))


def strict_from_json(col, schema: T.StructType) -> Column:
    """Parse exactly one JSON object into ``schema``; anything else is null.

    ``from_json`` alone accepts trailing text after the object.  Wrapping the
    text in ``[...]`` and requiring exactly one non-null element rejects
    trailing text, several values and top-level arrays or scalars.  (Column
    form; ``parse_strict`` is the DataFrame form that parses once per row.)
    """
    arr = F.from_json(F.concat(F.lit("["), _c(col), F.lit("]")), T.ArrayType(schema))
    first = F.element_at(arr, 1)
    ok = (F.size(arr) == 1) & first.isNotNull() & _c(col).rlike(r"(?sU)^" + _WS + r"*\{")
    return F.when(ok, first)


def parse_strict(df, col: str, schema: T.StructType, out: str):
    """Add ``out`` = the single JSON object in ``col`` parsed into ``schema`` (null otherwise).

    The parsed array is its own projection, so the JSON text is parsed once
    per row rather than once per reference.
    """
    wrapped = df.withColumn("_arr", F.from_json(F.concat(F.lit("["), F.col(col), F.lit("]")), T.ArrayType(schema)))
    first = F.element_at("_arr", 1)
    ok = (F.size("_arr") == 1) & first.isNotNull() & F.col(col).rlike(r"(?sU)^" + _WS + r"*\{")
    return wrapped.withColumn(out, F.when(ok, first)).drop("_arr")


# Response schemas: numbers are read as text and converted with try_cast, so a
# quoted number ("0.9") and a bare number (0.9) both survive.
ASPECT_FIELDS = T.StructType([
    T.StructField("aspect", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("evidence", T.StringType()),
    T.StructField("confidence", T.StringType()),
])
EXTRACTION_SCHEMA = T.StructType([T.StructField("aspects", T.ArrayType(ASPECT_FIELDS))])
INSIGHT_SCHEMA = T.StructType([
    T.StructField("cluster_name", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("primary_sentiment", T.StringType()),
    T.StructField("key_themes", T.ArrayType(T.StringType())),
    T.StructField("business_impact", T.StringType()),
])
VALIDATION_SCHEMA = T.StructType([
    T.StructField("recommended_theme", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("rationale", T.StringType()),
])
FULL_MAPPING_SCHEMA = T.StructType([
    T.StructField("theme", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("confidence", T.StringType()),
    T.StructField("reasoning", T.StringType()),
])


def to_double(col) -> Column:
    """``float(x)`` that yields null instead of failing."""
    return _c(col).try_cast("double")
