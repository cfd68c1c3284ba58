"""Prompt rendering as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default templates; users pass their own.  Placeholders are {name} tokens
# replaced literally (no format-string parsing).
EXTRACTION_TEMPLATE = (
    "Extract the specific aspects discussed in the customer comment below. For each aspect give the "
    "aspect name, its sentiment (positive, negative or neutral), a short evidence quote and a "
    "confidence between 0 and 1.\n"
    'Answer with JSON only: {"aspects": [{"aspect": "...", "sentiment": "...", "evidence": "...", '
    '"confidence": 0.0}]}\n\n'
    "COMMENT:\n{comment}\n"
)
INSIGHT_TEMPLATE = (
    "Summarise this cluster of customer-feedback aspects.\n\nASPECTS:\n{aspects}\n\n"
    'Answer with JSON only: {"cluster_name": "...", "summary": "...", "primary_sentiment": '
    '"positive|negative|mixed", "key_themes": ["..."], "business_impact": "..."}\n'
)
MERGE_TEMPLATE = (
    "Summarise these partial summaries of one cluster of customer-feedback aspects.\n\nPARTS:\n{aspects}\n\n"
    'Answer with JSON only: {"cluster_name": "...", "summary": "...", "primary_sentiment": '
    '"positive|negative|mixed", "key_themes": ["..."], "business_impact": "..."}\n'
)
VALIDATION_TEMPLATE = (
    "Cluster {cluster_id}: {cluster_name}\nSummary: {summary}\nSentiment: {primary_sentiment}\n"
    "Key themes: {key_themes}\n\nSuggested themes:\n{suggestions}\n\n{theme_block}\n"
    'Answer with JSON only: {"recommended_theme": "...", "category": "...", "confidence": 0.0, '
    '"rationale": "..."}\n'
)
FULL_MAPPING_TEMPLATE = (
    "Cluster {cluster_id}: {cluster_name}\nSummary: {summary}\nSentiment: {primary_sentiment}\n"
    "Key Themes: {key_themes}\n\n{theme_block}\n"
    'Answer with JSON only: {"theme": "...", "category": "...", "confidence": 0.0, '
    '"reasoning": "..."}\n'
)

# Line formats and texts that must equal the reference's.
ASPECT_LINE = "- %s (%s, confidence: %.2f)"
SUGGESTION_LINE = "  %d. %s (%s): %.3f"
THEME_BLOCK_HEADER = "AVAILABLE THEMES AND CATEGORIES:\n"
FULL_MAPPING_BLOCK_HEADER = "AVAILABLE THEMES:\n"
SEMANTIC_REASONING = "Semantic similarity between cluster '%s' and theme '%s'"
PARSE_ERROR = "JSON parsing failed"
MISSING_KEY = "answer without theme, category, confidence or reasoning"


def render(template: str, **fields) -> Column:
    """Replace each ``{name}`` in ``template`` with the given column (or literal)."""
    out = F.lit(template)
    for name, value in fields.items():
        col = value if isinstance(value, Column) else F.lit(str(value))
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(col.cast("string"), F.lit("")))
    return out


def aspect_line(aspect, sentiment, confidence) -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.format_string(ASPECT_LINE, c(aspect), c(sentiment), c(confidence))


def insight_text(name, summary) -> Column:
    """Text that is embedded for an insight: ``name. summary``."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat_ws(". ", c(name), c(summary))


def fmt_sql(expr: str, places: int) -> str:
    """DuckDB text that formats a double the way Spark's format_string does
    (half-up on the shortest decimal representation)."""
    return (f"printf('%.{places}f', round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {places}))")
