"""Token usage -> USD."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Model prices per token and the default budget (USD).
INPUT_USD_PER_TOKEN = 0.80 / 1_000_000
OUTPUT_USD_PER_TOKEN = 4.0 / 1_000_000
BUDGET_USD = 20.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def input_cost(tokens) -> Column:
    return _c(tokens) * F.lit(INPUT_USD_PER_TOKEN)


def output_cost(tokens) -> Column:
    return _c(tokens) * F.lit(OUTPUT_USD_PER_TOKEN)


def request_cost(input_tokens, output_tokens) -> Column:
    """Unrounded USD cost of one request (or of token totals)."""
    return input_cost(input_tokens) + output_cost(output_tokens)
