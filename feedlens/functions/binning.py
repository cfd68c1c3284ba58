"""Right-closed binning (``pd.cut`` semantics) as a ``CASE WHEN`` chain."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = math.inf

# The three bin layouts used by the exploration notebooks.
LENGTH_BINS = ((0, 50, 200, 500, INF), ("Very Short (<50)", "Short (50-200)", "Medium (200-500)", "Long (>500)"))
LENGTH_BINS_NB = ((0, 5, 200, 500, INF), ("Very Short (<50)", "Short (50-200)", "Medium (200-500)", "Long (>500)"))
SAMPLE_BINS = ((0, 50, 200, INF), ("short", "medium", "long"))


def bin_column(col, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ``(edges[i], edges[i+1]]`` containing the value; null outside."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(edges) == len(labels) + 1")
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = c > F.lit(lo)
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def bin_ordinal(col, edges: Sequence[float]) -> Column:
    """0-based interval index for ordering bins (null outside the edges)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = c > F.lit(lo)
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(hi))
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return expr


def bin_sql(expr: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    """The same chain as ANSI SQL text (used by oracles and docs)."""
    parts = []
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = f"{expr} > {lo}" + ("" if math.isinf(hi) else f" AND {expr} <= {hi}")
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


def bin_ordinal_sql(expr: str, edges: Sequence[float]) -> str:
    parts = []
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = f"{expr} > {lo}" + ("" if math.isinf(hi) else f" AND {expr} <= {hi}")
        parts.append(f"WHEN {cond} THEN {i}")
    return "CASE " + " ".join(parts) + " END"
