"""Cosine scoring of items against a catalogue, block by block.

Items and themes are packed in blocks; each pair of an item block and a theme block is one task that scores them with
a matrix product and keeps the ``k`` best themes of each item.  The best of all theme blocks are then merged per item,
so a row never holds the catalogue and nothing of it reaches the driver: it may have millions of themes.

Similarities that decide the order are computed a second time, one pair at a time, so that equal vectors tie exactly
wherever their blocks lie; ties go by catalogue position.  A vector of norm 0 has similarity 0 with everything.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import vectors
from feedlens.operators import blocks as B
from feedlens.session import materialize

THEME_BYTES = 16 << 20   # of one theme block
CLOSE = 1e-9             # similarities that differ by less are compared exactly

_MATCH = "struct<neg: double, theme_pos: int, theme: string, category: string, sim: double>"
_OUT = f"id bigint, matches array<{_MATCH}>"
_OUT_ARROW = pa.schema([("id", pa.int64()), ("matches", pa.list_(pa.struct([
    ("neg", pa.float64()), ("theme_pos", pa.int32()), ("theme", pa.string()), ("category", pa.string()), ("sim", pa.float64())])))])


def theme_blocks(themes: DataFrame, vec_col: str = "v", block_bytes: int = THEME_BYTES) -> tuple[DataFrame, int]:
    """((tb, n, pos, theme, category, x), number of blocks): the catalogue in blocks of about ``block_bytes`` of vectors."""
    rows = themes.where(F.col(vec_col).isNotNull()).select(
        F.col("theme_pos").cast("int").alias("pos"), F.col("theme").cast("string").alias("theme"),
        F.col("category").cast("string").alias("category"), vectors.as_double(vec_col).alias("v"))
    size = rows.agg(F.sum(F.size("v") * 8)).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    keyed = rows.withColumn("tb", F.pmod(F.xxhash64("pos", "theme"), F.lit(n)))

    def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x = table.column("v").combine_chunks().flatten().to_numpy().astype(np.float64)
        cols = {c: [table.column(c).to_pylist()] for c in ("pos", "theme", "category")}
        return pa.table({"tb": [key[0].as_py()], "n": [len(table)], "pos": pa.array(cols["pos"], pa.list_(pa.int32())),
                         "theme": pa.array(cols["theme"], pa.list_(pa.string())),
                         "category": pa.array(cols["category"], pa.list_(pa.string())), "x": [x.tobytes()]})
    packed = keyed.groupBy("tb").applyInArrow(
        one, "tb bigint, n bigint, pos array<int>, theme array<string>, category array<string>, x binary")
    return materialize(packed, "theme-blocks"), n


def _exact(x: np.ndarray, t: np.ndarray) -> float:
    """Cosine of one pair, the same bits wherever it is computed."""
    den = math.sqrt(float((x * x).sum())) * math.sqrt(float((t * t).sum()))
    return float((x * t).sum()) / den if den else 0.0


def _score(k: int | None):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for t in right.to_pylist():
            y = B.matrix(t["x"], t["n"])
            ny = np.sqrt((y * y).sum(1))
            for a in left.to_pylist():
                x = B.matrix(a["x"], a["n"])
                nx = np.sqrt((x * x).sum(1))
                tile = max(1, (32 << 20) // (8 * max(1, len(y))))
                for at in range(0, len(x), tile):
                    part = x[at:at + tile]
                    den = nx[at:at + tile, None] * ny[None, :]
                    sims = np.divide(part @ y.T, den, out=np.zeros(den.shape), where=den != 0)
                    for r, i in enumerate(B.ids(a["ids"])[at:at + tile].tolist()):
                        row = sims[r]
                        near = np.arange(len(y))
                        if k is not None and len(y) > k:
                            near = np.flatnonzero(row >= np.partition(row, len(y) - k)[len(y) - k] - CLOSE)
                        exact = sorted((-_exact(part[r], y[j]), t["pos"][j], t["theme"][j] or "", j) for j in near.tolist())
                        out.append({"id": i, "matches": [
                            {"neg": s, "theme_pos": p, "theme": t["theme"][j], "category": t["category"][j], "sim": -s}
                            for s, p, _, j in exact[:k]]})
        return pa.Table.from_pylist(out, schema=_OUT_ARROW)
    return run


def ranked_themes(items: DataFrame, themes: DataFrame, id_col: str, k: int | None, vec_col: str = "v", item_block: int = B.BLOCK,
                  theme_bytes: int = THEME_BYTES) -> DataFrame:
    """(id, matches): the ``k`` most similar themes of each item, best first (``k`` None: every theme).

    An item without a vector, and every item if the catalogue is empty, is not in the result.  Ids are unique.
    """
    catalogue, theme_parts = theme_blocks(themes, vec_col, theme_bytes)
    packed = B.pack_points(items, id_col, vec_col, item_block)
    item_parts = (packed.agg(F.max("block")).first()[0] or 0) + 1
    left = packed.select("block", "n", "ids", "x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(theme_parts - 1).cast("long"))).alias("tb"))
    right = catalogue.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(item_parts - 1).cast("long"))).alias("block"))
    found = left.groupBy("block", "tb").cogroup(right.groupBy("block", "tb")).applyInArrow(_score(k), _OUT)
    every = F.array_sort(F.flatten(F.collect_list("matches")))  # at most k per theme block, or the catalogue itself
    merged = found.groupBy("id").agg(every.alias("m")) if theme_parts > 1 else found.withColumnRenamed("matches", "m")
    best = F.col("m") if k is None else F.slice("m", 1, k)
    return merged.select(F.col("id").alias(id_col), best.alias("matches"))
