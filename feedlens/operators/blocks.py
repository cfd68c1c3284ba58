"""Points packed in blocks of a few thousand rows, for operators that work on matrices inside tasks.

A block is one row: its number, the ids (int64) and the vectors (float64, row by row) as bytes.  The table is
written once to the shared checkpoint folder, so iterative operators read matrices, not arrays of boxed doubles.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.functions import vectors
from feedlens.session import ensure_checkpoint_dir, materialize, ship_package

BLOCK = 2048
NONE = -(1 << 63)   # a null in a packed long column

SCHEMA = "block bigint, n bigint, ids binary, x binary"


def matrix(raw: bytes, n: int) -> np.ndarray:
    """The vectors of a block; writable copies are the caller's affair."""
    return np.frombuffer(raw, np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def pack_points(points: DataFrame, id_col: str, vec_col: str = "v", block: int = BLOCK, by: Column | None = None,
                more: dict[str, Column] | None = None, whole: dict[str, Column] | None = None) -> DataFrame:
    """Points in blocks of about ``block`` rows (by a hash of the id, or ``by``), ids ascending within a block.

    ``more``: further double columns, packed like the ids under their names; ``whole``: long columns, null as ``NONE``.
    Points whose vector is null are left out.
    """
    ship_package(points.sparkSession)
    ensure_checkpoint_dir(points.sparkSession)
    more, whole = more or {}, whole or {}
    rows = points.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), vectors.as_double(vec_col).alias("v"),
        *[c.cast("double").alias(k) for k, c in more.items()],
        *[F.coalesce(c.cast("long"), F.lit(NONE)).alias(k) for k, c in whole.items()], *([by.cast("long").alias("block")] if by is not None else []))
    if by is None:
        blocks = max(1, math.ceil(rows.count() / block))
        rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        # as many files as blocks or cores ask for: coalesced ones would leave later passes to a few tasks
        rows = rows.repartition(min(blocks, 4 * points.sparkSession.sparkContext.defaultParallelism), "block")

    kinds = {c: np.float64 for c in more} | {c: np.int64 for c in whole}

    def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        flat = table.column("v").combine_chunks().flatten().to_numpy().astype(np.float64)
        out = {"block": [key[0].as_py()], "n": [len(table)], "ids": [table.column("id").to_numpy().astype(np.int64).tobytes()],
               "x": [flat.tobytes()]}
        return pa.table(out | {k: [table.column(k).to_numpy().astype(kind).tobytes()] for k, kind in kinds.items()})
    schema = SCHEMA + "".join(f", {k} binary" for k in kinds)
    return materialize(rows.groupBy("block").applyInArrow(one, schema), "point-blocks")


def matrices(vecs: DataFrame, n: int) -> RDD:
    """The ``n`` vectors of a one-column table as float64 matrices of at most ``BLOCK`` rows, dealt evenly to the cores.

    For passes that need no ids, many times over the same points: persist the result.  A vector that is null, or has a
    number that is null or not finite, is an error.
    """
    spark = vecs.sparkSession
    ship_package(spark)
    tasks = spark.sparkContext.defaultParallelism
    block = min(BLOCK, max(64, -(-n // (8 * tasks))))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, block):
                rows = batch.column(0).slice(i, block)
                flat = rows.flatten()
                x = flat.to_numpy(zero_copy_only=False)
                if rows.null_count or flat.null_count or not np.isfinite(x).all():
                    raise ValueError("vectors must not be null and must hold finite numbers only")
                yield pa.RecordBatch.from_pylist([{"n": len(rows), "x": x.tobytes()}], schema=arrow)
    arrow = pa.schema([("n", pa.int64()), ("x", pa.binary())])
    # whole matrices are dealt in turn: a table in one file would leave every pass to a few tasks
    dealt = vecs.mapInArrow(pack, "n bigint, x binary").repartition(max(1, min(tasks, -(-n // block))))
    return dealt.rdd.map(lambda r: matrix(r["x"], r["n"]))


def each_block(fn: Callable[[dict], Iterator[dict]], schema: pa.Schema):
    """A ``mapInArrow`` function that turns each row (a dict) into rows (dicts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out = list(fn(batch.slice(i, 1).to_pylist()[0]))
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def block_pairs(blocks: DataFrame, columns: list[str], n_blocks: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of every unordered pair of the blocks 0 to ``n_blocks`` - 1, keyed by ``pair``; a block meets itself too."""
    here = F.col("block")
    left = blocks.select(*columns, F.explode(F.sequence(here, F.lit(n_blocks - 1).cast("long"))).alias("other"))
    right = blocks.select(*columns, F.explode(F.sequence(F.lit(0).cast("long"), here)).alias("other"))
    return (left.withColumn("pair", here * n_blocks + F.col("other")), right.withColumn("pair", F.col("other") * n_blocks + here))


def distances(x: np.ndarray, y: np.ndarray, tile: int = 64) -> np.ndarray:
    """Euclidean distances by differences: equal points are exactly 0 apart, and either order of two gives the same bits."""
    return np.vstack([np.sqrt(((x[i:i + tile, None, :] - y[None, :, :]) ** 2).sum(-1)) for i in range(0, len(x), tile)]) \
        if len(x) else np.zeros((0, len(y)))
