"""Registry of named queries and their DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables; every
floating-point output column is rounded to 6 places (``finish``) and the
oracle does the same with ``r6`` so both engines can be compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.plans import fixtures
from feedlens.session import ensure_checkpoint_dir, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
CHECK: dict[str, str] = {}  # name -> "O" (oracle) / "R" (rows only)


def query(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            fixtures.register(spark, sf_dir)
            return finish(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        CHECK[name] = "O" if oracle else "R"
        if oracle:
            ORACLE[name] = oracle
        return run

    return deco


def finish(df: DataFrame) -> DataFrame:
    """Round float columns to 6 places so engines agree on value hashes."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(F.round(F.col(f"`{f.name}`").cast("double"), 6).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/feedlens-{name}-{uuid.uuid4().hex}"


def r6(expr: str) -> str:
    """DuckDB: round a double to 6 places the way Spark's ``round`` does (half-up on the shortest repr)."""
    return f"CAST(round(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR)::DECIMAL(38,18), 6) AS DOUBLE)"


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
