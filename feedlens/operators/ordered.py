"""Order-dependent computations without a single-partition window.

``running_sum`` and ``dense_index`` range-partition the rows by the ordering
key, compute local prefix sums inside each partition (Arrow batches in
``mapInPandas``) and add per-partition offsets from a tiny table of partition
totals.  Work is spread over all partitions; only one number per partition
reaches the driver.  The range-partitioned input is checkpointed so both
passes see the same partitioning, even after an executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.session import ensure_checkpoint_dir, ship_package


def _range_sorted(df: DataFrame, order: Sequence[str], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id()))
    return ranged.checkpoint(eager=True)


def running_sum(df: DataFrame, order: Sequence[str], values: Sequence[str], suffix: str = "_cum",
                exclusive: bool = False, partitions: int | None = None) -> DataFrame:
    """Add ``<value><suffix>`` = sum of ``value`` over all rows up to this one in ``order``.

    ``exclusive=True`` sums only the rows before this one.  Ties in ``order``
    must be broken by the caller (include a unique key).
    """
    ranged = _range_sorted(df, order, partitions)
    totals = ranged.groupBy("_pid").agg(*[F.sum(F.coalesce(F.col(v), F.lit(0))).alias(v) for v in values]).collect()
    offsets, acc = [], {v: 0 for v in values}
    for row in sorted(totals, key=lambda r: r["_pid"]):
        offsets.append((row["_pid"], *[acc[v] for v in values]))
        for v in values:
            acc[v] += row[v] or 0
    out_types = {v: ranged.schema[v].dataType for v in values}
    local_fields = [T.StructField(f"_loc_{v}", out_types[v]) for v in values]
    schema = T.StructType(ranged.schema.fields + local_fields)

    def local_prefix(batches):
        carry = {v: 0 for v in values}
        for pdf in batches:
            for v in values:
                x = pdf[v].fillna(0)
                cs = x.cumsum() + carry[v]
                pdf[f"_loc_{v}"] = (cs - x) if exclusive else cs
                carry[v] = cs.iloc[-1] if len(cs) else carry[v]
            yield pdf

    local = ranged.mapInPandas(local_prefix, schema)
    off_schema = T.StructType([T.StructField("_pid", T.IntegerType())] +
                              [T.StructField(f"_off_{v}", out_types[v]) for v in values])
    off_df = df.sparkSession.createDataFrame(pd.DataFrame(offsets, columns=[f.name for f in off_schema.fields]),
                                             off_schema)
    joined = local.join(F.broadcast(off_df), "_pid")
    for v in values:
        joined = joined.withColumn(v + suffix, F.col(f"_loc_{v}") + F.col(f"_off_{v}"))
    return joined.drop("_pid", *[f"_loc_{v}" for v in values], *[f"_off_{v}" for v in values])


def dense_index(df: DataFrame, order: Sequence[str], name: str = "row_idx", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (a distributed ``row_number() - 1``)."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    out = running_sum(one, order, ["_one"], suffix="_idx", exclusive=True, partitions=partitions)
    return out.withColumnRenamed("_one_idx", name).drop("_one")
