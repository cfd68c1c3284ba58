"""Connected components of a link table by alternating star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to its smallest neighbour or itself."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both if large else both.where(F.col("b") < F.col("a"))
    least = side.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    turned = side.join(least, "a")
    if large:
        new = turned.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        new = turned.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return new.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every linked node; the root is the smallest node of its component.

    Each round writes its edges to the shared checkpoint folder, and rounds go on until nothing changes.
    Null ends are no links; an empty table has no nodes.
    """
    def signed(df: DataFrame) -> tuple[DataFrame, tuple]:
        df = materialize(df, "components")
        x = df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        return df, tuple(x)
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges, sign = signed(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("a <> b").distinct())
    while sign[0]:
        edges, now = signed(_stars(_stars(edges, large=True), large=False))
        if now == sign:
            break
        sign = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
