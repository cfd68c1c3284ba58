"""Cluster statistics and clustering quality.

Cluster-level tables have one row per cluster (k rows), so windows over them
are cheap; everything that touches points is a grouped aggregate, a broadcast
join against the k centroids, or a blocked pairwise pass.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions import vectors
from feedlens.operators import blocks as B
from feedlens.operators import neighbours
from feedlens.session import materialize


def cluster_sizes(members: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    return members.groupBy(cluster_col).agg(F.count("*").alias("size"))


def size_stats(sizes: DataFrame) -> DataFrame:
    """num_clusters, min/max/mean/median size."""
    return sizes.agg(F.count("*").alias("num_clusters"), F.min("size").alias("min_size"),
                     F.max("size").alias("max_size"), F.avg("size").alias("mean_size"),
                     F.percentile("size", 0.5).alias("median_size"))


def legacy_size_pairing(sizes: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """The reference's size table: sorted ids zipped with sorted sizes (not each cluster's own size)."""
    ids = sizes.select(cluster_col, F.row_number().over(Window.orderBy(cluster_col)).alias("_r"))
    szs = sizes.select(F.col("size").alias("size_legacy"), F.row_number().over(Window.orderBy("size")).alias("_r"))
    return ids.join(szs, "_r").drop("_r")


def size_balance(sizes: DataFrame) -> DataFrame:
    """min, max, mean, median, max/min ratio and coefficient of variation (pop std / mean)."""
    return (sizes.agg(F.min("size").alias("min_size"), F.max("size").alias("max_size"),
                      F.avg("size").alias("mean_size"), F.percentile("size", 0.5).alias("median_size"),
                      F.stddev_pop("size").alias("_std"))
            .withColumn("range_ratio", F.try_divide(F.col("max_size"), F.col("min_size")))
            .withColumn("coefficient_variation", F.col("_std") / F.col("mean_size")).drop("_std"))


def dominant_share(members: DataFrame, cluster_col: str = "cluster_id", label_col: str = "sentiment") -> DataFrame:
    """Per cluster: % of members carrying the most frequent label."""
    counts = members.groupBy(cluster_col, label_col).agg(F.count("*").alias("n"))
    return counts.groupBy(cluster_col).agg((F.lit(100.0) * F.max("n") / F.sum("n")).alias("dominant_pct"))


def sentiment_coherence(members: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Mean dominant-sentiment %, clusters above 70 % and 80 %."""
    d = dominant_share(members, cluster_col)
    return d.agg(F.avg("dominant_pct").alias("mean_dominant_pct"),
                 F.count_if(F.col("dominant_pct") > 70).alias("clusters_gt_70"),
                 F.count_if(F.col("dominant_pct") > 80).alias("clusters_gt_80"),
                 F.count("*").alias("total_clusters"))


def top_coherent(members: DataFrame, k: int = 5, cluster_col: str = "cluster_id") -> DataFrame:
    """The k most sentiment-homogeneous clusters, formatted ``Cluster i: p% dominant``."""
    d = dominant_share(members, cluster_col).orderBy(F.desc("dominant_pct"), cluster_col).limit(k)
    return (d.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("dominant_pct"), cluster_col)))
            .withColumn("label", F.format_string("Cluster %d: %.0f%% dominant", F.col(cluster_col),
                                                 F.col("dominant_pct"))))


def centroids(points: DataFrame, vec_col: str = "v", cluster_col: str = "cluster_id") -> DataFrame:
    """Mean vector per cluster (ML ``Summarizer``: one pass, no per-dimension explode)."""
    vec = points.select(cluster_col, array_to_vector(vectors.as_double(vec_col)).alias("_v"))
    agg = vec.groupBy(cluster_col).agg(Summarizer.mean(F.col("_v")).alias("_m"), F.count("*").alias("size"))
    return agg.select(cluster_col, "size", vector_to_array("_m").alias("centroid"))


_DB_ROW = "cid long, worst double, far double"


def _worst_ratios(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For the centroids of both blocks: the largest (s_i + s_j) / d and the largest d over the other block."""
    if left.empty or right.empty:
        return pd.DataFrame({"cid": pd.Series(dtype="int64"), "worst": pd.Series(dtype="float64"),
                             "far": pd.Series(dtype="float64")})
    x, y = (np.stack(f[c].to_numpy()).astype(np.float64) for f, c in ((left, "centroid"), (right, "rcentroid")))
    d = np.vstack([np.sqrt(((x[i:i + _DB_TILE, None, :] - y[None, :, :]) ** 2).sum(-1)) for i in range(0, len(x), _DB_TILE)])
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = (left["s"].to_numpy()[:, None] + right["rs"].to_numpy()[None, :]) / d
    ratio[d == 0] = 0.0  # a centroid against itself or its double
    return pd.DataFrame({"cid": np.concatenate([left["cid"], right["rcid"]]),
                         "worst": np.concatenate([ratio.max(1), ratio.max(0)]),
                         "far": np.concatenate([d.max(1), d.max(0)])})


_DB_TILE = 32


def davies_bouldin(points: DataFrame, vec_col: str = "v", cluster_col: str = "cluster_id",
                   block_size: int = 1024) -> DataFrame:
    """Davies-Bouldin index: mean over clusters of max_j (s_i + s_j) / d(c_i, c_j).

    Linear in N: one pass for the centroids, one join for the mean distance to the own centroid.  The k
    centroids are compared in blocks of ``block_size``, one task per pair of blocks, which keeps the
    largest ratio per cluster; nothing but the score reaches the driver.  0 if all spreads or all
    distances between centroids are (nearly) 0, null for fewer than two clusters.
    """
    from feedlens.session import ship_package
    ship_package(points.sparkSession)
    cents = centroids(points, vec_col, cluster_col)
    joined = points.join(cents.select(cluster_col, "centroid"), cluster_col)
    spread = joined.groupBy(cluster_col).agg(F.avg(vectors.euclid(vec_col, "centroid")).alias("s"))
    rows = cents.join(spread, cluster_col).select(F.col(cluster_col).cast("long").alias("cid"), "centroid", "s")
    rows = materialize(rows, "centroids")
    n = rows.count()
    blocks = max(1, math.ceil(n / block_size))
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("cid"), F.lit(blocks)))
    left = rows.withColumn("_o", F.explode(F.sequence(F.col("_b"), F.lit(blocks - 1)))) \
        .withColumn("_pair", F.col("_b") * blocks + F.col("_o"))
    right = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_b")))) \
        .withColumn("_pair", F.col("_o") * blocks + F.col("_b"))
    worst = (left.select("_pair", "cid", "centroid", "s").groupBy("_pair")
             .cogroup(right.select("_pair", F.col("cid").alias("rcid"), F.col("centroid").alias("rcentroid"),
                                   F.col("s").alias("rs")).groupBy("_pair"))
             .applyInPandas(_worst_ratios, _DB_ROW))
    per = worst.groupBy("cid").agg(F.max("worst").alias("worst"), F.max("far").alias("far"))
    score = per.agg(F.avg("worst").alias("mean"), F.max("far").alias("far"), F.count("*").cast("int").alias("num_clusters"),
                    F.max("worst").alias("any"))
    flat = (F.col("far") <= 1e-8) | (F.col("any") * F.col("far") <= 1e-8)
    return score.select(F.when(F.col("num_clusters") < 2, F.lit(None).cast("double")).when(flat, F.lit(0.0))
                        .otherwise(F.col("mean")).alias("davies_bouldin"), "num_clusters")


_PARTIAL = "pid long, own long, other long, dsum double, cnt long"


def _by_label(part: neighbours.Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the points by label, the labels, first place of each label in that order)."""
    order = np.argsort(part.more["cid"], kind="stable")
    labels, first = np.unique(part.more["cid"][order], return_index=True)
    return order, labels, first


def _add_sums(total: np.ndarray, d: np.ndarray, first: np.ndarray, begin: int) -> None:
    """Add the sums of the columns of ``d`` by label; they are the points ``begin`` and on in label order."""
    lo, hi = np.searchsorted(first, [begin, begin + d.shape[1] - 1], "right") - 1
    starts = np.maximum(first[lo:hi + 1] - begin, 0)
    total[:, lo:hi + 1] += np.add.reduceat(d, starts, axis=1)


def _label_sums(left: pa.Table, right: pa.Table | None) -> pa.Table:
    """One pair of parts: for the points of both, sum and count of the distances to each cluster of the other part."""
    a = neighbours.Part(left, (), ("cid",))
    b = a if right is None else neighbours.Part(right, (), ("cid",))
    (oa, la, fa), (ob, lb, fb) = _by_label(a), _by_label(b)
    x, y, sx, sy = a.x[oa], b.x[ob], a.sq[oa], b.sq[ob]
    there, back = np.zeros((len(x), len(lb))), np.zeros((len(y), len(la)))
    for i in range(0, len(x), 256):
        for j in range(0, len(y), neighbours.WIDTH):
            d = x[i:i + 256] @ y[j:j + neighbours.WIDTH].T
            d *= -2
            d += sx[i:i + 256, None]
            d += sy[None, j:j + neighbours.WIDTH]
            np.sqrt(np.maximum(d, 0, out=d), out=d)
            if right is None:  # a point is at distance 0 from itself
                same = np.arange(max(i, j), max(max(i, j), min(i + len(d), j + d.shape[1])))
                d[same - i, same - j] = 0
            _add_sums(there[i:i + 256], d, fb, j)
            if right is not None:
                _add_sums(back[j:j + neighbours.WIDTH], d.T, fa, i)
    out = []
    for part, order, labels, first, n, total in ((a, oa, lb, fb, len(y), there), *([(b, ob, la, fa, len(x), back)] if right is not None else [])):
        count = np.diff([*first, n])
        own, other = np.repeat(part.more["cid"][order], len(labels)), np.tile(labels, len(order))
        none = other == B.NONE  # points without a label belong to no cluster
        out.append(pa.Table.from_arrays([
            pa.array(np.repeat(part.ids[order], len(labels))), pa.array(own, mask=own == B.NONE), pa.array(other, mask=none),
            pa.array(np.where(none, 0.0, total.ravel())), pa.array(np.where(none, 0, np.tile(count, len(order))))],
            names=["pid", "own", "other", "dsum", "cnt"]))
    return pa.concat_tables(out)


def silhouette_exact(points: DataFrame, id_col: str, vec_col: str = "v", cluster_col: str = "cluster_id",
                     block_size: int = 2048) -> DataFrame:
    """Mean Euclidean silhouette over all points, exact (V9).

    Points are packed in blocks by a hash of the id, and runs of blocks form parts (``neighbours.tiles``); each unordered
    pair of parts is one task that computes the distances tile by tile with BLAS and emits, for the points of both, the sums
    per cluster of the other part.  No pair of points is ever a row, a point travels as often as there are parts, not blocks,
    and memory per task is bounded by two parts.  Work is O(N^2 d), as the metric requires: for very large N use
    ``silhouette_sampled`` or ``silhouette_squared``.  Points without a vector take no part.
    """
    pts = B.pack_points(points, id_col, vec_col, block_size, whole={"cid": F.col(cluster_col)})
    found = pts.select("block", "n", (F.octet_length("x") / F.col("n")).cast("long").alias("width")).collect()  # one row per block
    size = np.zeros(max((r["block"] + 1 for r in found), default=0), np.int64)
    for r in found:
        size[r["block"]] = r["n"]
    partial = neighbours.tiles(pts, size, max((r["width"] for r in found), default=8), _label_sums, _PARTIAL)
    per = partial.groupBy("pid", "own", "other").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
    return _mean_silhouette(per, "silhouette", F.col("own_n") - 1)


def _mean_silhouette(per: DataFrame, name: str, others) -> DataFrame:
    """Mean of (b - a) / max(a, b); ``others`` is the number of reference points of the own cluster."""
    own = F.col("other") == F.col("own")
    point = per.groupBy("pid", "own").agg(
        F.sum(F.when(own, F.col("dsum"))).alias("a_sum"), F.sum(F.when(own, F.col("cnt"))).alias("own_n"),
        F.min(F.when(~own & (F.col("cnt") > 0), F.col("dsum") / F.col("cnt"))).alias("b"))
    a = F.try_divide(F.col("a_sum"), others)
    s = (F.when(a.isNull() | (others <= 0), F.lit(0.0))
         .when(F.greatest(a, F.col("b")) == 0, F.lit(0.0))
         .otherwise((F.col("b") - a) / F.greatest(a, F.col("b"))))
    return point.agg(F.avg(s).alias(name), F.count("*").alias("n"))


def _anchor_distances(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Weighted distance sums per cluster of a block of points over a block of anchors."""
    if left.empty or right.empty:
        return pd.DataFrame({c: pd.Series(dtype="int64" if c != "dsum" else "float64") for c in ("pid", "own", "other", "dsum", "cnt")})
    x = np.stack(left["v"].to_numpy()).astype(np.float64)
    y = np.stack(right["rv"].to_numpy()).astype(np.float64)
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * x @ y.T
    other = left["pid"].to_numpy()[:, None] != right["rpid"].to_numpy()[None, :]
    dist = np.where(other, np.sqrt(np.maximum(d2, 0.0)), 0.0) * right["rw"].to_numpy()[None, :]
    out, labels = [], right["rcid"].to_numpy()
    for lab in np.unique(labels):
        out.append(pd.DataFrame({"pid": left["pid"], "own": left["cid"], "other": np.full(len(x), lab),
                                 "dsum": dist[:, labels == lab].sum(1), "cnt": np.ones(len(x), np.int64)}))
    return pd.concat(out, ignore_index=True)


def _uniform(key: Column) -> Column:
    """A seeded key as a number in (0, 1); squared modulo the prime, so that two seeds are not shifts of each other."""
    from feedlens.functions.hashing import MODULUS
    return (F.pmod(key * key, F.lit(MODULUS)).cast("double") + 0.5) / MODULUS


def sample_size(epsilon: float, delta: float, n: int, k: int) -> int:
    """Expected anchors of a cluster per unit of importance: ln(4 n k / delta) / (2 epsilon**2)."""
    return math.ceil(math.log(4 * n * k / delta) / (2 * epsilon * epsilon))


def silhouette_anchors(points: DataFrame, id_col: str, epsilon: float = 0.1, delta: float = 0.1, vec_col: str = "v",
                       cluster_col: str = "cluster_id", seed: int = 42, per_cluster: int = 0) -> DataFrame:
    """(id, cluster, v, weight): anchors of each cluster, drawn with probability in proportion to their importance.

    Altieri, Pietracaprina, Pucci and Vandin (2021): a few uniform points of each cluster (about 2 ln(2 k / delta)) bound
    the importance of its points from below: the largest share that a point has in one of their distance sums, and at
    least 1 / size.  A point is drawn with probability min(1, t x importance), t = ``sample_size``, and weighs the
    inverse.  Draws are seeded hashes of the id.  A cluster with fewer than about t points is taken whole.  ``per_cluster``: expected anchors that
    a cluster has at least, if it has as many points.
    """
    from feedlens.functions.hashing import seeded_key
    pts = points.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("pid"), F.col(cluster_col).cast("long").alias("cid"), vectors.as_double(vec_col).alias("v"))
    sizes = materialize(pts.groupBy("cid").agg(F.count("*").alias("size")), "silhouette-sizes")
    n, k = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not n:
        return pts.select("pid", "cid", "v", F.lit(1.0).alias("weight"))
    t = sample_size(epsilon, delta, n, k)
    key = F.abs("pid")
    sized = pts.join(sizes, "cid")
    first = sized.where(_uniform(seeded_key(key, seed)) < F.lit(2 * math.log(2 * k / delta)) / F.col("size"))
    # a handful of points of each cluster, at most about 2 ln(2 k / delta): they travel as one list per cluster
    few = first.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("pid", "v"))).alias("few"))
    few = materialize(few, "silhouette-few")
    to_few = materialize(sized.join(few, "cid", "left").select(
        "pid", "cid", "v", "size", F.transform("few", lambda e: vectors.euclid("v", e["v"])).alias("d")), "silhouette-importance")
    sums = to_few.select("cid", F.posexplode("d").alias("e", "d")).groupBy("cid", "e").agg(F.sum("d").alias("w"))
    sums = sums.groupBy("cid").agg(F.transform(F.sort_array(F.collect_list(F.struct("e", "w"))), lambda x: x["w"]).alias("w"))
    share = F.array_max(F.zip_with("d", "w", lambda d, w: F.when(w > 0, d / w).otherwise(F.lit(0.0))))
    chance = F.least(F.lit(1.0), F.lit(float(t)) * F.greatest(F.lit(1.0) / F.col("size"), F.coalesce(share, F.lit(0.0))))
    if per_cluster:
        chance = F.least(F.lit(1.0), F.greatest(chance, F.lit(float(per_cluster)) / F.col("size")))
    drawn = to_few.join(sums, "cid", "left").select("pid", "cid", "v", chance.alias("p"))
    return drawn.where(_uniform(seeded_key(key, seed + 1)) < F.col("p")).select("pid", "cid", "v", (F.lit(1.0) / F.col("p")).alias("weight"))


def silhouette_sampled(points: DataFrame, id_col: str, epsilon: float = 0.1, delta: float = 0.1, vec_col: str = "v",
                       cluster_col: str = "cluster_id", seed: int = 42, block_size: int = 2048, per_cluster: int = 0) -> DataFrame:
    """An estimate of the Euclidean silhouette: every point against the importance-weighted anchors of each cluster.

    All N points are scored.  With ``sample_size`` anchors (up to the constant of the published analysis), the estimate is
    within 4 epsilon / (1 - epsilon) of the exact value with probability 1 - ``delta``; ``tests/test_silhouette.py`` measures the
    error.  The anchors number O(k log(n k) / epsilon**2), so the work grows as N log N, not as N squared.  Points and
    anchors meet in blocks, one task per pair of blocks.
    """
    from feedlens.session import ship_package
    ship_package(points.sparkSession)
    pts = points.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("pid"), F.col(cluster_col).cast("long").alias("cid"), vectors.as_double(vec_col).alias("v"))
    anchors = materialize(silhouette_anchors(points, id_col, epsilon, delta, vec_col, cluster_col, seed, per_cluster), "anchors")
    nl, nr = (max(1, math.ceil(df.count() / block_size)) for df in (pts, anchors))
    left = pts.withColumn("_b", F.pmod(F.xxhash64("pid"), F.lit(nl))).withColumn(
        "_o", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nr - 1).cast("long")))).withColumn(
            "_pair", F.col("_b") * nr + F.col("_o"))
    right = anchors.withColumn("_b", F.pmod(F.xxhash64("pid"), F.lit(nr))).withColumn(
        "_o", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nl - 1).cast("long")))).withColumn(
            "_pair", F.col("_o") * nr + F.col("_b"))
    partial = (left.select("_pair", "pid", "cid", "v").groupBy("_pair")
               .cogroup(right.select("_pair", F.col("pid").alias("rpid"), F.col("cid").alias("rcid"), F.col("v").alias("rv"),
                                     F.col("weight").alias("rw")).groupBy("_pair"))
               .applyInPandas(_anchor_distances, _PARTIAL))
    sums = partial.groupBy("pid", "own", "other").agg(F.sum("dsum").alias("dsum"))
    sizes = pts.groupBy(F.col("cid").alias("other")).agg(F.count("*").alias("cnt"))
    return _mean_silhouette(sums.join(sizes, "other"), "silhouette_estimate", F.col("own_n") - 1)


def silhouette_squared(points: DataFrame, vec_col: str = "v", cluster_col: str = "cluster_id") -> DataFrame:
    """Spark ML's linear-time silhouette with squared Euclidean distance (a different metric than V9's)."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    df = points.select(array_to_vector(vectors.as_double(vec_col)).alias("features"),
                       F.col(cluster_col).cast("double").alias("prediction"))
    score = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(df)
    return points.sparkSession.createDataFrame([(float(score), "squaredEuclidean")], "silhouette double, mode string")


def coverage(members: DataFrame, total_input: int | None = None, cluster_col: str = "cluster_id") -> DataFrame:
    """Clustered rows / input rows in %; the denominator defaults to the input table's own count."""
    agg = members.agg(F.count("*").alias("total_input"), F.count(cluster_col).alias("total_aspects_clustered"),
                      F.countDistinct(cluster_col).alias("num_clusters"))
    if total_input is not None:
        agg = agg.withColumn("total_input", F.lit(total_input).cast("long"))
    return agg.withColumn("coverage_pct", F.lit(100.0) * F.col("total_aspects_clustered") / F.col("total_input"))
