"""Cluster statistics, quality metrics, clustering and insight queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.functions import prompts, ratings
from feedlens.functions.hashing import MODULUS, seeded_key_sql
from feedlens.operators import clustering, completion, insights, quality
from feedlens.plans.aspects import ASPECTS_SQL, aspect_rows
from feedlens.plans.fixtures import cte
from feedlens.plans.registry import query, r6

SIZES_SQL = ASPECTS_SQL + ", sz AS (SELECT cluster_id, count(*) AS size FROM a GROUP BY cluster_id)\n"
VEC_SQL = cte("v_vectors") + ", p AS (SELECT vec_id, cluster_id, CAST(v AS DOUBLE[]) AS v FROM v_vectors)\n"
SQDIST = "list_sum(list_transform(list_zip({a}, {b}), lambda t: (t[1] - t[2]) * (t[1] - t[2])))"


def sizes(spark):
    return quality.cluster_sizes(aspect_rows(spark))


def vecs(spark):
    return spark.table("v_vectors")


@query("cluster_size_stats", SIZES_SQL + f"""
SELECT count(*) AS num_clusters, min(size) AS min_size, max(size) AS max_size, {r6('avg(size)')} AS mean_size,
       {r6('quantile_cont(size, 0.5)')} AS median_size FROM sz""")
def q_cluster_size_stats(spark, sf_dir):
    return quality.size_stats(sizes(spark))


@query("cluster_sizes", SIZES_SQL + "SELECT cluster_id, size FROM sz")
def q_cluster_sizes(spark, sf_dir):
    return sizes(spark)


@query("cluster_sizes_legacy", SIZES_SQL + """
, i AS (SELECT cluster_id, row_number() OVER (ORDER BY cluster_id) AS r FROM sz),
s AS (SELECT size AS size_legacy, row_number() OVER (ORDER BY size) AS r FROM sz)
SELECT i.cluster_id, s.size_legacy FROM i JOIN s ON i.r = s.r""")
def q_cluster_sizes_legacy(spark, sf_dir):
    """The reference's size table (sorted ids zipped with sorted sizes), kept for golden comparison."""
    return quality.legacy_size_pairing(sizes(spark))


@query("cluster_balance", SIZES_SQL + f"""
SELECT min(size) AS min_size, max(size) AS max_size, {r6('avg(size)')} AS mean_size,
       {r6('quantile_cont(size, 0.5)')} AS median_size, {r6('max(size) / min(size)')} AS range_ratio,
       {r6('stddev_pop(size) / avg(size)')} AS coefficient_variation FROM sz""")
def q_cluster_balance(spark, sf_dir):
    return quality.size_balance(sizes(spark))


DOM_SQL = ASPECTS_SQL + """
, cs AS (SELECT cluster_id, sentiment, count(*) AS n FROM a GROUP BY cluster_id, sentiment),
dom AS (SELECT cluster_id, 100.0 * max(n) / sum(n) AS dominant_pct FROM cs GROUP BY cluster_id)
"""


@query("sentiment_coherence", DOM_SQL + f"""
SELECT {r6('avg(dominant_pct)')} AS mean_dominant_pct, count(*) FILTER (WHERE dominant_pct > 70) AS clusters_gt_70,
       count(*) FILTER (WHERE dominant_pct > 80) AS clusters_gt_80, count(*) AS total_clusters FROM dom""")
def q_sentiment_coherence(spark, sf_dir):
    return quality.sentiment_coherence(aspect_rows(spark))


@query("top_coherent", DOM_SQL + f"""
SELECT cluster_id, {r6('dominant_pct')} AS dominant_pct, CAST(rk AS INT) AS rank,
       concat('Cluster ', CAST(cluster_id AS VARCHAR), ': ', {prompts.fmt_sql('dominant_pct', 0)}, '% dominant') AS label
FROM (SELECT *, row_number() OVER (ORDER BY dominant_pct DESC, cluster_id) AS rk FROM dom) WHERE rk <= 5""")
def q_top_coherent(spark, sf_dir):
    return quality.top_coherent(aspect_rows(spark), 5).withColumn("rank", F.col("rank").cast("int"))


@query("cluster_coverage", cte("v_vectors") + f"""
SELECT count(*) AS total_input, count(cluster_id) AS total_aspects_clustered,
       count(DISTINCT cluster_id) AS num_clusters, {r6('100.0 * count(cluster_id) / count(*)')} AS coverage_pct,
       {ratings.ladder_sql('cluster_coverage_pct', r6('100.0 * count(cluster_id) / count(*)'))} AS rating
FROM v_vectors""")
def q_cluster_coverage(spark, sf_dir):
    """Clustered / input rows; the denominator is the input table's own count (not a constant)."""
    cov = quality.coverage(vecs(spark))
    return cov.withColumn("coverage_pct", F.round("coverage_pct", 6)).withColumn(
        "rating", ratings.rate("cluster_coverage_pct", "coverage_pct"))


CENT_SQL = VEC_SQL + """
, e AS (SELECT cluster_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM p),
c AS (SELECT cluster_id, pos, avg(x) AS m, count(*) AS size FROM e GROUP BY cluster_id, pos),
cv AS (SELECT cluster_id, list(m ORDER BY pos) AS cen FROM c GROUP BY cluster_id)
"""


@query("centroids", CENT_SQL + f"""
SELECT cluster_id, size, CAST(pos - 1 AS INT) AS pos, {r6('m')} AS value FROM c""")
def q_centroids(spark, sf_dir):
    c = quality.centroids(vecs(spark))
    return c.select("cluster_id", "size", F.posexplode("centroid").alias("pos", "value"))


@query("davies_bouldin", CENT_SQL + f"""
, s AS (SELECT p.cluster_id, avg(sqrt({SQDIST.format(a='p.v', b='cv.cen')})) AS s
        FROM p JOIN cv ON p.cluster_id = cv.cluster_id GROUP BY p.cluster_id),
pr AS (SELECT a.cluster_id AS i, (sa.s + sb.s) / sqrt({SQDIST.format(a='a.cen', b='b.cen')}) AS r
       FROM cv a JOIN cv b ON a.cluster_id <> b.cluster_id
       JOIN s sa ON sa.cluster_id = a.cluster_id JOIN s sb ON sb.cluster_id = b.cluster_id)
SELECT {r6('avg(mx)')} AS davies_bouldin, CAST(count(*) AS INT) AS num_clusters
FROM (SELECT i, max(r) AS mx FROM pr GROUP BY i)""")
def q_davies_bouldin(spark, sf_dir):
    return quality.davies_bouldin(vecs(spark))


@query("silhouette_exact", VEC_SQL + f"""
, d AS (SELECT a.vec_id, a.cluster_id AS own, b.cluster_id AS other, sqrt({SQDIST.format(a='a.v', b='b.v')}) AS dist
        FROM p a, p b),
g AS (SELECT vec_id, own, other, sum(dist) AS s, count(*) AS c FROM d GROUP BY vec_id, own, other),
pp AS (SELECT vec_id, own, sum(CASE WHEN other = own THEN s END) AS a_sum, sum(CASE WHEN other = own THEN c END) AS own_n,
              min(CASE WHEN other <> own THEN s / c END) AS b FROM g GROUP BY vec_id, own),
ss AS (SELECT CASE WHEN own_n <= 1 THEN 0.0
                   ELSE (b - a_sum / (own_n - 1)) / greatest(a_sum / (own_n - 1), b) END AS s FROM pp)
SELECT {r6('avg(s)')} AS silhouette, count(*) AS n FROM ss""")
def q_silhouette_exact(spark, sf_dir):
    """Exact Euclidean silhouette via blocked pairwise distances (no pair rows)."""
    return quality.silhouette_exact(vecs(spark), "vec_id", block_size=256)


@query("silhouette_sq")
def q_silhouette_sq(spark, sf_dir):
    """Spark ML silhouette (squared Euclidean, linear time) - the large-N mode."""
    return quality.silhouette_squared(vecs(spark))


LLOYD_K = 8


@query("kmeans_lloyd_step", cte() + f"""
WITH p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
c AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INT) AS center, v AS cv FROM p
      QUALIFY row_number() OVER (ORDER BY vec_id) <= {LLOYD_K}),
d AS (SELECT p.vec_id, p.v, c.center, {SQDIST.format(a='p.v', b='c.cv')} AS dd FROM p, c),
a AS (SELECT vec_id, v, center FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dd, center) = 1),
e AS (SELECT center, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a)
SELECT center, count(*) AS size, CAST(pos - 1 AS INT) AS pos, {r6('avg(x)')} AS value FROM e GROUP BY center, pos""")
def q_kmeans_lloyd_step(spark, sf_dir):
    """One Lloyd step from the first 8 vectors (by id) as centres."""
    v = vecs(spark)
    first = [list(r["v"]) for r in v.orderBy("vec_id").limit(LLOYD_K).select("v").collect()]
    new = clustering.lloyd_step(v, first)
    return new.select(F.col("center").cast("int").alias("center"), "size",
                      F.posexplode("centroid").alias("pos", "value"))


@query("kmeans_sizes")
def q_kmeans_sizes(spark, sf_dir):
    """Spark ML k-means (k=8, best of 10 k-means|| runs from seed 42): cluster sizes."""
    v = vecs(spark).select("vec_id", "v")
    model = clustering.kmeans_fit(v, 8, seed=42, n_init=10)
    return quality.cluster_sizes(clustering.assign(model, v))


@query("hierarchical_sizes")
def q_hierarchical_sizes(spark, sf_dir):
    """Ward's agglomerative clustering cut into 20 clusters: sizes, by the smallest vector id."""
    from feedlens.operators import ward
    return quality.cluster_sizes(ward.ward(vecs(spark).select("vec_id", "v"), "vec_id", 20, block=256, last=256))


@query("ward_merges")
def q_ward_merges(spark, sf_dir):
    """Every merge of Ward's hierarchy: the clusters it joins (by smallest id), its cost and the size it gives."""
    from feedlens.operators import ward
    return ward.merges(vecs(spark).select("vec_id", "v"), "vec_id", block=256, last=256)


@query("cluster_methods")
def q_cluster_methods(spark, sf_dir):
    """Each clustering method by name: clusters, noise points and, without noise, both quality scores."""
    v = vecs(spark).select("vec_id", "v")
    out = None
    for method in clustering.METHODS:
        _, meta = clustering.cluster(v, "vec_id", method)
        out = meta if out is None else out.unionByName(meta)
    return out


@query("cluster_assign_join", cte("v_vectors", "v_aspects") + """
SELECT a.seq AS vec_id, p.cluster_id, a.aspect, a.sentiment FROM v_aspects a LEFT JOIN v_vectors p ON a.seq = p.vec_id""")
def q_cluster_assign_join(spark, sf_dir):
    """Labels joined back to aspects by id (replaces the positional zip); aspects without a vector have no label."""
    labels = vecs(spark).select("vec_id", "cluster_id")
    asp = spark.table("v_aspects").select(F.col("seq").alias("vec_id"), "aspect", "sentiment")
    return asp.join(labels, "vec_id", "left").select("vec_id", "cluster_id", "aspect", "sentiment")


def _prompt_sql():
    tpl = "'" + prompts.INSIGHT_TEMPLATE.replace("'", "''") + "'"
    return ASPECTS_SQL + f"""
, sz AS (SELECT cluster_id, CAST(ceil(count(*) / 500.0) AS BIGINT) AS nch FROM a GROUP BY cluster_id),
l AS (SELECT a.cluster_id, CAST(({seeded_key_sql('a.seq', 11)}) % sz.nch AS INT) AS chunk, a.seq, a.sentiment,
             concat('- ', a.aspect, ' (', a.sentiment, ', confidence: ', {prompts.fmt_sql('a.confidence', 2)}, ')') AS line
      FROM a JOIN sz ON a.cluster_id = sz.cluster_id),
pr AS (SELECT cluster_id, chunk, count(*) AS n_lines,
              replace({tpl}, '{{aspects}}', string_agg(line, chr(10) ORDER BY seq)) AS prompt
       FROM l GROUP BY cluster_id, chunk)
"""


@query("render_cluster_prompt", _prompt_sql() + """
SELECT cluster_id, chunk, n_lines, sha256(concat('stub-model', chr(1), prompt)) AS request_id FROM pr""")
def q_render_cluster_prompt(spark, sf_dir):
    """One insight prompt per (cluster, chunk of <= ~500 lines), lines in appearance order."""
    p = insights.cluster_prompts(aspect_rows(spark))
    return p.select("cluster_id", "chunk", "n_lines", "request_id")


INSIGHT_SQL = cte("v_aspects", "v_insight_answers") + """
, ins AS (SELECT c.cluster_id, CASE WHEN starts_with(a.text, '```json') AND ends_with(a.text, '```')
                                    THEN 'success' ELSE 'error' END AS status, v.cluster_name, v.summary, v.primary_sentiment
          FROM (SELECT DISTINCT cluster_id FROM v_aspects) c JOIN v_insight_answers a ON a.cluster_id = c.cluster_id
          JOIN v_insights v ON v.cluster_id = c.cluster_id)
"""


def stored_insights(spark):
    """One insight per cluster from the stored answers; large clusters are answered in parts and merged."""
    answers = spark.table("v_insight_answers")
    return insights.cluster_insights(aspect_rows(spark), lambda req: completion.stored(req, answers, ["cluster_id"], keep=True))


@query("cluster_insights", INSIGHT_SQL + """
SELECT cluster_id, status, CASE WHEN status = 'success' THEN cluster_name END AS cluster_name,
       CASE WHEN status = 'success' THEN summary END AS summary,
       CASE WHEN status = 'success' THEN primary_sentiment END AS primary_sentiment FROM ins""")
def q_cluster_insights(spark, sf_dir):
    """Insight per cluster; answers that were cut short become error rows."""
    return stored_insights(spark).select("cluster_id", "status", "cluster_name", "summary", "primary_sentiment")


@query("insight_success", INSIGHT_SQL + f"""
SELECT count(*) AS total_clusters, count(*) FILTER (WHERE status = 'success') AS successful_insights,
       count(*) FILTER (WHERE status <> 'success') AS failed_insights,
       {r6("count(*) FILTER (WHERE status = 'success') / count(*)")} AS success_rate,
       {ratings.ladder_sql('interpretability_rate', r6("count(*) FILTER (WHERE status = 'success') / count(*)"))} AS rating
FROM ins""")
def q_insight_success(spark, sf_dir):
    """Interpretability: share of clusters with a parsed insight, rated."""
    s = insights.insight_success(stored_insights(spark))
    return (s.withColumn("success_rate", F.round("success_rate", 6))
            .withColumn("rating", ratings.rate("interpretability_rate", "success_rate")))


# ---------------------------------------------------------------- density, embeddings, report

DENSITY_EPS = 1.15
DENSITY_MIN = 3


@query("density_clusters", VEC_SQL + f"""
, dd AS (SELECT a.vec_id AS s, b.vec_id AS t, sqrt({SQDIST.format(a='a.v', b='b.v')}) AS dist
         FROM p a, p b WHERE a.vec_id <> b.vec_id),
core AS (SELECT s AS vec_id, dist AS core FROM dd
         QUALIFY row_number() OVER (PARTITION BY s ORDER BY dist) = {DENSITY_MIN - 1}),
e AS (SELECT dd.s, dd.t AS d FROM dd JOIN core c1 ON c1.vec_id = dd.s JOIN core c2 ON c2.vec_id = dd.t
      WHERE greatest(dd.dist, c1.core, c2.core) <= {DENSITY_EPS}),
r AS (SELECT * FROM (
  WITH RECURSIVE reach(v, lab) AS (
    SELECT vec_id, vec_id FROM p
    UNION
    SELECT e.d, reach.lab FROM reach JOIN e ON e.s = reach.v)
  SELECT v, min(lab) AS comp FROM reach GROUP BY v)),
sz AS (SELECT comp, count(*) AS n FROM r GROUP BY comp)
SELECT r.v AS vec_id, CAST(CASE WHEN sz.n >= {DENSITY_MIN} THEN r.comp ELSE -1 END AS BIGINT) AS cluster_id
FROM r JOIN sz ON r.comp = sz.comp""")
def q_density_clusters(spark, sf_dir):
    """Mutual-reachability graph at eps = 1.15 (min_samples = 3) -> connected components; components < 3 are noise."""
    from feedlens.operators import density
    return density.density_clusters(vecs(spark), "vec_id", DENSITY_EPS, DENSITY_MIN, block_size=256)


@query("embed_join", cte("v_aspects", "v_vectors") + f"""
SELECT a.seq, a.aspect, coalesce(CAST(len(x.v) AS INT), 0) AS dim, {r6(f"sqrt({SQDIST.format(a='CAST(x.v AS DOUBLE[])', b='[0.0 for _ in range(len(x.v))]')})")} AS norm
FROM v_aspects a LEFT JOIN v_vectors x ON x.vec_id = a.seq""")
def q_embed_join(spark, sf_dir):
    """Aspects get their vectors from a precomputed embeddings table, joined on the key."""
    from feedlens.functions import vectors as vf
    from feedlens.operators import embedding
    asp = spark.table("v_aspects").select("seq", "aspect")
    j = embedding.join_embeddings(asp, "seq", spark.table("embeddings"), "vec_id")
    return j.select("seq", "aspect", F.coalesce(F.array_size("v"), F.lit(0)).alias("dim"), vf.norm("v").alias("norm"))


@query("embed_hashing")
def q_embed_hashing(spark, sf_dir):
    """Spark-native text vectors (hashing TF-IDF, L2) for every comment: non-zeros and norm."""
    from feedlens.operators import embedding
    v = embedding.hashing_vectors(spark.table("v_comments"), "comment", num_features=1 << 12)
    values = F.col("sparse.values")  # the stored values of a sparse vector
    return v.select("comment_id", F.unwrap_udt("features").alias("sparse")).select(
        "comment_id", F.size(F.filter(values, lambda x: x != 0)).alias("nnz"),
        F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x)).alias("norm"))


@query("clustering_report")
def q_clustering_report(spark, sf_dir):
    """Nested one-row evaluation document as JSON: statistics, six rated sections, cost and verdict."""
    from feedlens.operators import reports
    return reports.clustering_report(aspect_rows(spark), vecs(spark), stored_insights(spark), spark.table("v_usage"))


@query("k_select")
def q_k_select(spark, sf_dir):
    """k-means for every k = 3..max(3, min(50, N // 3)), ten starts each, and its exact silhouette; the first best is selected."""
    scores, _, _ = clustering.kmeans_sweep(vecs(spark).select("vec_id", "v"), "vec_id")
    return scores


NEAR = 5


@query("nearest_neighbours", VEC_SQL + f"""
, dd AS (SELECT a.vec_id, b.vec_id AS other, sqrt({SQDIST.format(a='a.v', b='b.v')}) AS dist FROM p a, p b WHERE a.vec_id <> b.vec_id)
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY dist, other) AS INT) AS rank, other, {r6('dist')} AS dist FROM dd
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, other) <= {NEAR}""")
def q_nearest_neighbours(spark, sf_dir):
    """The five nearest other vectors of each vector, exact, by pivot cells."""
    from feedlens.operators import neighbours
    near, _ = neighbours.nearest(neighbours.cells(vecs(spark), "vec_id", block=256), NEAR)
    return near.select(F.col("id").alias("vec_id"), F.posexplode(F.arrays_zip("d", "other")).alias("p", "n")).select(
        "vec_id", (F.col("p") + 1).alias("rank"), F.col("n.other").alias("other"), F.col("n.d").alias("dist"))


@query("density_hierarchy")
def q_density_hierarchy(spark, sf_dir):
    """Density clusters by stability (spanning tree, condensed tree, at least 3 points) of every vector; noise is -1."""
    from feedlens.operators import hierarchy
    return hierarchy.hdbscan(vecs(spark), "vec_id", min_cluster_size=DENSITY_MIN)


@query("density_summary")
def q_density_summary(spark, sf_dir):
    """Number of density clusters and of noise points."""
    from feedlens.operators import hierarchy
    return hierarchy.summary(hierarchy.hdbscan(vecs(spark), "vec_id", min_cluster_size=DENSITY_MIN))


EPSILON, DELTA = 0.5, 0.1


def _uniform_sql(seed: int) -> str:
    key = f"CAST({seeded_key_sql('vec_id', seed)} AS BIGINT)"
    return f"((({key}) * ({key})) % {MODULUS} + 0.5::DOUBLE) / {MODULUS}"


@query("silhouette_sampled", VEC_SQL + f"""
, sz AS (SELECT cluster_id, count(*) AS n FROM p GROUP BY cluster_id),
tt AS (SELECT ceil(ln(4 * sum(n) * count(*) / {DELTA}::DOUBLE) / (2 * {EPSILON}::DOUBLE * {EPSILON}::DOUBLE)) AS t, count(*) AS k FROM sz),
f AS (SELECT p.vec_id, p.cluster_id, p.v FROM p JOIN sz ON sz.cluster_id = p.cluster_id, tt
      WHERE {_uniform_sql(42)} < 2 * ln(2 * tt.k / {DELTA}::DOUBLE) / sz.n),
fd AS (SELECT p.vec_id, p.cluster_id, f.vec_id AS e, sqrt({SQDIST.format(a='p.v', b='f.v')}) AS d
       FROM p JOIN f ON f.cluster_id = p.cluster_id),
fw AS (SELECT e, sum(d) AS w FROM fd GROUP BY e),
imp AS (SELECT vec_id, max(CASE WHEN w > 0 THEN d / w ELSE 0.0 END) AS share FROM fd JOIN fw ON fd.e = fw.e GROUP BY vec_id),
pr AS (SELECT p.vec_id, p.cluster_id, p.v, least(1.0, tt.t * greatest(1.0::DOUBLE / sz.n, coalesce(imp.share, 0.0))) AS pr
       FROM p JOIN sz ON sz.cluster_id = p.cluster_id LEFT JOIN imp ON imp.vec_id = p.vec_id, tt),
an AS (SELECT vec_id AS aid, cluster_id AS acid, v AS av, 1.0::DOUBLE / pr AS aw FROM pr WHERE {_uniform_sql(43)} < pr.pr),
d AS (SELECT p.vec_id, p.cluster_id AS own, an.acid AS other, sum(an.aw * sqrt({SQDIST.format(a='p.v', b='an.av')})) AS s
      FROM p, an GROUP BY p.vec_id, p.cluster_id, an.acid),
pp AS (SELECT d.vec_id, max(CASE WHEN other = own THEN s / (sz.n - 1) END) AS a, min(CASE WHEN other <> own THEN s / sz.n END) AS b
       FROM d JOIN sz ON sz.cluster_id = d.other GROUP BY d.vec_id),
ss AS (SELECT CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM pp)
SELECT {r6('avg(s)')} AS silhouette_estimate, count(*) AS n FROM ss""")
def q_silhouette_sampled(spark, sf_dir):
    """Estimated silhouette: every point against importance-weighted anchors of each cluster (epsilon 0.5)."""
    return quality.silhouette_sampled(vecs(spark), "vec_id", EPSILON, DELTA)
