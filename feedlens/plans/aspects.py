"""Aspect analytics, ladders and verdict queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from feedlens.functions import ratings
from feedlens.operators import aspects, ledger, responses
from feedlens.plans.fixtures import EMPTY_OBJECT, cte
from feedlens.plans.registry import query, r6
from feedlens.plans.responses import ERR_A, parsed

STRIP_SQL = r"regexp_replace({t}, '^\s+|\s+$', '', 'g')"
KEY_SQL = "lower(" + STRIP_SQL.format(t="aspect") + ")"
ASPECTS_SQL = cte("v_aspects") + """
, a AS (SELECT seq, comment_id, aspect, sentiment, coalesce(evidence, '') AS evidence,
               coalesce(confidence, 0.5) AS confidence, cluster_id FROM v_aspects)
"""


def aspect_rows(spark):
    """Flattened aspects with the loader's defaults (evidence '', confidence 0.5)."""
    return (spark.table("v_aspects")
            .withColumn("evidence", F.coalesce("evidence", F.lit("")))
            .withColumn("confidence", F.coalesce("confidence", F.lit(0.5))))


@query("confidence_stats", ASPECTS_SQL + f"""
SELECT count(confidence) AS n, {r6('avg(confidence)')} AS mean, {r6('quantile_cont(confidence, 0.5)')} AS median,
       {r6('stddev_pop(confidence)')} AS std, {r6('min(confidence)')} AS min, {r6('max(confidence)')} AS max FROM a""")
def q_confidence_stats(spark, sf_dir):
    return aspects.confidence_stats(aspect_rows(spark))


@query("confidence_tiers", ASPECTS_SQL + f"""
SELECT {r6('100.0 * count(*) FILTER (WHERE confidence > 0.80) / count(confidence)')} AS high_pct,
       {r6('100.0 * count(*) FILTER (WHERE confidence >= 0.60 AND confidence <= 0.80) / count(confidence)')} AS medium_pct,
       {r6('100.0 * count(*) FILTER (WHERE confidence < 0.60) / count(confidence)')} AS low_pct,
       count(*) FILTER (WHERE confidence > 0.5) AS high_n,
       count(*) FILTER (WHERE confidence >= 0.35 AND confidence <= 0.5) AS medium_n,
       count(*) FILTER (WHERE confidence < 0.35) AS low_n FROM a""")
def q_confidence_tiers(spark, sf_dir):
    return aspects.confidence_tiers(aspect_rows(spark))


@query("aspects_per_comment", cte("v_aspects") + f"""
, ids AS (SELECT comment_id, count(*) AS n FROM v_aspects GROUP BY comment_id),
s AS (SELECT CASE WHEN {EMPTY_OBJECT} THEN 0 ELSE n END AS k FROM ids WHERE NOT {ERR_A})
SELECT count(k) AS total_comments, {r6('avg(k)')} AS mean_aspects, {r6('quantile_cont(k, 0.5)')} AS median_aspects,
       {r6('stddev_pop(k)')} AS std_dev, CAST(min(k) AS INT) AS min_aspects, CAST(max(k) AS INT) AS max_aspects FROM s""")
def q_aspects_per_comment(spark, sf_dir):
    """Aspects per successful comment; an empty object counts as 0."""
    ok = parsed(spark).where(F.col("status") == "success")
    return aspects.aspects_per_comment(ok, "num_aspects")


@query("sentiment_distribution", ASPECTS_SQL + f"""
SELECT sentiment, count(*) AS n, {r6('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct FROM a GROUP BY sentiment""")
def q_sentiment_distribution(spark, sf_dir):
    return aspects.sentiment_distribution(aspect_rows(spark))


@query("top_aspects", ASPECTS_SQL + """
, c AS (SELECT aspect, count(*) AS n, min(seq) AS first_seq FROM a GROUP BY aspect)
SELECT aspect, n, CAST(rk AS INT) AS rank FROM (
  SELECT aspect, n, row_number() OVER (ORDER BY n DESC, first_seq) AS rk FROM c) WHERE rk <= 20""")
def q_top_aspects(spark, sf_dir):
    """Top-20 raw aspect strings by count, ties by first appearance."""
    return aspects.top_k_by_count(aspect_rows(spark), "aspect", 20).select("aspect", "n", "rank")


@query("dedup_potential", ASPECTS_SQL + f"""
SELECT count(*) AS total_aspects, count(DISTINCT {KEY_SQL}) AS unique_aspects,
       {r6(f'(1.0 - count(DISTINCT {KEY_SQL}) / count(*)) * 100.0')} AS duplicate_pct,
       {r6(f'1.0 - (1.0 - count(DISTINCT {KEY_SQL}) / count(*))')} AS redundancy_ratio FROM a""")
def q_dedup_potential(spark, sf_dir):
    return aspects.dedup_potential(aspect_rows(spark))


DEDUP_SQL = ASPECTS_SQL + f"""
, r AS (SELECT *, {KEY_SQL} AS dedup_key,
               row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY confidence DESC, seq) AS rn FROM a)
"""


@query("dedup_keep_best", DEDUP_SQL + f"""
SELECT dedup_key, seq, aspect, sentiment, {r6('confidence')} AS confidence FROM r WHERE rn = 1""")
def q_dedup_keep_best(spark, sf_dir):
    """Per lower+strip key keep the most confident aspect; the first seen wins ties."""
    best = aspects.dedup_keep_best(aspect_rows(spark))
    return best.select("dedup_key", "seq", "aspect", "sentiment", "confidence")


@query("normalize_names", DEDUP_SQL + """
SELECT dedup_key, replace(lower(""" + STRIP_SQL.format(t="aspect") + """), 'the ', '') AS aspect FROM r WHERE rn = 1""")
def q_normalize_names(spark, sf_dir):
    """Dedup, then strip + lower + drop every 'the ' (reference order; names may collide again)."""
    best = aspects.dedup_keep_best(aspect_rows(spark))
    return aspects.normalize_names(best).select("dedup_key", "aspect")


@query("top_aspect_sentiment", ASPECTS_SQL + f"""
, c AS (SELECT aspect, count(*) AS n, min(seq) AS first_seq FROM a GROUP BY aspect),
t AS (SELECT aspect, CAST(row_number() OVER (ORDER BY n DESC, first_seq) AS INT) AS rank FROM c
      QUALIFY rank <= 10),
x AS (SELECT a.aspect, a.sentiment, count(*) AS n FROM a JOIN t ON a.aspect = t.aspect GROUP BY a.aspect, a.sentiment)
SELECT x.aspect, x.sentiment, x.n, {r6('100.0 * x.n / sum(x.n) OVER (PARTITION BY x.aspect)')} AS row_pct, t.rank
FROM x JOIN t ON x.aspect = t.aspect""")
def q_top_aspect_sentiment(spark, sf_dir):
    """Sentiment cross-tab (long form, with row %) for the 10 most frequent aspects."""
    return aspects.top_aspect_sentiment(aspect_rows(spark), 10)


LARGEST_SQL = """
, big AS (SELECT cluster_id FROM a GROUP BY cluster_id ORDER BY count(*) DESC, cluster_id LIMIT 1),
m AS (SELECT a.* FROM a JOIN big ON a.cluster_id = big.cluster_id)
"""


def largest_cluster(df):
    row = df.groupBy("cluster_id").count().orderBy(F.desc("count"), "cluster_id").first()
    return row["cluster_id"]


@query("cluster_drilldown", ASPECTS_SQL + LARGEST_SQL + f"""
, o AS (SELECT confidence, row_number() OVER (ORDER BY confidence) AS rn, count(*) OVER () AS n FROM m)
SELECT (SELECT cluster_id FROM big) AS cluster_id, count(*) AS size, {r6('avg(confidence)')} AS mean_confidence,
       {r6('min(confidence)')} AS min_confidence, {r6('max(confidence)')} AS max_confidence,
       {r6('(SELECT confidence FROM o WHERE rn = n // 2 + 1)')} AS upper_median_confidence
FROM m""")
def q_cluster_drilldown(spark, sf_dir):
    """The largest cluster: size and confidence mean/min/max/upper median (sorted[n // 2])."""
    df = aspect_rows(spark)
    return aspects.cluster_drilldown(df, largest_cluster(df)).select(
        "cluster_id", "size", "mean_confidence", "min_confidence", "max_confidence", "upper_median_confidence")


@query("cluster_top_aspects", ASPECTS_SQL + LARGEST_SQL + """
, c AS (SELECT aspect, count(*) AS n, min(seq) AS first_seq FROM m GROUP BY aspect)
SELECT aspect, n, CAST(rk AS INT) AS rank FROM (
  SELECT aspect, n, row_number() OVER (ORDER BY n DESC, first_seq) AS rk FROM c) WHERE rk <= 30""")
def q_cluster_top_aspects(spark, sf_dir):
    """Top-30 aspects inside the largest cluster."""
    df = aspect_rows(spark)
    one = df.where(F.col("cluster_id") == largest_cluster(df))
    return aspects.top_k_by_count(one, "aspect", 30).select("aspect", "n", "rank")


@query("cluster_sentiment_pct", ASPECTS_SQL + LARGEST_SQL + f"""
SELECT sentiment, count(*) AS n, {r6("100.0 * count(*) / sum(count(*)) OVER ()")} AS pct FROM m GROUP BY sentiment""")
def q_cluster_sentiment_pct(spark, sf_dir):
    """Sentiment counts and shares of the largest cluster."""
    df = aspect_rows(spark)
    one = df.where(F.col("cluster_id") == largest_cluster(df)).groupBy("sentiment").agg(F.count("*").alias("n"))
    # a window over one row per sentiment
    return one.withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()))


@query("cluster_aspect_sentiment", ASPECTS_SQL + LARGEST_SQL + f"""
, c AS (SELECT aspect, count(*) AS n, min(seq) AS first_seq FROM m GROUP BY aspect),
t AS (SELECT aspect, CAST(row_number() OVER (ORDER BY n DESC, first_seq) AS INT) AS rank FROM c QUALIFY rank <= 10),
x AS (SELECT m.aspect, m.sentiment, count(*) AS n FROM m JOIN t ON m.aspect = t.aspect GROUP BY m.aspect, m.sentiment)
SELECT x.aspect, x.sentiment, x.n, {r6('100.0 * x.n / sum(x.n) OVER (PARTITION BY x.aspect)')} AS row_pct, t.rank
FROM x JOIN t ON x.aspect = t.aspect""")
def q_cluster_aspect_sentiment(spark, sf_dir):
    """Sentiment of the ten most frequent aspects of the largest cluster."""
    df = aspect_rows(spark)
    return aspects.top_aspect_sentiment(df.where(F.col("cluster_id") == largest_cluster(df)), 10)


@query("cluster_sentiment", ASPECTS_SQL + """
SELECT cluster_id, sentiment, count(*) AS n FROM a GROUP BY cluster_id, sentiment""")
def q_cluster_sentiment(spark, sf_dir):
    """Sentiment counts per cluster (long form of the per-cluster sentiment map)."""
    return aspect_rows(spark).groupBy("cluster_id", "sentiment").agg(F.count("*").alias("n"))


@query("sentiment_rollup", ASPECTS_SQL + """
SELECT sentiment, count(*) AS n FROM a GROUP BY sentiment""")
def q_sentiment_rollup(spark, sf_dir):
    """Per-cluster sentiment maps rolled back up into overall counts."""
    maps = (aspect_rows(spark).groupBy("cluster_id", "sentiment").agg(F.count("*").alias("n"))
            .groupBy("cluster_id").agg(F.map_from_entries(F.collect_list(F.struct("sentiment", "n")))
                                       .alias("sentiments")))
    return aspects.sentiment_rollup(maps)


@query("final_summary", cte("v_aspects") + f"""
, ok AS (SELECT *, coalesce(confidence, 0.5) AS c FROM v_aspects WHERE NOT ({ERR_A} OR {EMPTY_OBJECT})),
ids AS (SELECT DISTINCT comment_id FROM v_aspects WHERE NOT {ERR_A})
SELECT count(*) AS total_aspects, count(DISTINCT aspect) AS unique_aspects, {r6('avg(c)')} AS avg_confidence,
       {r6("100.0 * count(*) FILTER (WHERE sentiment = 'positive') / count(*)")} AS positive_pct,
       {r6("100.0 * count(*) FILTER (WHERE sentiment = 'negative') / count(*)")} AS negative_pct,
       {r6("100.0 * count(*) FILTER (WHERE sentiment = 'neutral') / count(*)")} AS neutral_pct,
       (SELECT count(*) FROM ids) AS total_comments,
       {r6('count(*) / (SELECT count(*) FROM ids)')} AS avg_aspects_per_comment
FROM ok""")
def q_final_summary(spark, sf_dir):
    p = parsed(spark)
    ex = responses.explode_aspects(p, ["comment_id"])
    return aspects.final_summary(ex, p.where(F.col("status") == "success"))


def _cost_sql(expr: str) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR)::DECIMAL(38,18), 4) AS DOUBLE)"


@query("cost_efficiency", cte("v_usage", "v_aspects") + f"""
, c AS (SELECT {_cost_sql('sum(input_tokens) * (0.8 / 1000000.0) + sum(output_tokens) * (4.0 / 1000000.0)')} AS total_cost_usd,
               count(*) AS n_comments FROM v_usage),
k AS (SELECT count(*) AS n_aspects, count(DISTINCT cluster_id) AS n_clusters FROM v_aspects)
SELECT {r6('total_cost_usd')} AS total_cost_usd, {r6('total_cost_usd / n_comments')} AS cost_per_comment,
       {r6('total_cost_usd / n_aspects')} AS cost_per_aspect, {r6('total_cost_usd / n_clusters')} AS cost_per_cluster,
       {r6('total_cost_usd / 20.0 * 100.0')} AS budget_used_pct, {r6('20.0 - total_cost_usd')} AS budget_remaining
FROM c, k""")
def q_cost_efficiency(spark, sf_dir):
    """Cost per comment / aspect / cluster, share of the $20 budget used, remaining budget."""
    usage = spark.table("v_usage").select(F.lit(True).alias("_u"), "input_tokens", "output_tokens",
                                          F.lit(None).cast("int").alias("cluster_id"))
    asp = spark.table("v_aspects").select(F.lit(False).alias("_u"), F.lit(None).cast("long").alias("input_tokens"),
                                          F.lit(None).cast("long").alias("output_tokens"), "cluster_id")
    u = F.col("_u")
    totals = usage.unionByName(asp).agg(  # one pass over both tables, no join of one-row frames
        F.sum(F.when(u, F.col("input_tokens"))).cast("long").alias("input_tokens"),
        F.sum(F.when(u, F.col("output_tokens"))).cast("long").alias("output_tokens"),
        F.count_if(u).alias("n_comments"), F.count_if(~u).alias("n_aspects"),
        F.countDistinct(F.when(~u, F.col("cluster_id"))).alias("n_clusters"))
    return ledger.cost_efficiency(ledger.priced(totals))


# Value domains used to sweep each ladder across its thresholds: x (and y) as SQL over
# c = a mapping confidence in [0, 1) and d = a second pseudo-uniform value in [0, 1).
LADDER_INPUTS = {
    "extraction_success_rate": ("c", None),
    "mean_aspect_confidence": ("c", None),
    "mean_aspects_per_comment": ("c * 8", None),
    "sentiment_balance": ("c * 100", "d * 60"),
    "duplicate_pct": ("c * 60", None),
    "cost_per_comment": ("c * 0.03", None),
    "silhouette": ("c * 2 - 1", None),
    "davies_bouldin": ("c * 4", None),
    "size_ratio": ("c * 25", None),
    "mean_dominant_sentiment_pct": ("c * 100", None),
    "cluster_coverage_pct": ("80 + c * 25", None),
    "interpretability_rate": ("c", None),
    "mean_mapping_confidence": ("c", None),
    "high_confidence_share_pct": ("c * 100", None),
    "theme_coverage": ("c * 100", "CAST(cluster_id % 6 AS DOUBLE)"),
    "category_balance": ("c * 100", "d * 20"),
    "consistency_score": ("c", None),
    "cost_per_cluster": ("c * 0.3", None),
    "coherence_label": ("c * 2 - 1", None),
}
BASE_SQL = ("SELECT cluster_id, primary_confidence AS c, ((cluster_id * 7) % 100) / 1e2 AS d "
            "FROM v_mappings WHERE status = 'success'")


def _ladder_sql() -> str:
    parts = []
    for m, (x, y) in LADDER_INPUTS.items():
        yy = y or "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{m}' AS metric, cluster_id, {x} AS x, {yy} AS y FROM base")
    union = "\nUNION ALL\n".join(parts)
    cases = " ".join(f"WHEN metric = '{m}' THEN {ratings.ladder_sql(m, 'x', 'y')}" for m in LADDER_INPUTS)
    return (cte("v_mappings") + f", base AS ({BASE_SQL}), v AS ({union})\n"
            f"SELECT metric, cluster_id, {r6('x')} AS x, {r6('y')} AS y, CASE {cases} END AS rating FROM v")


def ladder_values(spark):
    """One scan of the mapping rows; each row expands to one (metric, x, y) item per ladder."""
    base = spark.sql(BASE_SQL)
    items = F.array(*[F.struct(F.lit(m).alias("metric"), F.expr(x).cast("double").alias("x"),
                               (F.expr(y) if y else F.lit(None)).cast("double").alias("y"))
                      for m, (x, y) in LADDER_INPUTS.items()])
    ex = base.select("cluster_id", F.explode(items).alias("it")).select("cluster_id", "it.*")
    case = "CASE " + " ".join(f"WHEN metric = '{m}' THEN {ratings.ladder_sql(m, 'x', 'y')}" for m in LADDER_INPUTS) + " END"
    return ex.withColumn("rating", F.expr(case)).select("metric", "cluster_id", "x", "y", "rating")


@query("rating_ladders")
def q_rating_ladders(spark, sf_dir):
    """Every rating ladder swept across its thresholds (first matching rung wins)."""
    return ladder_values(spark)


STAGE_OF = {m: s for s, ms in ratings.STAGE_METRICS.items() for m in ms}


def _verdict_sql() -> str:
    stage_case = "CASE " + " ".join(f"WHEN metric = '{m}' THEN '{s}'" for m, s in STAGE_OF.items()) + " END"
    verdict_case = "CASE " + " ".join(
        f"WHEN stage = '{s}' THEN {ratings.verdict_sql(s, 'n_excellent', 'n_good')}" for s in ratings.VERDICT_RULES) + " END"
    body = _ladder_sql().split("\nSELECT metric, cluster_id, ")[0]
    cases = " ".join(f"WHEN metric = '{m}' THEN {ratings.ladder_sql(m, 'x', 'y')}" for m in LADDER_INPUTS)
    return body + f""",
r AS (SELECT metric, cluster_id, CASE {cases} END AS rating FROM v),
s AS (SELECT cluster_id, {stage_case} AS stage, rating FROM r
      UNION ALL SELECT DISTINCT cluster_id, 'mapping', 'EXCELLENT' FROM base),
g AS (SELECT cluster_id, stage, count(*) FILTER (WHERE rating = 'EXCELLENT') AS n_excellent,
             count(*) FILTER (WHERE rating = 'GOOD') AS n_good, count(*) AS n_ratings
      FROM s WHERE stage IS NOT NULL GROUP BY cluster_id, stage)
SELECT cluster_id, stage, n_excellent, n_good, n_ratings, {verdict_case} AS verdict FROM g"""


@query("overall_verdict")
def q_overall_verdict(spark, sf_dir):
    """Stage verdicts from sub-ratings (business-logic rating supplied as EXCELLENT, as the reference)."""
    r = ladder_values(spark)
    stage = None
    for m, s in STAGE_OF.items():
        stage = F.when(F.col("metric") == m, s) if stage is None else stage.when(F.col("metric") == m, s)
    rated = r.select("cluster_id", stage.alias("stage"), "rating")
    business = (spark.sql(BASE_SQL).select("cluster_id").distinct()
                .select("cluster_id", F.lit("mapping").alias("stage"), F.lit(ratings.EXCELLENT).alias("rating")))
    allr = rated.unionByName(business).where(F.col("stage").isNotNull())
    return ratings.overall_verdict(allr, ["cluster_id"]).select(
        "cluster_id", "stage", "n_excellent", "n_good", "n_ratings", "verdict")


def _register_sql_oracles():
    from feedlens.plans.registry import CHECK, ORACLE
    ORACLE["rating_ladders"] = _ladder_sql()
    ORACLE["overall_verdict"] = _verdict_sql()
    CHECK["rating_ladders"] = CHECK["overall_verdict"] = "O"


_register_sql_oracles()


@query("extraction_report")
def q_extraction_report(spark, sf_dir):
    """Extraction evaluation document (success, confidence, granularity, balance, dedup, cost) as JSON."""
    from feedlens.operators import reports
    p = parsed(spark)
    ex = responses.explode_aspects(p, ["comment_id"])
    return reports.extraction_report(p, ex, ledger.cost_summary(spark.table("v_usage")))


def _apc_values_sql() -> str:
    return (cte("v_aspects") + f", ids AS (SELECT comment_id, count(*) AS n FROM v_aspects GROUP BY comment_id) "
            f"SELECT CASE WHEN {EMPTY_OBJECT} THEN 0 ELSE n END AS x FROM ids WHERE NOT {ERR_A}")


def _conf_values_sql() -> str:
    return cte("v_aspects") + "SELECT coalesce(confidence, 0.5) AS x FROM v_aspects"


def _box_sql(values_sql: str) -> str:
    return f"""
WITH p AS (SELECT CAST(x AS DOUBLE) AS x FROM ({values_sql})),
q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM p)
SELECT {r6('q1')} AS q1, {r6('median')} AS median, {r6('q3')} AS q3, {r6('q3 - q1')} AS iqr,
       {r6('min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END)')} AS whisker_lo,
       {r6('max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END)')} AS whisker_hi,
       count(CASE WHEN x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers,
       count(x) AS n
FROM p, q GROUP BY q1, median, q3"""


def _hist(values_sql: str, n: int) -> str:
    from feedlens.plans.corpus import hist_sql
    return hist_sql(values_sql, n)


def apc_values(spark):
    return parsed(spark).where(F.col("status") == "success").select("num_aspects")


@query("confidence_histogram", _hist(_conf_values_sql(), 30))
def q_confidence_histogram(spark, sf_dir):
    """Aspect confidence, 30 equal-width bins."""
    from feedlens.operators import profile
    return profile.equal_width_histogram(aspect_rows(spark), "confidence", 30)


@query("confidence_boxplot", _box_sql(_conf_values_sql()))
def q_confidence_boxplot(spark, sf_dir):
    from feedlens.operators import profile
    return profile.boxplot_summary(aspect_rows(spark), "confidence")


@query("apc_histogram", _hist(_apc_values_sql(), 20))
def q_apc_histogram(spark, sf_dir):
    """Aspects per successful comment, 20 equal-width bins."""
    from feedlens.operators import profile
    return profile.equal_width_histogram(apc_values(spark), "num_aspects", 20)


@query("apc_boxplot", _box_sql(_apc_values_sql()))
def q_apc_boxplot(spark, sf_dir):
    from feedlens.operators import profile
    return profile.boxplot_summary(apc_values(spark), "num_aspects")


@query("cluster_size_histogram", _hist(cte("v_aspects") + "SELECT count(*) AS x FROM v_aspects GROUP BY cluster_id", 15))
def q_cluster_size_histogram(spark, sf_dir):
    """Cluster sizes, 15 equal-width bins."""
    from feedlens.operators import profile, quality
    return profile.equal_width_histogram(quality.cluster_sizes(aspect_rows(spark)), "size", 15)
