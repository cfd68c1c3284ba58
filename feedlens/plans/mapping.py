"""Theme mapping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.functions import prompts, ratings
from feedlens.operators import completion, mapping, quality
from feedlens.plans.fixtures import cte
from feedlens.plans.registry import query, r6, shared_path
from feedlens.session import materialize
from feedlens.sources.files import flatten_themes

DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda t: t[1] * t[2]))"
COS = (f"CASE WHEN sqrt({DOT.format(a='{a}', b='{a}')}) * sqrt({DOT.format(a='{b}', b='{b}')}) = 0 THEN 0.0 "
       f"ELSE {DOT.format(a='{a}', b='{b}')} / (sqrt({DOT.format(a='{a}', b='{a}')}) * "
       f"sqrt({DOT.format(a='{b}', b='{b}')})) END")
TV_SQL = ("tv AS (SELECT t.theme_pos, t.theme, t.category, CAST(x.v AS DOUBLE[]) AS v "
          "FROM v_theme_vectors x JOIN v_themes t ON t.theme_pos = x.theme_pos)")


def cos(a: str, b: str) -> str:
    return COS.replace("{a}", a).replace("{b}", b)


def themes(spark):
    return spark.table("v_themes")


def theme_vectors(spark):
    return spark.table("v_theme_vectors").join(themes(spark), "theme_pos")


def mappings(spark):
    return spark.table("v_mappings")


def insights_df(spark):
    return spark.table("v_insights")


# ---------------------------------------------------------------- catalogue

@query("theme_flatten", cte("v_themes") + """
, f AS (SELECT category, min(theme_pos) AS first FROM v_themes GROUP BY category),
cp AS (SELECT category, CAST(row_number() OVER (ORDER BY first) - 1 AS INT) AS category_pos FROM f)
SELECT CAST(row_number() OVER (ORDER BY f.first, t.theme_pos) - 1 AS INT) AS theme_pos, t.theme, cp.category_pos,
       t.category
FROM v_themes t JOIN f ON t.category = f.category JOIN cp ON cp.category = t.category""")
def q_theme_flatten(spark, sf_dir):
    """Hierarchy document (categories -> themes) flattened back to ordered rows."""
    return flatten_themes(mapping.nest_themes(themes(spark)))


@query("render_theme_block", cte("v_themes") + """
, cats AS (SELECT category, min(theme_pos) AS first,
                  string_agg(concat('  - ', theme, chr(10)), '' ORDER BY theme_pos) AS lines
           FROM v_themes GROUP BY category)
SELECT concat('AVAILABLE THEMES AND CATEGORIES:', chr(10),
              string_agg(concat(chr(10), category, ':', chr(10), lines), '' ORDER BY first)) AS theme_block FROM cats""")
def q_render_theme_block(spark, sf_dir):
    return mapping.theme_block(themes(spark))


# ---------------------------------------------------------------- similarity

SIM_SQL = cte("v_vectors", "v_theme_vectors", "v_themes") + f""", {TV_SQL},
p AS (SELECT vec_id, CAST(v AS DOUBLE[]) AS v FROM v_vectors),
s AS (SELECT p.vec_id, tv.theme_pos, tv.theme, tv.category, {cos('p.v', 'tv.v')} AS sim FROM p, tv),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, theme_pos) AS rk FROM s)
"""


def ranked(spark):
    return mapping.top_k(spark.table("v_vectors").select("vec_id", "v"), theme_vectors(spark), "vec_id", 3)


@query("cosine_cross", SIM_SQL + f"SELECT vec_id, theme_pos, {r6('sim')} AS sim FROM s")
def q_cosine_cross(spark, sf_dir):
    """Every vector against every catalogue theme, block by block."""
    scores = mapping.theme_scores(spark.table("v_vectors").select("vec_id", "v"), theme_vectors(spark), "vec_id")
    return scores.select("vec_id", "theme_pos", "sim")


@query("topk_themes", SIM_SQL + f"SELECT vec_id, CAST(rk AS INT) AS rank, theme_pos, {r6('sim')} AS sim FROM r WHERE rk <= 3")
def q_topk_themes(spark, sf_dir):
    """Top-3 themes per vector, similarity descending, ties by catalogue position."""
    t = ranked(spark)
    return t.select("vec_id", F.posexplode("top_matches").alias("p", "m")).select(
        "vec_id", (F.col("p") + 1).alias("rank"), F.col("m.theme_pos").alias("theme_pos"),
        F.col("m.confidence").alias("sim"))


@query("primary_theme", SIM_SQL + f"SELECT vec_id, theme, category, {r6('sim')} AS confidence FROM r WHERE rk = 1")
def q_primary_theme(spark, sf_dir):
    m = ranked(spark).withColumn("best", F.element_at("top_matches", 1))
    return m.select("vec_id", F.col("best.theme").alias("theme"), F.col("best.category").alias("category"),
                    F.col("best.confidence").alias("confidence"))


@query("topk_margin", SIM_SQL + f"""
SELECT vec_id, {r6('max(CASE WHEN rk = 1 THEN sim END) - max(CASE WHEN rk = 2 THEN sim END)')} AS margin
FROM r WHERE rk <= 2 GROUP BY vec_id""")
def q_topk_margin(spark, sf_dir):
    """Gap between the best and second-best theme (is there a clear favourite?)."""
    t = ranked(spark)
    return t.select("vec_id", mapping.margin(t).alias("margin"))


SEM_SQL = cte("v_vectors", "v_theme_vectors", "v_themes", "v_insights") + f""", {TV_SQL},
e AS (SELECT cluster_id, unnest(CAST(v AS DOUBLE[])) AS x, generate_subscripts(v, 1) AS pos FROM v_vectors),
c AS (SELECT cluster_id, pos, avg(x) AS m FROM e GROUP BY cluster_id, pos),
cv AS (SELECT cluster_id, list(m ORDER BY pos) AS v FROM c GROUP BY cluster_id),
s AS (SELECT cv.cluster_id, tv.theme_pos, tv.theme, tv.category, {cos('cv.v', 'tv.v')} AS sim FROM cv, tv),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY sim DESC, theme_pos) AS rk FROM s),
sem AS (SELECT r1.cluster_id, r1.theme AS primary_theme, r1.category AS primary_category, r1.sim AS primary_confidence,
               r3.theme AS third_theme, r3.category AS third_category
        FROM r r1 JOIN r r3 ON r1.cluster_id = r3.cluster_id AND r3.rk = 3 WHERE r1.rk = 1)
"""


def semantic(spark):
    """Insight vector = centroid of its members; top-3 catalogue themes; rank 1 is the mapping."""
    cents = quality.centroids(spark.table("v_vectors")).withColumnRenamed("centroid", "v")
    named = cents.join(insights_df(spark).select("cluster_id", "cluster_name"), "cluster_id", "left")
    ranked = mapping.top_k(named, theme_vectors(spark), "cluster_id", 3)
    return mapping.primary_mapping(ranked, "cluster_id", "cluster_name")


@query("semantic_mapping", SEM_SQL + f"""
SELECT cluster_id, primary_theme, primary_category, {r6('primary_confidence')} AS primary_confidence FROM sem""")
def q_semantic_mapping(spark, sf_dir):
    return semantic(spark).select("cluster_id", "primary_theme", "primary_category", "primary_confidence")


LOW = 0.35


def _validation_prompt_sql() -> str:
    tpl = "'" + prompts.VALIDATION_TEMPLATE.replace("'", "''") + "'"
    sugg = (f"string_agg(concat('  ', CAST(rk AS VARCHAR), '. ', theme, ' (', category, '): ', "
            f"{prompts.fmt_sql('sim', 3)}), chr(10) ORDER BY rk)")
    return SEM_SQL + f"""
, sg AS (SELECT cluster_id, {sugg} AS suggestions FROM r WHERE rk <= 3 GROUP BY cluster_id),
cats AS (SELECT category, min(theme_pos) AS first,
                string_agg(concat('  - ', theme, chr(10)), '' ORDER BY theme_pos) AS lines FROM v_themes GROUP BY category),
blk AS (SELECT concat('AVAILABLE THEMES AND CATEGORIES:', chr(10),
                      string_agg(concat(chr(10), category, ':', chr(10), lines), '' ORDER BY first)) AS b FROM cats),
vp AS (SELECT sem.cluster_id,
              replace(replace(replace(replace(replace(replace(replace({tpl},
                 '{{cluster_id}}', CAST(sem.cluster_id AS VARCHAR)), '{{cluster_name}}', coalesce(i.cluster_name, '')),
                 '{{summary}}', coalesce(i.summary, '')), '{{primary_sentiment}}', coalesce(i.primary_sentiment, '')),
                 '{{key_themes}}', coalesce(i.key_themes, '')), '{{suggestions}}', sg.suggestions),
                 '{{theme_block}}', blk.b) AS prompt
       FROM sem JOIN sg ON sem.cluster_id = sg.cluster_id LEFT JOIN v_insights i ON i.cluster_id = sem.cluster_id, blk
       WHERE sem.primary_confidence < {LOW})
"""


def validation_requests(spark, sem=None):
    sem = semantic(spark) if sem is None else sem
    low = mapping.low_confidence(sem, LOW).select("cluster_id", "top_matches")
    return mapping.validation_prompts(low, insights_df(spark), mapping.theme_block(themes(spark)))


@query("render_validation_prompt", _validation_prompt_sql() + """
SELECT cluster_id, sha256(concat('stub-model', chr(1), prompt)) AS request_id, length(prompt) AS prompt_chars FROM vp""")
def q_render_validation_prompt(spark, sf_dir):
    """Validation prompt per low-confidence mapping: insight, ranked suggestions, catalogue."""
    return validation_requests(spark).select("cluster_id", "request_id",
                                             F.length("prompt").cast("long").alias("prompt_chars"))


REVIEW_SQL = SEM_SQL.replace("WITH ", cte("v_mappings").rstrip() + ",\n", 1) + f"""
, rv AS (SELECT sem.cluster_id, m.primary_theme AS theme, m.primary_category AS category, m.primary_confidence AS confidence
         FROM sem JOIN v_mappings m ON m.cluster_id = sem.cluster_id
         WHERE sem.primary_confidence < {LOW} AND m.primary_theme IS NOT NULL)
"""


@query("validate_stored", REVIEW_SQL + f"""
SELECT sem.cluster_id, coalesce(rv.theme, sem.primary_theme) AS primary_theme,
       coalesce(rv.category, sem.primary_category) AS primary_category,
       {r6("CASE WHEN rv.theme IS NOT NULL THEN rv.confidence ELSE sem.primary_confidence END")} AS primary_confidence,
       rv.theme IS NOT NULL AS validated
FROM sem LEFT JOIN rv ON rv.cluster_id = sem.cluster_id""")
def q_validate_stored(spark, sf_dir):
    """Low-confidence mappings reviewed by stored answers, which overlay the semantic mapping."""
    sem = materialize(semantic(spark), "semantic")  # computed once; feeds the prompts and the overlay
    req = validation_requests(spark, sem)
    done = completion.stored(req, spark.table("v_review_answers"), ["cluster_id"])
    val = mapping.parse_validations(req, done)
    out = mapping.overlay(sem, val)
    return out.select("cluster_id", "primary_theme", "primary_category", "primary_confidence", "validated")


@query("full_map_stored", cte("v_mappings", "v_insights") + f"""
SELECT i.cluster_id, m.primary_theme, m.primary_category, {r6("CAST(round(m.primary_confidence, 2) AS DOUBLE)")} AS primary_confidence,
       CASE WHEN m.primary_theme IS NULL THEN 'error' ELSE 'success' END AS status
FROM v_insights i JOIN v_mappings m ON m.cluster_id = i.cluster_id""")
def q_full_map_stored(spark, sf_dir):
    """Every cluster with a stored answer mapped from the catalogue; answers without a theme are error rows (L4)."""
    block = mapping.theme_block(themes(spark), prompts.FULL_MAPPING_BLOCK_HEADER)
    req = mapping.full_mapping_prompts(insights_df(spark), block)
    done = completion.stored(req, spark.table("v_theme_answers"), ["cluster_id"])
    out = mapping.parse_full_mappings(req, done)
    return out.select("cluster_id", "primary_theme", "primary_category", "primary_confidence", "status")


# ---------------------------------------------------------------- mapping evaluation over v_mappings

MAP_SQL = cte("v_mappings", "v_themes", "v_insights") + """
, ok AS (SELECT * FROM v_mappings WHERE status = 'success')
"""


@query("mapping_insight_join", MAP_SQL + """
SELECT m.cluster_id, m.primary_theme, i.cluster_name FROM v_mappings m JOIN v_insights i ON i.cluster_id = m.cluster_id""")
def q_mapping_insight_join(spark, sf_dir):
    """Mapping rows with their insight (inner lookup by cluster id)."""
    return mappings(spark).join(insights_df(spark), "cluster_id").select("cluster_id", "primary_theme", "cluster_name")


@query("theme_usage", MAP_SQL + "SELECT primary_theme AS theme, count(*) AS n FROM ok GROUP BY primary_theme")
def q_theme_usage(spark, sf_dir):
    return mapping.theme_usage(mappings(spark))


@query("category_usage", MAP_SQL + "SELECT primary_category AS category, count(*) AS n FROM ok GROUP BY primary_category")
def q_category_usage(spark, sf_dir):
    return mapping.category_usage(mappings(spark))


@query("theme_coverage", MAP_SQL + f"""
, u AS (SELECT count(DISTINCT primary_theme) AS themes_used, count(DISTINCT primary_category) AS categories_used FROM ok),
t AS (SELECT count(DISTINCT theme) AS themes_total, count(DISTINCT category) AS categories_total FROM v_themes)
SELECT themes_used, categories_used, themes_total, categories_total,
       {r6('100.0 * themes_used / themes_total')} AS coverage_pct,
       {ratings.ladder_sql('theme_coverage', r6('100.0 * themes_used / themes_total'), 'categories_used')} AS rating
FROM u, t""")
def q_theme_coverage(spark, sf_dir):
    c = mapping.theme_coverage(mappings(spark), themes(spark)).withColumn("coverage_pct", F.round("coverage_pct", 6))
    return c.withColumn("rating", ratings.rate("theme_coverage", "coverage_pct", "categories_used"))


@query("category_balance", MAP_SQL + f"""
, c AS (SELECT primary_category, 100.0 * count(*) / sum(count(*)) OVER () AS pct FROM ok GROUP BY primary_category),
b AS (SELECT max(pct) AS mx, min(pct) AS mn FROM c)
SELECT {r6('mx')} AS max_category_pct, {r6('mn')} AS min_category_pct,
       {r6('CASE WHEN mn > 0 THEN mx / mn ELSE 0.0 END')} AS balance_ratio,
       {ratings.ladder_sql('category_balance', r6('mx'), r6('mn'))} AS rating FROM b""")
def q_category_balance(spark, sf_dir):
    b = mapping.category_balance(mappings(spark))
    b = b.withColumn("max_category_pct", F.round("max_category_pct", 6)).withColumn(
        "min_category_pct", F.round("min_category_pct", 6))
    return b.withColumn("rating", ratings.rate("category_balance", "max_category_pct", "min_category_pct"))


@query("mapping_consistency", MAP_SQL + f"""
, u AS (SELECT primary_theme, count(*) AS n FROM ok GROUP BY primary_theme)
SELECT count(*) FILTER (WHERE n > 1) AS themes_with_multiple_clusters, count(*) AS total_themes_used,
       {r6('count(*) FILTER (WHERE n > 1) / count(*)')} AS consistency_score,
       {ratings.ladder_sql('consistency_score', r6('count(*) FILTER (WHERE n > 1) / count(*)'))} AS rating FROM u""")
def q_mapping_consistency(spark, sf_dir):
    c = mapping.mapping_consistency(mappings(spark)).withColumn("consistency_score", F.round("consistency_score", 6))
    return c.withColumn("rating", ratings.rate("consistency_score", "consistency_score"))


@query("theme_clusters", MAP_SQL + """
, u AS (SELECT primary_theme FROM ok GROUP BY primary_theme HAVING count(*) > 1)
SELECT ok.primary_theme AS theme, ok.cluster_id FROM ok JOIN u ON u.primary_theme = ok.primary_theme""")
def q_theme_clusters(spark, sf_dir):
    """Cluster ids of every theme that received more than one cluster."""
    return mapping.theme_clusters(mappings(spark))


@query("unused_themes", MAP_SQL + """
SELECT theme_pos, theme, category FROM v_themes WHERE theme NOT IN (SELECT primary_theme FROM ok)""")
def q_unused_themes(spark, sf_dir):
    return mapping.unused_themes(themes(spark), mappings(spark)).select("theme_pos", "theme", "category")


@query("themes_by_category", MAP_SQL + """
, u AS (SELECT primary_theme AS theme, count(*) AS n FROM ok GROUP BY primary_theme)
SELECT t.category, count(u.n) AS themes_used, CAST(coalesce(sum(u.n), 0) AS BIGINT) AS clusters, count(*) AS themes_total
FROM v_themes t LEFT JOIN u ON u.theme = t.theme GROUP BY t.category""")
def q_themes_by_category(spark, sf_dir):
    return mapping.themes_by_category(themes(spark), mappings(spark))


@query("sample_mappings", MAP_SQL + f"""
, t AS (SELECT *, row_number() OVER (ORDER BY primary_confidence DESC, cluster_id) AS rk FROM ok)
SELECT t.cluster_id, coalesce(i.cluster_name, 'N/A') AS cluster_name, t.primary_theme, t.primary_category,
       {r6('t.primary_confidence')} AS primary_confidence, CAST(t.rk AS INT) AS rank
FROM t LEFT JOIN v_insights i ON i.cluster_id = t.cluster_id WHERE t.rk <= 5""")
def q_sample_mappings(spark, sf_dir):
    """Five most confident mappings with the insight name, 'N/A' when there is none."""
    s = mapping.sample_mappings(mappings(spark), insights_df(spark), 5)
    return s.select("cluster_id", "cluster_name", "primary_theme", "primary_category", "primary_confidence",
                    F.col("rank").cast("int").alias("rank"))


@query("low_confidence", MAP_SQL + f"""
SELECT cluster_id, primary_theme, {r6('primary_confidence')} AS primary_confidence FROM ok WHERE primary_confidence < {LOW}""")
def q_low_confidence(spark, sf_dir):
    return mapping.low_confidence(mappings(spark), LOW).select("cluster_id", "primary_theme", "primary_confidence")


@query("numeric_ids", """
WITH k AS (SELECT CAST(s_suppkey AS VARCHAR) AS key FROM supplier UNION ALL SELECT s_name FROM supplier)
SELECT CAST(key AS INT) AS cluster_id FROM k WHERE regexp_matches(key, '^[0-9]+$')""")
def q_numeric_ids(spark, sf_dir):
    """String keys -> numeric ids only, cast and ordered numerically (non-numeric keys dropped)."""
    sup = spark.table("supplier")
    keys = sup.select(F.col("s_suppkey").cast("string").alias("key")).unionByName(sup.select(F.col("s_name").alias("key")))
    return keys.where(F.col("key").rlike("^[0-9]+$")).select(F.col("key").cast("int").alias("cluster_id")) \
        .orderBy("cluster_id")


@query("tier_lists", MAP_SQL + f"""
SELECT cluster_id, primary_theme, {r6('primary_confidence')} AS primary_confidence,
       CASE WHEN primary_confidence > 0.5 THEN 'high' WHEN primary_confidence >= 0.35 THEN 'medium' ELSE 'low' END AS tier
FROM ok""")
def q_tier_lists(spark, sf_dir):
    return mapping.tier_lists(mappings(spark)).select("cluster_id", "primary_theme", "primary_confidence", "tier")


@query("mapping_confidence", MAP_SQL + f"""
, s AS (SELECT avg(primary_confidence) AS mean, quantile_cont(primary_confidence, 0.5) AS median,
               stddev_pop(primary_confidence) AS std, min(primary_confidence) AS min, max(primary_confidence) AS max,
               count(*) FILTER (WHERE primary_confidence > 0.5) AS high,
               count(*) FILTER (WHERE primary_confidence >= 0.35 AND primary_confidence <= 0.5) AS medium,
               count(*) FILTER (WHERE primary_confidence < 0.35) AS low,
               100.0 * count(*) FILTER (WHERE primary_confidence > 0.5) / count(primary_confidence) AS high_pct FROM ok)
SELECT {r6('mean')} AS mean, {r6('median')} AS median, {r6('std')} AS std, {r6('min')} AS min, {r6('max')} AS max,
       high, medium, low, {r6('high_pct')} AS high_pct,
       {ratings.ladder_sql('mean_mapping_confidence', r6('mean'))} AS mean_rating,
       {ratings.ladder_sql('high_confidence_share_pct', r6('high_pct'))} AS tier_rating FROM s""")
def q_mapping_confidence(spark, sf_dir):
    """Confidence statistics, tier counts and both rating ladders for the mappings."""
    r = mapping.confidence_report(mappings(spark))
    r = r.withColumn("mean", F.round("mean", 6)).withColumn("high_pct", F.round("high_pct", 6))
    return (r.withColumn("mean_rating", ratings.rate("mean_mapping_confidence", "mean"))
            .withColumn("tier_rating", ratings.rate("high_confidence_share_pct", "high_pct")))


@query("overlay_validated", MAP_SQL + f"""
, v AS (SELECT ok.cluster_id, t.theme, t.category FROM ok JOIN v_themes t ON t.theme_pos = ok.cluster_id % 25
        WHERE ok.primary_confidence < {LOW})
SELECT ok.cluster_id, coalesce(v.theme, ok.primary_theme) AS primary_theme,
       coalesce(v.category, ok.primary_category) AS primary_category,
       {r6('CASE WHEN v.theme IS NOT NULL THEN 0.9 ELSE ok.primary_confidence END')} AS primary_confidence,
       v.theme IS NOT NULL AS validated
FROM ok LEFT JOIN v ON v.cluster_id = ok.cluster_id""")
def q_overlay_validated(spark, sf_dir):
    """Validations (derived from the catalogue) replace theme, category, confidence where present."""
    ok = mappings(spark).where(F.col("status") == "success").withColumn("reasoning", F.lit(None).cast("string")) \
        .withColumn("validated", F.lit(False))
    low = mapping.low_confidence(ok, LOW).select("cluster_id", (F.col("cluster_id") % 25).alias("theme_pos"))
    val = low.join(themes(spark), "theme_pos").select(
        "cluster_id", F.col("theme").alias("recommended_theme"), "category", F.lit(0.9).alias("confidence"),
        F.lit("reviewed").alias("rationale"))
    out = mapping.overlay(ok, val)
    return out.select("cluster_id", "primary_theme", "primary_category", "primary_confidence", "validated")


@query("insight_text", cte("v_insights") + """
SELECT cluster_id, concat(cluster_name, '. ', summary) AS insight_text FROM v_insights""")
def q_insight_text(spark, sf_dir):
    """The text embedded for an insight: ``name. summary``."""
    return insights_df(spark).select("cluster_id", prompts.insight_text("cluster_name", "summary").alias("insight_text"))


@query("mapping_report")
def q_mapping_report(spark, sf_dir):
    """Mapping evaluation document as JSON: confidence, tiers, coverage, balance, consistency, cost, samples and verdict."""
    from feedlens.operators import reports
    return reports.mapping_report(mappings(spark), themes(spark), insights_df(spark), spark.table("v_usage"))


@query("theme_distribution", MAP_SQL + """
SELECT 'themes' AS kind, primary_theme AS name, count(*) AS n FROM ok GROUP BY primary_theme
UNION ALL SELECT 'categories', primary_category, count(*) FROM ok GROUP BY primary_category""")
def q_theme_distribution(spark, sf_dir):
    """The distribution file written as JSON lines and read back (K6)."""
    from feedlens.operators import reports
    path = shared_path(spark, "distribution")
    reports.theme_distribution(mappings(spark)).write.json(path)
    return spark.read.schema("kind string, name string, n long").json(path)


@query("confidence_file", MAP_SQL + f"""
SELECT CASE WHEN primary_confidence > 0.5 THEN 'high' WHEN primary_confidence >= 0.35 THEN 'medium' ELSE 'low' END AS tier,
       cluster_id, primary_theme AS theme, {r6('primary_confidence')} AS confidence FROM ok
UNION ALL SELECT 'statistics', NULL, NULL, {r6('avg(primary_confidence)')} FROM ok""")
def q_confidence_file(spark, sf_dir):
    """The confidence file written as lines and read back: each mapping with its tier, and the mean of the statistics (K6)."""
    from feedlens.operators import reports
    path = shared_path(spark, "confidence")
    reports.confidence_file(mappings(spark)).write.json(path)
    back = spark.read.schema("tier string, json string").json(path)
    line = F.from_json("json", "cluster_id int, theme string, confidence double, mean double")
    return back.select("tier", line.alias("l")).select("tier", "l.cluster_id", "l.theme", F.coalesce("l.confidence", "l.mean").alias("confidence"))
