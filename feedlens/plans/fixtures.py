"""Fixture views that carry the reference's shapes onto the driver tables.

Each view is one SQL text that runs unchanged in Spark SQL and in DuckDB, so
the Spark query and its oracle start from identical inputs.  Spark-only
fixtures (LLM response text rendered with ``to_json``) are marked as such.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Flattened aspects: dirty case, leading space, 'The ', NULL confidence, a few 'mixed'.
V_ASPECTS = """
SELECT event_id AS seq, user_id AS comment_id,
       concat(CASE WHEN event_id % 3 = 0 THEN ' The ' ELSE '' END, event_type, ' topic ',
              CAST(user_id % 20 AS STRING)) AS aspect,
       CASE WHEN event_id % 997 = 0 THEN 'mixed' WHEN event_type IN ('purchase','signup') THEN 'positive'
            WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END AS sentiment,
       props AS evidence,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE least(value, 1e2) / 1e2 END AS confidence,
       CAST(user_id % 38 AS INT) AS cluster_id
FROM events
"""

# Two-level theme hierarchy, 5 categories x 5 themes.
V_THEMES = """
SELECT n_nationkey AS theme_pos, n_name AS theme, r_name AS category
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

# Cluster -> theme mappings, some error rows without a theme.
V_MAPPINGS = """
SELECT CAST(s_suppkey AS INT) AS cluster_id,
       CASE WHEN s_suppkey % 33 <> 32 THEN n_name END AS primary_theme,
       CASE WHEN s_suppkey % 33 <> 32 THEN r_name END AS primary_category,
       CASE WHEN s_suppkey % 33 <> 32 THEN (s_suppkey % 100) / 1e2 END AS primary_confidence,
       CASE WHEN s_suppkey % 33 = 32 THEN 'error' ELSE 'success' END AS status
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

# 64-d unit vectors; label stands in for a cluster id.
V_VECTORS = "SELECT vec_id, embedding AS v, label AS cluster_id FROM embeddings"
# Every theme has the vector of the embedding with its position as id.
V_THEME_VECTORS = ("SELECT n_nationkey AS theme_pos, embedding AS v FROM nation JOIN embeddings "
                   "ON vec_id = n_nationkey")

# Token usage per request, 50 requests per batch.
V_USAGE = """
SELECT doc_id AS seq, CAST(floor(doc_id / 5e1) AS BIGINT) AS batch_no, n_chars AS input_tokens,
       CAST(floor(n_chars / 4e0) AS BIGINT) AS output_tokens
FROM documents
"""

# Comments: the documents table is the comment corpus.
V_COMMENTS = "SELECT doc_id AS comment_id, text AS comment FROM documents"

# Cluster insights derived from the aspects of each cluster (portable SQL).
V_INSIGHTS = """
SELECT cluster_id,
       concat('cluster ', CAST(cluster_id AS STRING)) AS cluster_name,
       concat(CAST(count(*) AS STRING), ' aspects, ',
              CAST(count(DISTINCT comment_id) AS STRING), ' comments') AS summary,
       CASE WHEN 2 * sum(CASE WHEN sentiment = 'positive' THEN 1 ELSE 0 END) > count(*) THEN 'positive'
            WHEN 2 * sum(CASE WHEN sentiment = 'negative' THEN 1 ELSE 0 END) > count(*) THEN 'negative'
            ELSE 'mixed' END AS primary_sentiment,
       concat(trim(min(aspect)), ', ', trim(max(aspect))) AS key_themes
FROM v_aspects GROUP BY cluster_id
"""

# Stored model answers.  Insight per cluster: the insight rendered as fenced JSON, cut short for some clusters.
V_INSIGHT_ANSWERS = """
SELECT cluster_id, CASE WHEN cluster_id % 7 = 3 THEN substring(t, 1, 60) ELSE t END AS text
FROM (SELECT cluster_id, concat('```json', chr(10), '{"cluster_name": "', cluster_name, '", "summary": "', summary,
             '", "primary_sentiment": "', primary_sentiment, '", "key_themes": ["', key_themes,
             '"], "business_impact": null}', chr(10), '```') AS t FROM v_insights) x
"""
# Theme per cluster: the mapping rendered as JSON; clusters without a theme got an answer without that key.
V_THEME_ANSWERS = """
SELECT cluster_id,
       CASE WHEN primary_theme IS NULL THEN '{"category": "none", "confidence": 0.1, "reasoning": "no theme fits"}'
            ELSE concat('{"theme": "', primary_theme, '", "category": "', primary_category, '", "confidence": ',
                        printf('%.2f', primary_confidence), ', "reasoning": "stored answer"}') END AS text
FROM v_mappings
"""
# Review of low-confidence mappings: the same themes as recommendations; no decision where there is no theme.
V_REVIEW_ANSWERS = """
SELECT cluster_id,
       CASE WHEN primary_theme IS NULL THEN 'I am not able to decide on a theme.'
            ELSE concat('```json', chr(10), '{"recommended_theme": "', primary_theme, '", "category": "',
                        primary_category, '", "confidence": ', printf('%.2f', primary_confidence),
                        ', "rationale": "stored review"}', chr(10), '```') END AS text
FROM v_mappings
"""

# Which rendered responses are deliberately broken (fixed values of the fixture):
#   comment_id % 23 = 7  -> chatter after the closing fence (variant A rejects, B accepts)
#   comment_id % 29 = 11 -> body cut in half (both reject)
#   comment_id % 31 = 13 -> top-level array instead of an object (both reject)
#   comment_id % 37 = 17 -> empty object {} (success with 0 aspects)
MALFORMED_TRAILING = "comment_id % 23 = 7"
MALFORMED_TRUNCATED = "comment_id % 29 = 11"
MALFORMED_ARRAY = "comment_id % 31 = 13"
EMPTY_OBJECT = "comment_id % 37 = 17"

# LLM response text per comment: the comment's aspects rendered as a JSON object,
# fenced in one of three styles, with the breakages above injected.  Built with
# plain string functions so Spark and DuckDB produce byte-identical text; only
# the ordered string aggregate differs by dialect ({agg}).
SPARK_ITEMS_AGG = ("array_join(transform(array_sort(collect_list(named_struct('s', seq, 'i', item))), "
                   "x -> x.i), ', ')")
DUCK_ITEMS_AGG = "string_agg(item, ', ' ORDER BY seq)"
V_RESPONSES = f"""
WITH a AS (
  SELECT comment_id, seq,
         concat('{{"aspect": "', aspect, '", "sentiment": "', sentiment, '", "evidence": "',
                replace(evidence, '"', concat(chr(92), '"')), '"',
                CASE WHEN confidence IS NULL THEN '' ELSE concat(', "confidence": ', printf('%.4f', confidence)) END,
                '}}') AS item
  FROM v_aspects
), g AS (
  SELECT comment_id, concat('{{"aspects": [', {{agg}}, ']}}') AS body FROM a GROUP BY comment_id
), b AS (
  SELECT comment_id,
         CASE WHEN {MALFORMED_TRUNCATED} THEN substring(body, 1, CAST(floor(length(body) / 2) AS INT))
              WHEN {MALFORMED_ARRAY} THEN concat('[', body, ']')
              WHEN {EMPTY_OBJECT} THEN '{{}}'
              ELSE body END AS body
  FROM g
)
SELECT comment_id,
       concat(CASE WHEN comment_id % 3 = 0 THEN concat('```json', chr(10), body, chr(10), '```')
                   WHEN comment_id % 3 = 1 THEN concat('```', chr(10), body, chr(10), '```')
                   ELSE concat('  ', body, chr(10)) END,
              CASE WHEN {MALFORMED_TRAILING} THEN ' Let me know if you need anything else.' ELSE '' END)
         AS response_text
FROM b
"""

VIEWS = {
    "v_aspects": V_ASPECTS,
    "v_themes": V_THEMES,
    "v_mappings": V_MAPPINGS,
    "v_vectors": V_VECTORS,
    "v_theme_vectors": V_THEME_VECTORS,
    "v_usage": V_USAGE,
    "v_comments": V_COMMENTS,
    "v_insights": V_INSIGHTS,
    "v_insight_answers": V_INSIGHT_ANSWERS,
    "v_theme_answers": V_THEME_ANSWERS,
    "v_review_answers": V_REVIEW_ANSWERS,
}


_REGISTERED: WeakKeyDictionary[SparkSession, str] = WeakKeyDictionary()


def register(spark: SparkSession, sf_dir: str) -> None:
    """Register the base tables and the fixture views as temp views (lazy parquet scans).

    Registration is remembered per session and directory; switching the
    directory re-registers everything.
    """
    if _REGISTERED.get(spark) == sf_dir and spark.catalog.tableExists("v_responses"):
        return
    for name in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)
    for name, sql in VIEWS.items():
        spark.sql(sql).createOrReplaceTempView(name)
    spark.sql(V_RESPONSES.replace("{agg}", SPARK_ITEMS_AGG)).createOrReplaceTempView("v_responses")
    _REGISTERED[spark] = sf_dir


def cte(*names: str) -> str:
    """WITH-clause prefix that inlines fixture views for DuckDB (which has only base tables)."""
    order = ["v_aspects", "v_themes", "v_mappings", "v_vectors", "v_theme_vectors", "v_usage",
             "v_comments", "v_insights", "v_insight_answers", "v_theme_answers", "v_review_answers"]
    need = set(names)
    if "v_insight_answers" in need:
        need.add("v_insights")
    if need & {"v_theme_answers", "v_review_answers"}:
        need.add("v_mappings")
    if "v_insights" in need:
        need.add("v_aspects")
    if "v_responses" in need:
        need.add("v_aspects")
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in order if n in need]
    if "v_responses" in names:
        parts.append("v_responses AS (" + V_RESPONSES.replace("{agg}", DUCK_ITEMS_AGG).strip() + ")")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
