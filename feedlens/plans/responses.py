"""Response handling, model-call and cost queries."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from feedlens.functions import prompts
from feedlens.functions.hashing import seeded_key, seeded_key_sql
from feedlens.operators import completion, ledger, responses
from feedlens.plans.fixtures import (EMPTY_OBJECT, MALFORMED_ARRAY, MALFORMED_TRAILING, MALFORMED_TRUNCATED,
                                     cte)
from feedlens.operators.store import CompletionStore
from feedlens.plans.registry import query, r6, shared_path
from feedlens.session import ensure_checkpoint_dir

MODEL = "stub-model"

STRIP = r"regexp_replace({t}, '^\s+|\s+$', '', 'g')"
DUCK_STRIP_A = f"""
  SELECT comment_id, response_text,
         {STRIP.format(t='''CASE WHEN ends_with(s1, '```') THEN substr(s1, 1, length(s1) - 3) ELSE s1 END''')} AS stripped
  FROM (SELECT comment_id, response_text,
               CASE WHEN starts_with(s0, '```json') THEN substr(s0, 8) WHEN starts_with(s0, '```') THEN substr(s0, 4)
                    ELSE s0 END AS s1
        FROM (SELECT comment_id, response_text, {STRIP.format(t='response_text')} AS s0 FROM v_responses))
"""
DUCK_STRIP_B = f"""
  SELECT comment_id, response_text,
         CASE WHEN starts_with(s0, '```') THEN
              CASE WHEN starts_with(string_split(s0, '```')[2], 'json') THEN substr(string_split(s0, '```')[2], 5)
                   ELSE string_split(s0, '```')[2] END
              ELSE s0 END AS stripped
  FROM (SELECT comment_id, response_text, {STRIP.format(t='response_text')} AS s0 FROM v_responses)
"""
# Which comment ids fail to parse, by fence variant (follows from the fixture's injected breakages).
ERR_A = f"({MALFORMED_TRAILING} OR {MALFORMED_TRUNCATED} OR {MALFORMED_ARRAY})"
ERR_B = f"(({MALFORMED_TRAILING} AND comment_id % 3 = 2) OR {MALFORMED_TRUNCATED} OR {MALFORMED_ARRAY})"


def parsed(spark, fence="a"):
    df = responses.parse_responses(spark.table("v_responses"), "response_text", fence=fence)
    return responses.with_aspect_count(df)


@query("fence_strip_a", cte("v_responses") + f"""
SELECT comment_id, stripped FROM ({DUCK_STRIP_A})""")
def q_fence_strip_a(spark, sf_dir):
    from feedlens.functions.jsonparse import strip_fence_a
    return spark.table("v_responses").select("comment_id", strip_fence_a("response_text").alias("stripped"))


@query("fence_strip_b", cte("v_responses") + f"""
SELECT comment_id, stripped FROM ({DUCK_STRIP_B})""")
def q_fence_strip_b(spark, sf_dir):
    from feedlens.functions.jsonparse import strip_fence_b
    return spark.table("v_responses").select("comment_id", strip_fence_b("response_text").alias("stripped"))


PARSE_STATUS_SQL = cte("v_aspects") + f"""
, ids AS (SELECT comment_id, count(*) AS n FROM v_aspects GROUP BY comment_id)
SELECT comment_id,
       CASE WHEN {ERR_A} THEN 'error' ELSE 'success' END AS status,
       CAST(CASE WHEN {ERR_A} THEN NULL WHEN {EMPTY_OBJECT} THEN 0 ELSE n END AS INT) AS num_aspects,
       CASE WHEN {ERR_A} THEN 'JSON parsing failed' END AS error
FROM ids"""


@query("parse_response", PARSE_STATUS_SQL)
def q_parse_response(spark, sf_dir):
    """Strict parse of every response: status, aspect count (0 for {}), error text."""
    return parsed(spark).select("comment_id", "status", "num_aspects", "error")


EXPLODE_SQL = cte("v_aspects") + f"""
SELECT comment_id, CAST(row_number() OVER (PARTITION BY comment_id ORDER BY seq) - 1 AS INT) AS pos,
       aspect, sentiment, coalesce(evidence, '') AS evidence, {r6('coalesce(confidence, 0.5)')} AS confidence
FROM v_aspects WHERE NOT ({ERR_A} OR {EMPTY_OBJECT})"""


@query("explode_aspects", EXPLODE_SQL)
def q_explode_aspects(spark, sf_dir):
    """parse(render(v_aspects)) == v_aspects: successes exploded with evidence/confidence defaults."""
    return responses.explode_aspects(parsed(spark), ["comment_id"])


@query("jsonl_roundtrip", EXPLODE_SQL)
def q_jsonl_roundtrip(spark, sf_dir):
    """Write successes as JSON Lines {comment_id, aspects} to shared storage and read them back."""
    from feedlens.sinks import files as sinks
    from feedlens.sources import files as sources
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/feedlens-jsonl-{uuid.uuid4().hex}"
    sinks.write_success_jsonl(parsed(spark), path, ["comment_id"])
    back = sources.read_success_jsonl(spark, path, [("comment_id", "long")])
    return responses.explode_aspects(back, ["comment_id"], parsed="parsed")


@query("failed_rows", cte("v_aspects") + f"""
, ids AS (SELECT DISTINCT comment_id FROM v_aspects)
SELECT ids.comment_id, substr(d.text, 1, 200) AS comment, 'JSON parsing failed' AS error
FROM ids LEFT JOIN documents d ON d.doc_id = ids.comment_id WHERE {ERR_A.replace('comment_id', 'ids.comment_id')}""")
def q_failed_rows(spark, sf_dir):
    """Failure file rows: id, first 200 characters of the comment, error."""
    docs = spark.table("v_comments")
    df = parsed(spark).join(docs, "comment_id", "left")
    return responses.failed_rows(df, "comment_id", "comment", 200)


@query("success_rate", cte("v_aspects") + f"""
, ids AS (SELECT DISTINCT comment_id FROM v_aspects)
SELECT count(*) AS total, count(*) FILTER (WHERE NOT {ERR_A}) AS successful,
       count(*) FILTER (WHERE {ERR_A}) AS failed,
       {r6(f'count(*) FILTER (WHERE NOT {ERR_A}) / count(*)')} AS success_rate FROM ids""")
def q_success_rate(spark, sf_dir):
    return responses.success_counts(parsed(spark))


@query("extraction_summary", cte("v_aspects") + f"""
, ok AS (SELECT *, comment_id * 1000000 + row_number() OVER (PARTITION BY comment_id ORDER BY seq) - 1 AS fseq
           FROM v_aspects WHERE NOT ({ERR_A} OR {EMPTY_OBJECT})),
firsts AS (SELECT aspect, count(*) AS n, min(fseq) AS first_seq FROM ok GROUP BY aspect)
SELECT 'total_aspects' AS section, CAST(NULL AS VARCHAR) AS key, CAST(NULL AS INT) AS rank, count(*) AS value FROM ok
UNION ALL
SELECT 'sentiment', sentiment, NULL, count(*) FROM ok GROUP BY sentiment
UNION ALL
SELECT 'top_aspect', aspect, CAST(rk AS INT), n FROM (
  SELECT aspect, n, row_number() OVER (ORDER BY n DESC, first_seq) AS rk FROM firsts) WHERE rk <= 20""")
def q_extraction_summary(spark, sf_dir):
    """Total aspects, open sentiment distribution and top-20 aspects (ties by first appearance)."""
    from feedlens.operators import aspects
    ex = responses.explode_aspects(parsed(spark), ["comment_id"])
    # first appearance = (comment, position) order of the results file
    ex = ex.withColumn("seq", F.col("comment_id") * F.lit(1_000_000) + F.col("pos"))
    return aspects.extraction_summary(ex, top_n=20)


REQ_SQL = """
SELECT doc_id AS comment_id, replace({tpl}, '{{comment}}', text) AS prompt,
       sha256(concat('{model}', chr(1), replace({tpl}, '{{comment}}', text))) AS request_id
FROM documents"""


def _tpl_sql() -> str:
    return "'" + prompts.EXTRACTION_TEMPLATE.replace("'", "''") + "'"


def requests(spark):
    df = spark.table("v_comments").withColumn("prompt", prompts.render(prompts.EXTRACTION_TEMPLATE,
                                                                         comment=F.col("comment")))
    return completion.with_request_id(df, "prompt", MODEL)


@query("render_prompt", f"""
WITH r AS ({REQ_SQL.format(tpl=_tpl_sql(), model=MODEL)})
SELECT comment_id, request_id, length(prompt) AS prompt_chars FROM r""")
def q_render_prompt(spark, sf_dir):
    """Extraction prompt per comment (whole text), keyed by request id."""
    return requests(spark).select("comment_id", "request_id", F.length("prompt").cast("long").alias("prompt_chars"))


@query("complete_stored", cte("v_responses").rstrip() + f"""
, r AS ({REQ_SQL.format(tpl=_tpl_sql(), model=MODEL)})
SELECT r.request_id, v.response_text AS text, CAST((length(r.prompt) + 3) // 4 AS BIGINT) AS input_tokens,
       CAST(length(v.response_text) // 4 AS BIGINT) AS output_tokens, 'success' AS status, CAST(NULL AS VARCHAR) AS error
FROM r JOIN v_responses v ON v.comment_id = r.comment_id""")
def q_complete_stored(spark, sf_dir):
    """Completions of the extraction requests from the stored answers of a previous run (L1)."""
    answers = spark.table("v_responses").select("comment_id", F.col("response_text").alias("text"))
    return completion.stored(requests(spark), answers, ["comment_id"])


class CountingModel:
    """A rule in the place of a model: it answers with the number of the prompt's characters, and fails on some lengths.

    Its answers can be written in SQL, so the calls, their failures and the sharing of equal prompts are checked row by row.
    """

    def complete(self, prompt: str) -> tuple[str, int, int]:
        n = len(prompt)
        if n % 11 == 0:
            raise RuntimeError(f"length {n} is refused")
        return json.dumps({"chars": n}), (n + 3) // 4, 1


COUNTED_SQL = f"""
WITH r AS ({REQ_SQL.format(tpl=_tpl_sql(), model=MODEL)}),
q AS (SELECT DISTINCT request_id, length(prompt) AS n FROM r),
a AS (SELECT request_id, CASE WHEN n % 11 <> 0 THEN concat('{{"chars": ', CAST(n AS VARCHAR), '}}') END AS text,
             CAST(CASE WHEN n % 11 <> 0 THEN (n + 3) // 4 ELSE 0 END AS BIGINT) AS input_tokens,
             CAST(CASE WHEN n % 11 <> 0 THEN 1 ELSE 0 END AS BIGINT) AS output_tokens,
             CASE WHEN n % 11 <> 0 THEN 'success' ELSE 'error' END AS status,
             CASE WHEN n % 11 = 0 THEN concat('length ', CAST(n AS VARCHAR), ' is refused') END AS error FROM q)
"""


@query("complete_calls", COUNTED_SQL + "SELECT request_id, text, input_tokens, output_tokens, status, error FROM a")
def q_complete_calls(spark, sf_dir):
    """One call per distinct prompt by a client in each task; failed calls are error rows (L1)."""
    return completion.complete(requests(spark), CountingModel)


@query("complete_resumed", COUNTED_SQL + """
, b AS (SELECT r.comment_id, r.request_id FROM r)
SELECT CASE WHEN EXISTS (SELECT 1 FROM b JOIN labels l ON l.doc_id = b.comment_id WHERE b.request_id = a.request_id)
            THEN 'first' ELSE 'second' END AS batch, request_id, status, input_tokens FROM a""")
def q_complete_resumed(spark, sf_dir):
    """A run over the labelled comments, then one over all: the second calls only what the store does not hold."""
    store = CompletionStore(spark, shared_path(spark, "answers"))
    every = requests(spark)
    first = every.join(spark.table("labels").select(F.col("doc_id").alias("comment_id")).distinct(), "comment_id", "left_semi")
    for name, batch in (("first", first), ("second", every)):
        store.add(name, completion.complete(store.pending(batch), CountingModel))
        store.close(name)
    return store.answers().select("batch", "request_id", "status", "input_tokens")


@query("budgeted_run", COUNTED_SQL + f"""
, o AS (SELECT comment_id, request_id, floor((row_number() OVER (ORDER BY comment_id) - 1) / 50) AS batch_no FROM r),
f AS (SELECT request_id, min(batch_no) AS batch_no FROM o GROUP BY request_id),
t AS (SELECT b.batch_no, count(f.request_id) AS n, coalesce(sum(a.input_tokens), 0) AS input_tokens,
             coalesce(sum(a.output_tokens), 0) AS output_tokens
      FROM (SELECT DISTINCT batch_no FROM o) b LEFT JOIN f ON f.batch_no = b.batch_no LEFT JOIN a ON a.request_id = f.request_id
      GROUP BY b.batch_no),
c AS (SELECT *, coalesce(sum(input_tokens) OVER w, 0) AS bi, coalesce(sum(output_tokens) OVER w, 0) AS bo FROM t
      WINDOW w AS (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT concat('run-', CAST(CAST(batch_no AS BIGINT) AS VARCHAR)) AS batch, CAST(n AS BIGINT) AS n,
       CAST(input_tokens AS BIGINT) AS input_tokens, CAST(output_tokens AS BIGINT) AS output_tokens
FROM c WHERE round(bi * (0.8 / 1000000.0) + bo * (4.0 / 1000000.0), 4) <= {{limit}}""".replace("{limit}", "0.1"))
def q_budgeted_run(spark, sf_dir):
    """The ledger of a budgeted run ($0.10, batches of 50 comments): one total per batch up to the one that crosses the limit."""
    path = shared_path(spark, "budgeted")
    completion.run_budgeted(requests(spark), CountingModel, path, ["comment_id"], 50, 0.1)
    return CompletionStore(spark, path).ledger()


@query("pending_requests", f"""
WITH r AS ({REQ_SQL.format(tpl=_tpl_sql(), model=MODEL)}),
done AS (SELECT DISTINCT r.request_id FROM r JOIN labels l ON l.doc_id = r.comment_id)
SELECT comment_id, request_id FROM r WHERE request_id NOT IN (SELECT request_id FROM done)""")
def q_pending_requests(spark, sf_dir):
    """Requests still to call: completions already stored for the labelled documents (a previous run)."""
    req = requests(spark)
    stored = req.join(spark.table("labels").select(F.col("doc_id").alias("comment_id")), "comment_id", "left_semi")
    return completion.pending(req, stored).select("comment_id", "request_id")


COST_COLS = """input_tokens, output_tokens, input_tokens + output_tokens AS total_tokens,
       {r_in} AS input_cost_usd, {r_out} AS output_cost_usd, {r_tot} AS total_cost_usd,
       CASE WHEN input_tokens + output_tokens > 0 THEN {r_tok} ELSE 0.0 END AS cost_per_token_usd"""


def _cost_cols_sql() -> str:
    i, o = "input_tokens * (0.8 / 1000000.0)", "output_tokens * (4.0 / 1000000.0)"
    rnd = lambda e, p: f"CAST(round(CAST(CAST(({e}) AS DOUBLE) AS VARCHAR)::DECIMAL(38,18), {p}) AS DOUBLE)"
    return COST_COLS.format(r_in=rnd(i, 4), r_out=rnd(o, 4), r_tot=rnd(f"{i} + {o}", 4),
                            r_tok=rnd(f"({i} + {o}) / (input_tokens + output_tokens)", 8))


@query("token_cost", cte("v_usage") + f"""
SELECT {_cost_cols_sql()}
FROM (SELECT CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens
      FROM v_usage)""")
def q_token_cost(spark, sf_dir):
    """Token totals -> USD (input 0.80/M, output 4.00/M, rounded 4; 8 per token)."""
    return ledger.cost_summary(spark.table("v_usage"))


@query("batch_assign", f"""
SELECT doc_id AS comment_id,
       CAST(floor((row_number() OVER (ORDER BY {seeded_key_sql('doc_id', 3)}, doc_id) - 1) / 500) AS BIGINT) AS batch_no,
       CAST((row_number() OVER (ORDER BY {seeded_key_sql('doc_id', 3)}, doc_id) - 1) % 500 + 1 AS BIGINT) AS idx_in_batch
FROM documents""")
def q_batch_assign(spark, sf_dir):
    """Fixed-size batches of 500 in a given order, with the per-batch 1-based index."""
    df = spark.table("v_comments").select("comment_id").withColumn("_k", seeded_key("comment_id", 3))
    return ledger.assign_batches(df, ["_k", "comment_id"], 500).drop("_k")


BUDGET_USD = 2.0


@query("budget_cutoff", cte("v_usage") + f"""
, b AS (SELECT batch_no, count(*) AS n_requests, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
               CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM v_usage GROUP BY batch_no),
c AS (SELECT *, sum(input_tokens) OVER w AS ci, sum(output_tokens) OVER w AS co,
             coalesce(sum(input_tokens) OVER wb, 0) AS bi, coalesce(sum(output_tokens) OVER wb, 0) AS bo FROM b
      WINDOW w AS (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             wb AS (ORDER BY batch_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT batch_no, n_requests, input_tokens, output_tokens,
       {r6("round(CAST(CAST(ci * (0.8 / 1000000.0) + co * (4.0 / 1000000.0) AS DOUBLE) AS VARCHAR)::DECIMAL(38,18), 4)")}
         AS cumulative_cost_usd,
       CAST(round(CAST(CAST(bi * (0.8 / 1000000.0) + bo * (4.0 / 1000000.0) AS DOUBLE) AS VARCHAR)::DECIMAL(38,18), 4)
            AS DOUBLE) <= {BUDGET_USD} AS run
FROM c""")
def q_budget_cutoff(spark, sf_dir):
    """Which batches a budget-capped run processes ($2.00 limit; the crossing batch still runs)."""
    return ledger.budget_cutoff(spark.table("v_usage"), BUDGET_USD)


@query("cost_ledger", cte("v_usage") + f"""
, runs AS (SELECT batch_no, count(*) AS n_items,
                  CAST(round(CAST(CAST(sum(input_tokens) * (0.8 / 1000000.0) + sum(output_tokens) * (4.0 / 1000000.0)
                       AS DOUBLE) AS VARCHAR)::DECIMAL(38,18), 4) AS DOUBLE) AS cost
           FROM v_usage GROUP BY batch_no)
SELECT batch_no, n_items, {r6('cost')} AS cost,
       {r6('sum(cost) OVER (ORDER BY batch_no)')} AS total_spent,
       {r6('20.0 - sum(cost) OVER (ORDER BY batch_no)')} AS budget_remaining,
       20.0 - sum(cost) OVER (ORDER BY batch_no) < 0 AS over_budget
FROM runs""")
def q_cost_ledger(spark, sf_dir):
    """Ledger of runs (one per batch): cost rounded per run, running spend and remaining budget."""
    runs = ledger.cost_summary(spark.table("v_usage"), keys=["batch_no"], counts="n_items").select(
        "batch_no", "n_items", F.col("total_cost_usd").alias("cost"))
    return ledger.cost_ledger(runs, ["batch_no"]).select("batch_no", "n_items", "cost", "total_spent",
                                                         "budget_remaining", "over_budget")


@query("union_batches", cte("v_aspects") + f"""
, ids AS (SELECT DISTINCT comment_id FROM v_aspects)
SELECT comment_id, 1 AS run, CASE WHEN {ERR_A} THEN 'error' ELSE 'success' END AS status FROM ids
UNION ALL
SELECT comment_id, 2, CASE WHEN {ERR_B} THEN 'error' ELSE 'success' END FROM ids WHERE {ERR_A}""")
def q_union_batches(spark, sf_dir):
    """Run 1 parses everything strictly; run 2 retries the failures with fence variant B; union all."""
    first = parsed(spark, "a").select("comment_id", F.lit(1).alias("run"), "status")
    retry_ids = first.where(F.col("status") == "error").select("comment_id")
    second = (parsed(spark, "b").join(retry_ids, "comment_id", "left_semi")
              .select("comment_id", F.lit(2).alias("run"), "status"))
    return first.unionByName(second)

