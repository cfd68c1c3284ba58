"""Cluster -> insight (P13, L2, A19): prompt rendering per cluster chunk, model call, parsing.

A cluster can hold a large share of all aspects, so its lines are never
collected whole: each cluster is split into ``ceil(size / max_lines)`` chunks by
a seeded hash of the aspect's sequence number, and one prompt is rendered per
(cluster, chunk).  Every aspect appears in exactly one prompt; parts of a cluster are merged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions import jsonparse, prompts
from feedlens.functions.hashing import seeded_key
from feedlens.operators import completion, responses
from feedlens.session import materialize


def cluster_prompts(members: DataFrame, template: str = prompts.INSIGHT_TEMPLATE, model: str = "stub-model",
                    max_lines: int = 500, seed: int = 11, cluster_col: str = "cluster_id", seq: str = "seq") -> DataFrame:
    """``(cluster_id, chunk, n_lines, prompt, request_id)``; lines ``- a (s, confidence: c)`` in ``seq`` order."""
    sizes = members.groupBy(cluster_col).agg(F.ceil(F.count("*") / F.lit(max_lines)).alias("_nch"))
    lines = (members.join(sizes, cluster_col)
             .withColumn("chunk", F.pmod(seeded_key(seq, seed), F.col("_nch")).cast("int"))
             .withColumn("line", prompts.aspect_line("aspect", "sentiment", "confidence")))
    grouped = lines.groupBy(cluster_col, "chunk").agg(
        F.count("*").alias("n_lines"),
        F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col("line").alias("l")))).alias("_ls"))
    body = F.array_join(F.transform("_ls", lambda x: x["l"]), "\n")
    out = grouped.withColumn("prompt", prompts.render(template, aspects=body)).drop("_ls")
    return completion.with_request_id(out, "prompt", model)


def parse_insights(prompts_df: DataFrame, done: DataFrame, keys=("cluster_id", "chunk")) -> DataFrame:
    """Completions of insight prompts, parsed (fence variant B); failures stay as error rows.

    One row per prompt: equal prompts share a request id, so the completions are reduced to one per request id (and per
    key, where ``done`` has one) before they meet the prompts.
    """
    by = ["request_id", *[k for k in keys if k in done.columns]]
    one = done.groupBy(*by).agg(F.max(F.struct("text", "input_tokens", "output_tokens")).alias("c")).select(*by, "c.*")
    joined = prompts_df.select(*keys, "request_id").join(one, by)
    parsed = responses.parse_responses(joined.withColumn("text", F.coalesce("text", F.lit(""))), "text",
                                       schema=jsonparse.INSIGHT_SCHEMA, fence="b", out="insight")
    return parsed.select(*keys, "request_id", "status", F.col("insight.cluster_name").alias("cluster_name"),
                         F.col("insight.summary").alias("summary"),
                         F.col("insight.primary_sentiment").alias("primary_sentiment"),
                         F.col("insight.key_themes").alias("key_themes"), "input_tokens", "output_tokens")


def merge_prompts(parts: DataFrame, template: str = prompts.MERGE_TEMPLATE, model: str = "stub-model",
                  max_lines: int = 500, cluster_col: str = "cluster_id") -> DataFrame:
    """Prompts that merge the parts of each cluster: ``- name: summary (sentiment)`` in chunk order."""
    line = F.format_string("- %s: %s (%s)", *[F.coalesce(c, F.lit("")) for c in ("cluster_name", "summary", "primary_sentiment")])
    grouped = parts.withColumn("part", F.floor(F.col("chunk") / max_lines).cast("int")).groupBy(cluster_col, "part").agg(
        F.count("*").alias("n_lines"), F.array_sort(F.collect_list(F.struct("chunk", line.alias("l")))).alias("_ls"))
    body = F.array_join(F.transform("_ls", lambda x: x["l"]), "\n")
    out = grouped.select(cluster_col, F.col("part").alias("chunk"), "n_lines",
                         prompts.render(template, aspects=body).alias("prompt"))
    return completion.with_request_id(out, "prompt", model)


def cluster_insights(members: DataFrame, answer: Callable[[DataFrame], DataFrame], max_lines: int = 500,
                     cluster_col: str = "cluster_id", **kw) -> DataFrame:
    """One insight per cluster (L2).

    ``answer`` maps requests (``prompt``, ``request_id``, cluster, ``chunk``) to completions.  A cluster of up to
    ``max_lines`` aspects is one prompt.  A larger one is answered in parts, and the parts are merged by
    further prompts, level by level, until one answer is left; every level is written to the shared
    checkpoint folder, so no prompt is answered twice.  A part that failed is an empty line of its merge, so clusters whose
    parts all failed may have equal prompts.  Completions may carry the cluster, where an answer belongs to one.
    """
    keys = (cluster_col, "chunk")
    requests = cluster_prompts(members, max_lines=max_lines, cluster_col=cluster_col, **kw)
    done = None
    while True:
        parts = materialize(parse_insights(requests, answer(requests), keys), "insight-parts")
        sizes = parts.groupBy(cluster_col).agg(F.count("*").alias("n"))
        single = parts.join(sizes.where("n = 1").select(cluster_col), cluster_col).drop("chunk")
        done = single if done is None else done.unionByName(single)
        rest = parts.join(sizes.where("n > 1").select(cluster_col), cluster_col)
        if rest.isEmpty():
            return done
        requests = merge_prompts(rest, max_lines=max_lines, cluster_col=cluster_col)


def insight_success(insights: DataFrame) -> DataFrame:
    """Clusters with a parsed insight; ``insights`` has one row per cluster."""
    ok = F.col("status") == "success"
    return insights.agg(F.count("*").alias("total_clusters"), F.count_if(ok).alias("successful_insights"),
                        F.count_if(~ok).alias("failed_insights"),
                        F.try_divide(F.count_if(ok), F.count("*")).alias("success_rate"))
