"""Sources, sinks, the streaming extraction job and the clustering API."""

import json

import numpy as np
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.clients import CountingCalls, EchoClient
from feedlens.operators.store import CompletionStore
from feedlens.operators import clustering, completion, ledger, mapping, quality
from feedlens.sinks import files as sinks
from feedlens.sources import files as sources
from tests.conftest import DATA


def tmpdir():
    return tempfile.mkdtemp(prefix="feedlens-test-", dir="/tmp")


def test_comment_csv_multiline_and_literal_na(spark):
    d = tmpdir()
    with open(os.path.join(d, "c.csv"), "w") as f:
        f.write('comment\n"line one\nline two, with comma"\nNA\n""\n"He said ""hi"""\nNA\n')
    rows = sources.read_comments_csv(spark, d).collect()
    assert sorted((r["comment"] or "" for r in rows)) == ["", 'He said "hi"', "NA", "NA", "line one\nline two, with comma"]
    # ids follow from the content: the same after a reversal, and copies are told apart
    ids = {(r["comment"], r["comment_id"]) for r in rows}
    back = spark.createDataFrame([(r["comment"],) for r in reversed(rows)], "comment string").repartition(3)
    assert {(r["comment"], r["comment_id"]) for r in sources.with_stable_id(back, "comment").collect()} == ids and len(ids) == 5


def test_sample_csv_round_trip(spark):
    df = sources.read_sample_csv(spark, os.path.join(DATA, "sample_20.csv"))
    out = os.path.join(tmpdir(), "sample")
    sinks.write_sample_csv(df, out)
    back = sources.read_sample_csv(spark, out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_themes_nest_flatten_round_trip(spark):
    flat = sources.read_themes(spark, os.path.join(DATA, "themes.json"))
    again = sources.flatten_themes(mapping.nest_themes(flat.select("theme_pos", "theme", "category")))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, flat.collect()))


def test_extraction_results_file(spark):
    doc = {"metadata": {"timestamp": "t", "total_comments": 3, "successful": 2, "failed": 1, "total_aspects": 3,
                        "avg_aspects_per_comment": 1.5,
                        "cost_summary": {"input_tokens": 10, "output_tokens": 5, "total_tokens": 15,
                                         "input_cost_usd": 0.0, "output_cost_usd": 0.0, "total_cost_usd": 0.0,
                                         "cost_per_token_usd": 0.0}},
           "results": [
               {"idx": 1, "comment": "a", "status": "success", "num_aspects": 2,
                "extraction": {"aspects": [{"aspect": "x", "sentiment": "positive", "evidence": "e", "confidence": 0.9},
                                           {"aspect": "y", "sentiment": "negative"}]}},
               {"idx": 2, "comment": "b", "status": "error", "error": "JSON parsing failed"},
               {"idx": 3, "comment": "c", "status": "success", "num_aspects": 1,
                "extraction": {"aspects": [{"aspect": "z", "sentiment": "mixed", "confidence": 0.4}]}}]}
    path = os.path.join(tmpdir(), "r.json")
    json.dump(doc, open(path, "w"))
    meta, rows = sources.read_extraction_results(spark, path)
    assert meta.first()["successful"] == 2 and rows.count() == 3
    ex = sorted(map(tuple, sources.explode_results(rows).select("aspect", "evidence", "confidence").collect()))
    assert ex == [("x", "e", 0.9), ("y", "", 0.5), ("z", "", 0.4)]
    md = sinks.extraction_metadata(rows.withColumn("input_tokens", F.lit(5)).withColumn("output_tokens", F.lit(2))).first()
    assert (md["total_comments"], md["successful"], md["failed"], md["total_aspects"]) == (3, 2, 1, 3)
    assert md["avg_aspects_per_comment"] == 1.5 and md["cost_summary"]["total_tokens"] == 21


def test_insights_clusters_mappings_files(spark):
    d = tmpdir()
    json.dump({"0": {"cluster_name": "Fees", "summary": "s", "primary_sentiment": "negative", "key_themes": ["a", "b"]},
               "10": {"cluster_name": "Login", "summary": "t", "primary_sentiment": "mixed", "key_themes": []}},
              open(os.path.join(d, "insights.json"), "w"))
    json.dump({"0": [{"aspect": "fee", "sentiment": "negative", "confidence": 0.9}],
               "1": [{"aspect": "a", "sentiment": "positive", "confidence": 0.5},
                     {"aspect": "b", "sentiment": "neutral", "confidence": 0.6}]},
              open(os.path.join(d, "clusters.json"), "w"))
    json.dump({"metadata": {"method": "full", "total_clusters": 2, "successful": 1},
               "mappings": {"0": {"cluster_id": 0, "primary_theme": "Pricing & Fees", "primary_category": "Company & Brand",
                                  "primary_confidence": 0.98, "reasoning": "r", "status": "success"},
                            "1": {"cluster_id": 1, "status": "error", "error": "boom"}}},
              open(os.path.join(d, "mappings.json"), "w"))
    ins = sources.read_insights(spark, os.path.join(d, "insights.json"))
    assert sorted(r["cluster_id"] for r in ins.collect()) == [0, 10]
    cl = sources.read_clusters(spark, os.path.join(d, "clusters.json"))
    assert quality.cluster_sizes(cl).orderBy("cluster_id").collect()[1]["size"] == 2
    meta, maps = sources.read_mappings(spark, os.path.join(d, "mappings.json"))
    assert meta.first()["total_clusters"] == 2
    assert mapping.theme_usage(maps).collect()[0]["theme"] == "Pricing & Fees"


def test_cluster_sink_is_partitioned_and_projected(spark):
    out = os.path.join(tmpdir(), "clusters")
    df = spark.createDataFrame([(1, "a", "positive", 0.5, "ev", "src"), (2, "b", "negative", 0.7, "ev", "src")],
                               "cluster_id int, aspect string, sentiment string, confidence double, evidence string, "
                               "source_comment string")
    sinks.write_clusters(df, out)
    assert {"cluster_id=1", "cluster_id=2"} <= set(os.listdir(out))
    back = spark.read.parquet(out)
    assert set(back.columns) == {"cluster_id", "aspect", "sentiment", "confidence"}


def test_ledger_append_and_running_totals(spark):
    path = os.path.join(tmpdir(), "ledger")
    run = lambda i, c: spark.createDataFrame([(i, "extraction", 100, c)], "run_no long, stage string, n_items long, cost double")
    ledger.append_run(run(1, 5.0), path)
    ledger.append_run(run(2, 16.0), path)
    rows = ledger.cost_ledger(spark.read.parquet(path), ["run_no"]).orderBy("run_no").collect()
    assert [r["total_spent"] for r in rows] == [5.0, 21.0]
    assert [r["over_budget"] for r in rows] == [False, True]


def test_streaming_extraction_is_idempotent(spark):
    d = tmpdir()
    src, out = os.path.join(d, "src"), os.path.join(d, "out")
    spark.createDataFrame([(i, f"comment number {i}") for i in range(40)], "comment_id long, comment string") \
        .write.parquet(os.path.join(src, "part1"))
    from feedlens.streaming.extraction import start_extraction_stream
    q = start_extraction_stream(spark, os.path.join(src, "*"), out, EchoClient)
    q.awaitTermination(120)
    comp = CompletionStore(spark, os.path.join(out, "completions")).answers()
    res = spark.read.parquet(os.path.join(out, "results"))
    assert comp.count() == 40 and res.count() == 40
    assert res.where(F.col("status") == "success").count() == comp.where(F.col("status") == "success").count()
    # a second file with overlapping comments: only new prompts are sent to the model
    spark.createDataFrame([(i, f"comment number {i}") for i in range(30, 50)], "comment_id long, comment string") \
        .write.parquet(os.path.join(src, "part2"))
    q = start_extraction_stream(spark, os.path.join(src, "*"), out, EchoClient)
    q.awaitTermination(120)
    comp = CompletionStore(spark, os.path.join(out, "completions")).answers()
    assert comp.count() == 50 and comp.select("request_id").distinct().count() == 50


def test_kmeans_sweep_finds_separated_blobs(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    centers = np.array([[0, 0], [10, 0], [0, 10]], dtype=float)
    pts = [(i, (centers[i % 3] + rng.normal(scale=0.3, size=2)).tolist()) for i in range(60)]
    df = spark.createDataFrame(pts, "vec_id long, v array<double>")
    scores, k, labelled = clustering.kmeans_sweep(df, "vec_id", max_clusters=5, n_init=2)
    assert k == 3 and scores.count() == 3
    assert clustering.select_k(scores).first()["k"] == 3
    assert labelled.select("cluster_id").distinct().count() == 3


def test_cluster_dispatch_rejects_unknown_method(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0])], "vec_id long, v array<double>")
    with pytest.raises(ValueError):
        clustering.cluster(df, "vec_id", method="gmm")


def test_budgeted_run_stops_after_crossing_batch(spark):
    out = os.path.join(tmpdir(), "completions")
    req = spark.range(100).select(F.col("id").alias("comment_id"),
                                  F.concat(F.lit("prompt "), F.col("id").cast("string"), F.lit(" " + "x" * 4000))
                                  .alias("prompt"))
    req = completion.with_request_id(req, "prompt", "m")
    # each request costs ~1000 input tokens -> ~$0.0008; 10 requests per batch -> ~$0.008 per batch
    res = completion.run_budgeted(req, EchoClient, out, ["comment_id"], 10, 0.02)
    assert res["stopped_by_budget"] and res["batches_run"] == 3
    store = CompletionStore(spark, out)
    assert store.answers().count() == 30 and store.ledger().count() == 3
    again = completion.run_budgeted(req, EchoClient, out, ["comment_id"], 10, 1.0)
    assert not again["stopped_by_budget"] and again["batches_run"] == 7 and store.answers().count() == 100
    assert completion.run_budgeted(req, EchoClient, out, ["comment_id"], 10, 1.0)["batches_run"] == 0


def test_killed_run_resumes_without_paying_twice(spark):
    out, calls = os.path.join(tmpdir(), "store"), tmpdir()
    req = completion.with_request_id(spark.range(40).select(F.col("id").alias("comment_id"), F.concat(
        F.lit("p "), F.col("id").cast("string")).alias("prompt")), "prompt", "m")
    store = CompletionStore(spark, out)
    # killed after the answers of batch 0 were stored and before its total was written
    store.add("run-0", completion.complete(req.where("comment_id < 10"), lambda: CountingCalls(calls)))
    assert store.ledger().count() == 0
    res = completion.run_budgeted(req, lambda: CountingCalls(calls), out, ["comment_id"], 10, 1.0)
    assert res["batches_run"] == 4 and len(os.listdir(calls)) == 40
    rows = {r["batch"]: r for r in store.ledger().collect()}
    assert sorted(rows) == [f"run-{b}" for b in range(4)] and all(r["n"] == 10 and r["input_tokens"] == 10000 for r in rows.values())
    assert res["total_cost_usd"] == round(40000 * 0.8e-6 + 400 * 4e-6, 4)


def test_lookup_reads_only_the_folders_of_its_requests(spark):
    out = os.path.join(tmpdir(), "store")
    req = completion.with_request_id(spark.range(300).select(F.concat(F.lit("p "), F.col("id").cast("string")).alias("prompt")), "prompt", "m")
    store = CompletionStore(spark, out)
    store.add("all", completion.complete(req, EchoClient))
    few = req.limit(4).cache()
    found = store.lookup(few)
    assert sorted(r["request_id"] for r in found.collect()) == sorted(r["request_id"] for r in few.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(r["request_id"][:3] in filters for r in few.collect()) and "prefix" in filters


def test_model_vectors_provider(spark):
    from feedlens.operators import embedding
    df = spark.createDataFrame([(1, "app login is slow"), (2, "App login is SLOW!"), (3, "")], "id long, t string")
    out = {r["id"]: r["v"] for r in embedding.model_vectors(df, "t", lambda: embedding.HashingEncoder(16), 16).collect()}
    assert len(out[1]) == 16 and out[1] == out[2]                     # same tokens -> same vector
    assert all(x == 0 for x in out[3])
    exp = embedding.HashingEncoder(16).encode(["app login is slow"])[0]
    assert np.allclose(out[1], exp, atol=1e-6)


def test_join_and_hashing_providers(spark):
    from feedlens.operators import embedding
    df = spark.createDataFrame([(1, "a b"), (2, "c d")], "id long, t string")
    table = spark.createDataFrame([(1, [0.1, 0.2])], "key long, embedding array<float>")
    joined = {r["id"]: r["v"] for r in embedding.join_embeddings(df, "id", table, "key").collect()}
    assert len(joined[1]) == 2 and joined[2] is None  # a row without a vector is kept
    hv = embedding.hashing_vectors(spark.createDataFrame([(1, "alpha beta"), (2, "beta gamma")], "id long, t string"), "t",
                                   num_features=32)
    assert hv.count() == 2
