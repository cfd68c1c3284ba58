"""The completion store's files: one per prefix and batch, whatever the number of tasks."""

import json
import glob
import tempfile

from pyspark.sql import functions as F

from feedlens.operators.store import CompletionStore


def test_a_batch_has_one_file_per_prefix(spark):
    path = tempfile.mkdtemp(prefix="feedlens-test-", dir="/tmp")
    store = CompletionStore(spark, path, digits=1)
    answers = spark.range(400, numPartitions=6).select(
        F.sha2(F.col("id").cast("string"), 256).alias("request_id"), F.lit("t").alias("text"), F.lit(2).cast("long").alias("input_tokens"),
        F.lit(1).cast("long").alias("output_tokens"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"))
    store.add("one", answers)
    files = glob.glob(f"{path}/answers/prefix=*/batch=one/*.parquet")
    assert len(files) == 16 and store.answers().count() == 400
    assert store.close("one") == (800, 400)


def test_document_of_many_pieces_and_its_members_by_ranges(spark, tmp_path, monkeypatch):
    """The one writer keeps pieces, not rows; a key's list is read member by member, over ranges that cut it."""
    from pyspark.sql import functions as F

    from feedlens.sinks import files as sinks
    from feedlens.sources import files as sources
    monkeypatch.setattr(sinks, "PIECE", 300)
    rows = spark.range(900).select((F.col("id") % 11 % 3).cast("int").alias("k"), F.concat(F.lit('ü "[,'), F.col("id").cast("string")).alias(
        "aspect"), F.lit("neutral").alias("sentiment"), (F.col("id") / 7).alias("confidence"), "id")
    path = str(tmp_path / "doc")
    sinks.write_json_document(rows, "k", F.struct("aspect", "sentiment", "confidence"), path, many="id")
    part, = (tmp_path / "doc").glob("part-*")
    expected = {str(k): [{"aspect": f'ü "[,{i}', "sentiment": "neutral", "confidence": i / 7} for i in range(900) if i % 11 % 3 == k] for k in range(3)}
    assert json.loads(part.read_text()) == expected
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        back = sources.read_clusters(spark, path)
        assert "Generate" not in back._jdf.queryExecution().toString()  # no entry is taken whole
        got = sorted((r["cluster_id"], r["pos"], r["aspect"], r["confidence"]) for r in back.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(int(k), p, m["aspect"], m["confidence"]) for k, v in expected.items() for p, m in enumerate(v)]
