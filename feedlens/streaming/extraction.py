"""The extraction stage as a Structured Streaming job.

New comment files are picked up incrementally; each micro-batch renders
prompts, calls the model only for request ids with no stored completion,
stores the completions (persisted before any parsing), then parses and
writes that batch's results into its own ``epoch`` partition with dynamic
partition overwrite, so replaying an epoch after a failure neither calls the
model again nor duplicates rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.functions import prompts
from feedlens.operators import completion, responses
from feedlens.operators.store import CompletionStore

COMMENTS = T.StructType([T.StructField("comment_id", T.LongType()), T.StructField("comment", T.StringType())])


def process_batch(batch: DataFrame, epoch_id: int, client_factory, completions_path: str, results_path: str,
                  model: str, template: str, journal_dir: str | None = None) -> None:
    spark = batch.sparkSession
    batch = batch.persist()  # read by the anti join, the model call and the result join
    try:
        _process(spark, batch, epoch_id, client_factory, completions_path, results_path, model, template,
                 journal_dir)
    finally:
        batch.unpersist()


def _process(spark, batch, epoch_id, client_factory, completions_path, results_path, model, template,
             journal_dir) -> None:
    req = completion.with_request_id(
        batch.withColumn("prompt", prompts.render(template, comment=F.col("comment"))), "prompt", model)
    store = CompletionStore(spark, completions_path)
    store.add(f"epoch-{epoch_id}", completion.complete(store.pending(req), client_factory, "prompt", journal_dir=journal_dir))
    done = store.lookup(req)
    joined = req.select("comment_id", "request_id").join(done, "request_id")
    parsed = responses.with_aspect_count(
        responses.parse_responses(joined.withColumn("text", F.coalesce("text", F.lit(""))), "text"))
    (parsed.select("comment_id", "request_id", "status", "num_aspects", "input_tokens", "output_tokens",
                   F.lit(epoch_id).cast("long").alias("epoch"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch")
     .parquet(results_path))


def start_extraction_stream(spark: SparkSession, source_dir: str, out_dir: str, client_factory,
                            model: str = "stub-model", template: str = prompts.EXTRACTION_TEMPLATE,
                            checkpoint_location: str | None = None, available_now: bool = True,
                            journal_dir: str | None = None):
    """Start the stream; returns the ``StreamingQuery``.  Outputs under ``out_dir``:
    ``completions/`` (a ``CompletionStore``: a micro-batch reads only the folders of its own request ids) and ``results/`` (partitioned by epoch)."""
    completions_path = os.path.join(out_dir, "completions")
    results_path = os.path.join(out_dir, "results")
    ckpt = checkpoint_location or os.path.join(out_dir, "_checkpoint")
    stream = spark.readStream.schema(COMMENTS).parquet(source_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, eid: process_batch(df, eid, client_factory, completions_path, results_path,
                                                          model, template, journal_dir))
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
