"""Injected model calls (L1, J9): prompts in, persisted completions out.

The model is a user object with ``complete(prompt) -> (text, input_tokens,
output_tokens)``, built once per partition by ``client_factory``.  Failures
become error rows; the job never aborts on a bad call.  Completions are keyed
by ``request_id = sha256(model || 0x01 || prompt)``: persist them before
parsing and call only for keys with no stored completion (``pending``), so a
retried task or a re-run never pays twice for the same prompt.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPLETION_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("input_tokens", T.LongType()),
    T.StructField("output_tokens", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])


def request_id(prompt, model: str) -> Column:
    p = F.col(prompt) if isinstance(prompt, str) else prompt
    return F.sha2(F.concat(F.lit(model), F.lit("\u0001"), p), 256)


def with_request_id(df: DataFrame, prompt_col: str, model: str) -> DataFrame:
    return df.withColumn("request_id", request_id(prompt_col, model))


def pending(requests: DataFrame, completed: DataFrame) -> DataFrame:
    """Requests that have no stored completion yet (left anti join on ``request_id``)."""
    return requests.join(completed.select("request_id").distinct(), "request_id", "left_anti")


def complete(requests: DataFrame, client_factory: Callable[[], object], prompt_col: str = "prompt",
             max_concurrency: int | None = None, error_chars: int = 100, dedup: bool = True,
             journal_dir: str | None = None) -> DataFrame:
    """Call the model once per distinct request; return the completion table.

    With ``dedup`` the requests are hash-partitioned on ``request_id`` (one
    shuffle), so every copy of a prompt lands in the same task and is called
    once there; the partition count (``max_concurrency``, default the shuffle
    partitions) is also the number of parallel clients.  ``dedup=False`` is for
    callers whose prompts are already unique: no shuffle at all, unless
    ``max_concurrency`` asks for a round-robin repartition.

    ``journal_dir`` (a directory on storage every executor mounts, e.g. under
    the shared checkpoint dir) makes calls survive task retries and repeated
    actions: each task appends every completion to its own journal file as it
    is made and, when run again, replays the journal instead of calling the
    model.  Requires ``dedup`` (the hash partitioning makes a retried task see
    the same prompts).
    """
    import uuid
    from feedlens.session import ship_package
    ship_package(requests.sparkSession)
    todo = requests.select("request_id", F.col(prompt_col).alias("prompt"))
    if dedup:
        n = max_concurrency or int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        todo = todo.repartition(n, "request_id")
    elif max_concurrency:
        todo = todo.repartition(max_concurrency)

    journal = f"{journal_dir.rstrip('/')}/{uuid.uuid4().hex}" if journal_dir and dedup else None

    def run(batches):
        import json
        import os

        from pyspark import TaskContext
        client = None
        seen: set[str] = set()
        replay: dict[str, tuple] = {}
        log = None
        if journal:
            os.makedirs(journal, exist_ok=True)
            path = os.path.join(journal, f"part-{TaskContext.get().partitionId():05d}.jsonl")
            if os.path.exists(path):
                with open(path, encoding="utf-8") as fh:
                    for line in fh:
                        try:
                            rec = json.loads(line)
                        except ValueError:
                            continue  # a line cut short by the failure that caused the retry
                        replay[rec[0]] = tuple(rec[1:])
            log = open(path, "a", encoding="utf-8")
        for pdf in batches:
            ids, texts, ins, outs, status, errors = [], [], [], [], [], []
            for rid, prompt in zip(pdf["request_id"], pdf["prompt"]):
                if dedup:
                    if rid in seen:
                        continue
                    seen.add(rid)
                if rid in replay:
                    row = replay[rid]
                else:
                    client = client or client_factory()
                    try:
                        text, tin, tout = client.complete(prompt)
                        row = (text, int(tin), int(tout), "success", None)
                    except Exception as e:  # noqa: BLE001 - a failed call is data, not a crash
                        row = (None, 0, 0, "error", str(e)[:error_chars])
                    if log:
                        log.write(json.dumps([rid, *row]) + "\n")
                        log.flush()
                ids.append(rid)
                texts.append(row[0])
                ins.append(row[1])
                outs.append(row[2])
                status.append(row[3])
                errors.append(row[4])
            yield pd.DataFrame({"request_id": ids, "text": texts,
                                "input_tokens": pd.Series(ins, dtype="int64"),
                                "output_tokens": pd.Series(outs, dtype="int64"),
                                "status": status, "error": errors})
        if log:
            log.close()

    return todo.mapInPandas(run, COMPLETION_SCHEMA)


def stored(requests: DataFrame, answers: DataFrame, keys: list[str], prompt_col: str = "prompt", keep: bool = False) -> DataFrame:
    """Completions of the requests whose answer is stored in ``answers`` (``keys`` and ``text``).

    Tokens are estimated from the lengths (4 characters each).  Requests without an answer are not in the
    result: ``pending`` finds them.  An answer that is null is a failed call.  ``keep``: the keys stay as columns, as equal
    prompts (one request id) of different keys may have different answers.
    """
    met = requests.select("request_id", F.length(prompt_col).alias("n"), *keys).join(
        answers.select(*keys, "text"), keys)
    failed = F.col("text").isNull()
    return met.select(
        *(keys if keep else []), "request_id", "text", F.when(failed, 0).otherwise(F.floor((F.col("n") + 3) / 4)).cast("long").alias("input_tokens"),
        F.when(failed, 0).otherwise(F.floor(F.length("text") / 4)).cast("long").alias("output_tokens"),
        F.when(failed, "error").otherwise("success").alias("status"),
        F.when(failed, "no answer stored").alias("error"))


class ReplayClient:
    """Offline client that answers from a dict ``prompt -> text`` (tests, replays)."""

    def __init__(self, answers: dict[str, str]):
        self.answers = answers

    def complete(self, prompt: str):
        text = self.answers[prompt]
        return text, (len(prompt) + 3) // 4, len(text) // 4


def run_budgeted(requests: DataFrame, client_factory: Callable[[], object], store_path: str,
                 order: list[str], batch_size: int, limit_usd: float, prompt_col: str = "prompt",
                 journal_dir: str | None = None, run: str = "run") -> dict:
    """Live budget enforcement: call the model batch by batch (in ``order``), storing each batch's answers and its total
    in the ``CompletionStore`` at ``store_path``; stop after the batch whose cumulative cost exceeds the limit
    (that batch is kept, as in the reference loop).

    The run can be killed and started again under the same name ``run``: batches that the ledger has closed are skipped, and in the
    batch that was cut short only requests without a stored answer are called.  The spent amount is the ledger's sum, read once, plus the
    totals of the batches of this run: no batch reads another one's answers.

    Returns ``{"batches_run", "total_cost_usd", "stopped_by_budget"}``.  The batched requests are
    written once as Parquet (in the shared checkpoint dir) in batch order, so each batch's filter
    skips other batches' row groups by their statistics; each batch is one Spark job over its slice.
    """
    import uuid

    from feedlens.functions import cost
    from feedlens.operators.ledger import assign_batches
    from feedlens.operators.store import CompletionStore
    from feedlens.session import ensure_checkpoint_dir
    spark = requests.sparkSession
    staged = f"{ensure_checkpoint_dir(spark).rstrip('/')}/feedlens-batches-{uuid.uuid4().hex}"
    assign_batches(requests, order, batch_size).sortWithinPartitions("batch_no").write.parquet(staged)
    batched = spark.read.parquet(staged)
    n_batches = batched.agg(F.max("batch_no")).first()[0]
    store = CompletionStore(spark, store_path)
    closed = {r["batch"]: (r["input_tokens"], r["output_tokens"]) for r in store.ledger().collect()}  # one row per batch
    tokens = [sum(t[0] for t in closed.values()), sum(t[1] for t in closed.values())]
    priced = lambda: round(tokens[0] * cost.INPUT_USD_PER_TOKEN + tokens[1] * cost.OUTPUT_USD_PER_TOKEN, 4)
    done = 0
    for b in range(0 if n_batches is None else n_batches + 1):
        name = f"{run}-{b}"
        if name in closed:
            continue
        if done == 0 and closed and priced() > limit_usd:
            return {"batches_run": 0, "total_cost_usd": priced(), "stopped_by_budget": True}
        todo = store.pending(batched.where(F.col("batch_no") == b))
        store.add(name, complete(todo, client_factory, prompt_col, journal_dir=journal_dir))
        tin, tout = store.close(name)
        tokens[0] += tin
        tokens[1] += tout
        done += 1
        if priced() > limit_usd:
            return {"batches_run": done, "total_cost_usd": priced(), "stopped_by_budget": True}
    return {"batches_run": done, "total_cost_usd": priced(), "stopped_by_budget": False}
