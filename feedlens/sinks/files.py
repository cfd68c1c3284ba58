"""Writers for the reference's outputs (K1-K9): Parquet tables plus JSON/CSV exports."""

from __future__ import annotations

import json
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.session import ship_package

PIECE = 1 << 14   # characters of a document that travel in one row; an Arrow batch has up to 10,000 rows


def write_success_jsonl(parsed: DataFrame, path: str, keys: list[str], mode: str = "overwrite") -> None:
    """JSON Lines of successful rows ``{keys…, aspects}`` (K2); Spark's JSON writer is line-delimited."""
    (parsed.where(F.col("status") == "success")
     .select(*keys, F.col("parsed.aspects").alias("aspects"))
     .write.mode(mode).json(path))


def write_extraction_results(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Full result rows as a Parquet table (K1); the metadata block is a query over it."""
    results.write.mode(mode).parquet(path)


def extraction_metadata(results: DataFrame) -> DataFrame:
    """One-row metadata block: totals, average aspects per success, cost summary struct (K1).

    Everything comes from one aggregate over the result rows (token counts are per row).
    """
    from feedlens.operators.ledger import priced
    ok = F.col("status") == "success"
    counts = results.agg(
        F.count("*").alias("total_comments"), F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col("num_aspects"))), F.lit(0)).cast("long").alias("total_aspects"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).cast("long").alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).cast("long").alias("output_tokens"))
    counts = priced(counts).withColumn(
        "avg_aspects_per_comment",
        F.when(F.col("successful") > 0, F.col("total_aspects") / F.col("successful")).otherwise(F.lit(0.0)))
    cost_cols = ["input_tokens", "output_tokens", "total_tokens", "input_cost_usd", "output_cost_usd",
                 "total_cost_usd", "cost_per_token_usd"]
    return counts.select("total_comments", "successful", "failed", "total_aspects", "avg_aspects_per_comment",
                         F.struct(*cost_cols).alias("cost_summary"))


def write_json_report(report: DataFrame, path: str) -> None:
    """A one-row report as a single JSON document (K4, K6, K7)."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_clusters(members: DataFrame, path: str) -> None:
    """Cluster members partitioned by ``cluster_id``; evidence/source columns are not written (K5)."""
    (members.select("cluster_id", "aspect", "sentiment", "confidence")
     .write.mode("overwrite").partitionBy("cluster_id").parquet(path))


def write_json_map(df: DataFrame, key_col: str, value, path: str, field: str | None = None) -> None:
    """One JSON object per line, ``{key: value}`` (or ``{field: {key: value}}``): the keyed files, splittable (K5, K6)."""
    entry = F.map_from_arrays(F.array(F.col(key_col).cast("string")), F.array(value))
    line = F.struct(entry.alias(field)) if field else entry
    df.select(F.to_json(line).alias("value")).write.mode("overwrite").text(path)


def write_json_document(df: DataFrame, key_col: str, value, path: str, field: str | None = None, metadata: dict | None = None,
                        many: str | None = None) -> None:
    """The published form: one document, ``{key: value}`` or ``{"metadata": ..., field: {key: value}}`` (K5, K6).

    Tasks sort ranges of the entries and turn them into pieces of text; the one file has one writer, which keeps the pieces in a
    file of its own until it knows their order, and holds one piece at a time.  ``many``: a column to order by; the value of a
    key is then the list of its rows' values.
    """
    ship_package(df.sparkSession)
    order = [F.col("key"), *([F.col("at")] if many else [])]
    rows = df.select(F.col(key_col).cast("string").alias("key"), F.to_json(value).alias("value"),
                     (F.col(many) if many else F.lit(0)).alias("at"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "value")
    ends = "]" if many else ""

    def line(key: str | None, before: str | None, value: str | None) -> str:
        if many and key == before:
            return f"    {value}"
        return f"  {json.dumps(key, ensure_ascii=False)}: {'[' if many else ''}{value}"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out, size, first, now = TaskContext.get().partitionId(), 0, [], 0, None, None
        for batch in batches:
            for key, value in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist()):
                if size >= PIECE:
                    yield _piece(part, number, first, now, out)
                    number, out, size = number + 1, [], 0
                if out:
                    out.append(("," if many and key == now else f"{ends},") + "\n" + line(key, now, value))
                else:
                    first = key
                    out.append(str(value))  # its line is begun by the writer, who knows the key before
                now, size = key, size + len(out[-1])
        if out:
            yield _piece(part, number, first, now, out)

    def document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = lambda x: pa.RecordBatch.from_pydict({"value": [x]}, schema=pa.schema([("value", pa.string())]))
        with tempfile.TemporaryFile() as kept:
            found = []
            for batch in batches:
                for i in range(batch.num_rows):
                    r = batch.slice(i, 1).to_pylist()[0]
                    raw = r["text"].encode()
                    found.append((r["part"], r["number"], r["first"], r["last"], kept.tell(), len(raw)))
                    kept.write(raw)
            yield text("{" if field is None else f'{{\n  "metadata": {json.dumps(metadata or {})},\n  {json.dumps(field)}: {{')
            found.sort(key=lambda r: r[:2])
            now = None
            for n, (_, _, first, last, at, size) in enumerate(found):
                kept.seek(at)
                following = found[n + 1][2] if n + 1 < len(found) else None
                end = ends if n + 1 == len(found) else "," if many and following == last else f"{ends},"
                yield text(line(first, now, kept.read(size).decode()) + end)
                now = last
            yield text("}" if field is None else "  }\n}")
    made = rows.mapInArrow(pieces, "part int, number int, first string, last string, text string")
    made.repartition(1).mapInArrow(document, "value string").write.text(path)


def _piece(part: int, number: int, first: str | None, last: str | None, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [{"part": part, "number": number, "first": first, "last": last, "text": "".join(lines)}],
        schema=pa.schema([("part", pa.int32()), ("number", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("text", pa.string())]))


def write_comments_csv(comments: DataFrame, path: str) -> None:
    """Comment CSV, every field quoted, quotes doubled, white space kept."""
    (comments.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_sample_csv(sample: DataFrame, path: str) -> None:
    """CSV sample with header, every field quoted, quotes doubled (K8)."""
    (sample.coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("escape", '"').csv(path))
