"""Audit of how five document filters overlap, in every order in which they can be applied.

The word filters are decided on the sparse document-term matrix (``term_matrix``): after the words have been
encoded over the whole corpus, a row's sum is the number of words (A) and its number of nonzero entries the
number of distinct words (B).  Upper case (C) and symbols (D) are counted in the same pass over the text
bytes, and copies (E) are found by the SHA-256 of the text.  What the orders need of a document is only
which filters it fails, so documents are counted by part, failures and label, and the 120 orders are applied
to those counts: at most 32 x 4 rows a part.

Failures are a bitmap, A = 1 to E = 16.

Defined results: a null text is an empty text (it fails A and not B, C or D; B and C compare 0 with 0);
a null part is the empty string; a row is no copy if its id is null, and rows of equal id and text are not
copies of each other; a label counts if any label row of the id says so, a null label says nothing;
an empty table gives an empty result.  Very long texts are one row of the matrix and never cut.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlens.llm.term_matrix import document_term_matrix, row_sums, term_shards, unpack
from feedlens.session import materialize

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
SYMBOLS = b"#$%&*|"

_UPPER, _SYMBOL, _STARTS = (np.zeros(256, np.int64) for _ in range(3))
_UPPER[0x41:0x5B] = 1
_SYMBOL[list(SYMBOLS)] = 1
_STARTS[[b for b in range(256) if b & 0xC0 != 0x80]] = 1  # bytes that begin a code point


def _counts(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text ``table`` marks."""
    return np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets])


def text_measures(texts: pa.LargeStringArray, _: pa.RecordBatch) -> dict[str, pa.Array]:
    """Code points, upper-case letters and symbols of each text, and its SHA-256."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[:len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    found = {name: pa.array(_counts(table, data, offsets)) for name, table in
             (("n_chars", _STARTS), ("n_upper", _UPPER), ("n_symbols", _SYMBOL))}
    view = memoryview(data)
    digests = [hashlib.sha256(view[a:b]).digest() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
    return found | {"digest": pa.array(digests, pa.binary())}


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, failed, n_words, n_distinct) of every document; ``failed`` is the bitmap of A to E."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    shards = term_shards(rows, "text", measure=text_measures,
                         measured="n_chars bigint, n_upper bigint, n_symbols bigint, digest binary")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = T.StructType.fromDDL(f"id {kind}, part string, digest binary, failed int, n_words bigint, n_distinct bigint")
    arrow = to_arrow_schema(schema)

    def decide(shard: dict) -> Iterator[pa.RecordBatch]:
        indptr, counts, columns = (unpack(shard[c]) for c in ("indptr", "counts", "columns"))
        words, distinct = row_sums(counts, indptr), row_sums(np.ones(len(columns), np.uint8), indptr)
        chars, upper, symbols = (np.array([r[c] for r in shard["rows"]], np.int64) for c in ("n_chars", "n_upper", "n_symbols"))
        failed = ((words < MIN_WORDS) + 2 * (100 * distinct < DISTINCT_PERCENT * words)
                  + 4 * (100 * upper > UPPER_PERCENT * chars) + 8 * (symbols > 0))
        columns = [[r[c] for r in shard["rows"]] for c in ("id", "part", "digest")]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(
            [*columns, failed.astype(np.int32), words, distinct], arrow, strict=True)], schema=arrow)
    rows = materialize(document_term_matrix(shards, decide, schema), "audit-rows")
    # plain tables on both sides, so that Spark can split a digest that many rows share
    copies = materialize(rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                         .where("first < last").select(F.col("digest").alias("of"), "first"), "audit-copies")
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int") * 16
    return rows.join(copies, F.col("digest") == F.col("of"), "left").select(
        F.col("id").alias(id_col), "part", (F.col("failed") + copy).alias("failed"), "n_words", "n_distinct")


def _orders() -> Column:
    """All orders and steps: (filter_order, step, bit of the step's filter, bits of those before it)."""
    rows = [(o, k + 1, 1 << FILTERS.index(f), sum(1 << FILTERS.index(x) for x in o[:k]))
            for o in map("".join, itertools.permutations(FILTERS)) for k, f in enumerate(o)]
    columns = [F.lit(list(c)).alias(name) for c, name in zip(zip(*rows), ("filter_order", "step", "bit", "before"))]
    return F.arrays_zip(*columns)


def audit(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``failed``: as from ``failures``; ``labels``: id, ``quality``, ``toxic``.
    """
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("of")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    said = materialize(said, "audit-labels")
    cells = failed.join(said, F.col(id_col) == F.col("of"), "left").groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    cells = cells.select("*", F.inline(_orders()))
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    earlier = F.col("failed").bitwiseAND(F.col("before")) != 0
    here = fails & ~earlier
    # each failing filter comes first in an equal share of the orders: 120 / (failing filters), a whole number
    first_in = (F.lit(120) / F.bit_count("failed")).cast("long")
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")
    return cells.groupBy("part", "filter_order", F.col("step").cast("int").alias("step")).agg(
        total(~fails & ~earlier).alias("kept"), total(here).alias("removed"), total(fails & earlier).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"), total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * first_in).otherwise(0)).cast("long").alias("shapley"))
