"""Training-corpus pipeline over the documents table: quality, lines, near duplicates, benchmark, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``.  All but the last return the columns of ``documents``; where a stage changes a
text, ``n_chars`` follows it.

All stages: a null text is an empty text and stays null unless a stage changes it; null ids, empty texts and texts
of any length go through; extra columns are kept, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import decontamination, line_dedup, packing, quality, similarity_join
from feedlens.llm.columns import text_of
from feedlens.session import ensure_checkpoint_dir, materialize, ship_package

BIN_BYTES = 8192
LEAST_QUALITY = 0.5

#: No SQL: the classifier and the packing cannot be expressed in it.
ORACLE_SQL = None


def _ready(spark: SparkSession) -> None:
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length(text_of(docs, "text")).cast("long"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go.

    A document is rejected on its own text and metadata, so repeated rows and rows of equal id fare alike if they are equal.
    ``labels.quality`` teaches it; ``labels.toxic`` says nothing about quality and is not read.  Without labels of both
    kinds all stay.
    """
    _ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score(docs, labels).where(F.col("quality_score") >= LEAST_QUALITY).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that five documents or more share stay in one of them only, the one with the largest id.

    No document goes, even if no line is left; rows of equal id count as one document and keep their lines alike.
    """
    _ready(spark)
    return _sized(line_dedup.dedup_lines(docs).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, one stays: the one with the smallest id.

    A document is an id with a text: rows of one id and different texts are different documents, and of them the one
    with the smaller hash of the text comes first.  Of rows that are equal in id and text one stays, with the
    smallest hash of its other columns.  Texts without words are linked with nothing and stay.
    """
    _ready(spark)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = text_of(docs, "text")
    rows = docs.select(F.struct(*columns).alias("row"), F.struct(F.col("doc_id").alias("id"), F.xxhash64(text).alias("text")).alias("key"))
    keyed = docs.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64(text).alias("text")).alias("key"), text.alias("text"))
    found = similarity_join.jaccard_components(keyed, "key", "text")
    stay = found.where(F.col("component_id") == F.col("key")).groupBy("key").agg(F.count("*").alias("copies"))
    stay = materialize(stay.select(F.col("key").alias("kept"), "copies"), "pipeline-kept")
    met = rows.join(stay, F.col("key") == F.col("kept"))
    once = met.where("copies = 1").select("row")
    several = met.where("copies > 1").groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return once.unionByName(several).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark items go, and documents of which more than 80 % of the words lie in such spans.

    A document without words, and one without hits, stays as it is; repeated rows fare alike; items that are null or
    have no words hit nothing.
    """
    _ready(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _sized(decontamination.decontaminate(docs, benchmark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in bins; a bin holds no two pieces of a source or of near copies.

    Near copies are sought once more: documents that differed in shared lines or benchmark passages only have become alike
    since the third stage.  An empty text has a row without a bin; a null source conflicts with nothing; rows of
    equal id are packed each on its own.
    """
    _ready(spark)
    return packing.pack_texts(docs, BIN_BYTES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is a table in the shared checkpoint folder."""
    _ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
