"""Line deduplication: drop lines that many documents share, keep one copy, reassemble by position.

The lines of each text are normalised (white space stripped at both ends, A-Z lower-cased), exploded
and hashed to 128 bits.  One distinct and one count, both with map-side combining, give the number of
documents of each hash and the largest id among them; the frequent hashes are joined back and the
positions to drop are gathered per document.  The text itself is shuffled at most once, in the last join.

Defined results: a null or empty text is one empty line; a line that is repeated within one document
counts once; null ids count as one document, smaller than any other; documents with equal id and equal
text are treated alike; an empty table gives an empty table; columns of the caller are kept, and those
named ``n_lines``, ``n_dropped`` or like the text column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.columns import ascii_lower, let, packed, text_of, unpacked
from feedlens.session import materialize

BLANKS = "\t\n\x0b\x0c\r "


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """``docs`` with lines of at least ``min_chars`` found in ``min_docs`` documents kept in the largest id only.

    Adds ``n_lines`` (before dropping) and ``n_dropped``; the text column holds the remaining lines.
    """
    base = docs.select(packed(docs), docs[id_col].alias("__id"), text_of(docs, text_col).alias("__text"))
    base = base.withColumn("__same", F.xxhash64("__text"))
    split = F.split(F.col("__text"), "\n", -1)

    lines = base.select("__id", "__same", F.posexplode(split).alias("__pos", "__line"))
    lines = lines.where(F.length("__line") >= min_chars).withColumn("__key", line_key(F.col("__line")))
    lines = lines.where(F.length("__key") >= min_chars).select(
        "__id", "__same", "__pos", F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit(7), "__key").alias("__h2"))

    frequent = (lines.select("__h1", "__h2", "__id").distinct()
                .groupBy("__h1", "__h2").agg(F.count("*").alias("__n"), F.max("__id").alias("__keeper"))
                .where(F.col("__n") >= min_docs).select("__h1", "__h2", "__keeper"))
    frequent = materialize(frequent, "frequent-lines")  # a plain table: Spark can split a hot line in the join
    dropped = (lines.join(frequent, ["__h1", "__h2"]).where(~F.col("__id").eqNullSafe(F.col("__keeper")))
               .groupBy("__id", "__same").agg(F.collect_set("__pos").alias("__dropped"))
               .select(F.col("__id").alias("__did"), F.col("__same").alias("__dsame"), "__dropped"))

    joined = base.join(dropped, F.col("__id").eqNullSafe(F.col("__did")) & (F.col("__same") == F.col("__dsame")), "left")
    n_lines = F.size(split)
    left = let(split, lambda ls: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("__dropped")), lambda i: F.get(ls, i)))
    kept = F.when(F.col("__dropped").isNull(), F.col("__text")).otherwise(F.array_join(left, "\n"))
    return unpacked(joined, docs.columns, **{
        text_col: kept, "n_lines": n_lines.cast("long"),
        "n_dropped": F.coalesce(F.size("__dropped"), F.lit(0)).cast("long")}).select(
            *docs.columns, *[c for c in ("n_lines", "n_dropped") if c not in docs.columns])
