"""Conflict-constrained best-fit packing of documents into bins of fixed length.

A document is cut into pieces of at most ``capacity``; full pieces are bins of their own.  The others are
packed in decreasing length: bins are ordered by what is left in them and carry bitmaps of the sources and
duplicate clusters they hold; from the tightest bin that is long enough the search goes on to the next ones
until it finds a compatible one, else a bin is opened.  So no bin holds two pieces of one source or of one
duplicate cluster.

Pieces are dealt to tasks by a hash of document and piece, in groups of about ``GROUP`` pieces, so that
neither a large source nor a large cluster meets in one task; the groups are independent and a lost one is
packed again to the same bins.  Only narrow columns are shuffled, no texts.

``pack_texts`` takes the groups of near copies as clusters: the components of ``similarity_join``, and
equal texts where a text has no words.

Defined results: lengths that are null or below one make no piece, or with ``empty`` a row of length 0
without a bin; a null source or cluster conflicts with
nothing; rows of equal id are told apart by their order number in the group; an empty table gives an empty
table.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import similarity_join
from feedlens.llm.columns import text_of
from feedlens.session import materialize

GROUP = 4096


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, start) of each piece; the pieces come in the order in which they are placed."""
    bit: dict = {}
    bins: list[tuple[int, int]] = []      # (left, bin), ascending
    holds: list[tuple[int, int]] = []     # per bin: bitmaps of sources and of clusters
    at: list[tuple[int, int]] = []
    for n, source, cluster in zip(lengths, sources, clusters, strict=True):
        s = 0 if source is None else 1 << bit.setdefault(("source", source), len(bit))
        c = 0 if cluster is None else 1 << bit.setdefault(("cluster", cluster), len(bit))
        i = bisect_left(bins, (n, -1))
        while i < len(bins) and (holds[bins[i][1]][0] & s or holds[bins[i][1]][1] & c):
            i += 1
        if i < len(bins):
            left, k = bins.pop(i)
            holds[k] = (holds[k][0] | s, holds[k][1] | c)
        else:
            left, k = capacity, len(holds)
            holds.append((s, c))
        at.append((k, capacity - left))
        if left > n:
            insort(bins, (left - n, k))
    return at


def pack(docs: DataFrame, id_col: str, length_col: str, source_col: str, cluster_col: str, capacity: int,
         empty: bool = False) -> DataFrame:
    """One row per piece: id, ``piece``, ``piece_start`` and ``piece_length`` in the document, ``bin``, ``bin_start``.

    ``bin`` is a long that is unique in the result; a bin's pieces do not overlap and fit into ``capacity``.
    ``empty`` adds a row of length 0 with a null bin for each document without a piece.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{length_col}`").cast("long").alias("length"),
                       F.col(f"`{source_col}`").cast("string").alias("source"),
                       F.col(f"`{cluster_col}`").cast("long").alias("cluster"))
    none_of = rows.where("length is null or length <= 0")
    rows = rows.where("length > 0")
    last = F.floor((F.col("length") - 1) / capacity)
    pieces = rows.select("id", "length", "source", "cluster", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * capacity
    pieces = pieces.select("id", "source", "cluster", "piece", start.alias("piece_start"),
                           F.least(F.col("length") - start, F.lit(capacity)).alias("piece_length"))
    n = pieces.count()
    groups = max(1, -(-n // GROUP))
    pieces = pieces.withColumn("group", F.pmod(F.xxhash64("id", "piece", "source", "cluster"), F.lit(groups)))

    def place(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["piece_length", "id", "piece", "source", "cluster"], kind="stable",
                                ascending=[False, True, True, True, True])
        none = lambda c: [None if x != x else x for x in part[c].tolist()]
        at = best_fit(part["piece_length"].tolist(), none("source"), none("cluster"), capacity)
        part = part.assign(bin=[(int(key[0]) << 32) + k for k, _ in at], bin_start=[s for _, s in at])
        return part[["id", "piece", "piece_start", "piece_length", "bin", "bin_start"]]
    schema = f"id {kind}, piece bigint, piece_start bigint, piece_length bigint, bin bigint, bin_start bigint"
    placed = pieces.groupBy("group").applyInPandas(place, schema)
    if empty:
        zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
        placed = placed.unionByName(none_of.select("id", zero.alias("piece"), zero.alias("piece_start"), zero.alias(
            "piece_length"), null.alias("bin"), null.alias("bin_start")))
    return placed.withColumnRenamed("id", id_col)


def pack_texts(docs: DataFrame, capacity: int, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """``pack`` of the UTF-8 bytes of every text, with near copies as clusters and a row for each empty text."""
    text = text_of(docs, text_col)
    # what the packing needs travels through the join as the id, so no join by an id that may repeat
    keyed = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text"), F.octet_length(text).alias(
        "length"), F.col(f"`{source_col}`").cast("string").alias("source")).alias("key"), text.alias("text"))
    found = similarity_join.jaccard_components(keyed, "key", "text")
    cluster = F.when(F.col("n_shingles") > 0, F.xxhash64("component_id")).otherwise(F.col("key.text"))
    sized = found.select(F.col("key.id").alias(id_col), F.col("key.length").alias("length"),
                         F.col("key.source").alias("source"), cluster.alias("cluster"))
    return pack(materialize(sized, "pack-sized"), id_col, "length", "source", "cluster", capacity, empty=True)
