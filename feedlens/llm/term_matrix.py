"""Sparse document-term matrix in CSR shards, with a dictionary that encodes words over the whole corpus.

A task cuts its documents into blocks of at most ``BLOCK_BYTES`` of text (a longer text is a block of its
own).  A block is one shard: a row of the shard is a document, and its columns are numbered in the order in
which the shard first meets the words.  Only the distinct words of a shard are sent on, packed by bucket of
their hash, to be encoded globally or to be given values; what comes back replaces the local numbers.  So
what is shuffled is a shard's vocabulary and its packed CSR arrays, never one row per word of a text.

A bucket holds about ``ENTRIES`` (shard, word) entries, whatever the size of the corpus: their number is
counted first.  A word is in a bucket at most once per shard, however often the texts repeat it.

Defined results: a null or blank text is an empty row; rows of equal id are rows of their own; an empty
table has no shards.  Words are maximal runs of ``[^\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlens.llm.words import LOWER, NOT_BLANK, text_buffers, word_groups
from feedlens.session import materialize

BLOCK_BYTES = 8 << 20
ENTRIES = 400_000
_FEED = pa.scalar("\n", pa.large_string())

Measure = Callable[[pa.LargeStringArray, pa.RecordBatch], dict[str, pa.Array]]


def utf8(column: pa.Array, lower: bool = False) -> pa.LargeStringArray:
    """The texts (null: empty) with their bytes in a buffer of their own, A-Z lower-cased if asked for."""
    data, offsets = text_buffers(column)
    part = data[offsets[0]:offsets[-1]]
    part = LOWER[part] if lower else part
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(part))


def _least(values: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest unsigned type."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def pack(values: np.ndarray) -> bytes:
    """An array of whole numbers as bytes: its item size, then its items."""
    small = _least(values)
    return bytes([small.dtype.itemsize]) + small.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    """The array in its narrow type; sums of it need a wider one."""
    return np.frombuffer(raw, f"u{raw[0]}", offset=1)


def csr(texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, indptr, terms, counts): row i has ``counts[j]`` of ``words[terms[j]]`` for indptr[i] <= j < indptr[i + 1]."""
    cut = pc.ascii_split_whitespace(texts)
    flat, row = pc.list_flatten(cut), pc.list_parent_indices(cut)
    some = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(some).dictionary_encode()
    width = max(1, len(coded.dictionary))
    key, counts = np.unique(row.filter(some).to_numpy() * width + coded.indices.to_numpy(zero_copy_only=False),
                            return_counts=True)
    indptr = np.searchsorted(key, np.arange(len(texts) + 1, dtype=np.int64) * width)
    return coded.dictionary, indptr, key % width, counts


def _blocks(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive rows of at most ``BLOCK_BYTES`` of text."""
    _, offsets = text_buffers(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1))
        yield at, to
        at = to


def joined(words: pa.Array) -> str:
    """Words hold no blanks, so a line feed parts them."""
    one = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words)
    return pc.binary_join(one, _FEED)[0].as_py()


def parted(text: str) -> pa.Array:
    return pc.list_flatten(pc.split_pattern(pa.array([text], pa.large_string()), "\n")) if text else pa.array([], pa.large_string())


def term_shards(rows: DataFrame, text_col: str, lower: bool = False, measure: Measure | None = None,
                measured: str = "", weight_col: str | None = None) -> DataFrame:
    """One row per shard, written to the shared folder: ``shard``, ``rows`` (the other columns of ``rows`` and
    the measured ones, a struct per document), ``indptr``, ``terms``, ``counts`` (packed CSR), ``words``, ``n_terms``.

    ``measure`` computes further columns (``measured``: their DDL) from the texts of a block.  ``weight_col``: a
    boolean column; ``weight`` then holds, packed, how often the rows where it is true hold each word.
    """
    kept = [c for c in rows.columns if c != text_col]
    extra = T.StructType.fromDDL(measured).fields if measured else []
    row_type = T.StructType([*[rows.schema[c] for c in kept], *extra])
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("rows", T.ArrayType(row_type)),
        *[T.StructField(c, T.BinaryType()) for c in ("indptr", "terms", "counts")], T.StructField("words", T.StringType()),
        T.StructField("n_terms", T.LongType()), T.StructField("weight", T.BinaryType())])
    fields = to_arrow_schema(row_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = batch.column(text_col)
            for a, b in _blocks(column):
                part, raw = batch.slice(a, b - a), utf8(column.slice(a, b - a))
                words, indptr, terms, counts = csr(utf8(raw, lower=True) if lower else raw)
                more = measure(raw, part) if measure else {}
                values = [part.column(f.name) if f.name in kept else more[f.name] for f in fields]
                struct = pa.StructArray.from_arrays([v.cast(f.type) for v, f in zip(values, fields, strict=True)], fields=list(fields))
                weight = None
                if weight_col:
                    on = part.column(weight_col).fill_null(False).to_numpy(zero_copy_only=False)
                    weight = pack(np.bincount(terms, counts * np.repeat(on, np.diff(indptr)), len(words)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), struct),
                    *[pa.array([pack(x)], pa.binary()) for x in (indptr, terms, counts)], pa.array([joined(words)]),
                    pa.array([len(words)], pa.int64()), pa.array([weight], pa.binary())], names=schema.names)
                number += 1
                pa.default_memory_pool().release_unused()
    return materialize(rows.mapInArrow(run, schema), "term-shards")


def _hashes(text: str) -> np.ndarray:
    """A hash of each word; it only deals them to buckets."""
    return np.concatenate([h for _, _, h, _, _ in word_groups(pa.array([text], pa.large_string()), NOT_BLANK)])


def entries(shards: DataFrame) -> tuple[DataFrame, int]:
    """((bucket, shard, words, places, weight), number of buckets): the words of each shard by bucket of their hash.

    ``places``: packed local numbers of the words in the shard; ``weight``: packed, as in the shard.
    """
    total = shards.agg(F.sum("n_terms")).first()[0] or 0
    buckets = max(1, -(-total // ENTRIES))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, text, weight in zip(*[batch.column(c) for c in ("shard", "words", "weight")], strict=True):
                if not (text := text.as_py()):
                    continue
                words, weight = parted(text), weight.as_py()
                where = (_hashes(text) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                order = np.argsort(where, kind="stable")
                cuts = np.searchsorted(where[order], np.arange(buckets + 1, dtype=np.uint64))
                lists = pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), words.take(pa.array(order)))
                used = np.flatnonzero(np.diff(cuts))
                given = unpack(weight)[order] if weight else None
                at = [slice(cuts[r], cuts[r + 1]) for r in used.tolist()]
                yield pa.RecordBatch.from_arrays([
                    pa.array(used, pa.int64()), pa.array([shard.as_py()] * len(used), pa.int64()),
                    pc.binary_join(lists, _FEED).take(pa.array(used)).cast(pa.string()),
                    pa.array([pack(order[s]) for s in at], pa.binary()),
                    pa.array([None if given is None else pack(given[s]) for s in at], pa.binary())],
                    names=["bucket", "shard", "words", "places", "weight"])
    schema = "bucket bigint, shard bigint, words string, places binary, weight binary"
    return shards.select("shard", "words", "weight").mapInArrow(deal, schema), buckets


def words_of(table: pa.Table) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of a bucket, encoded, and where each entry row begins."""
    parts = [parted(x) for x in table.column("words").to_pylist()]
    whole = pa.concat_arrays(parts) if parts else pa.array([], pa.large_string())
    return whole.dictionary_encode(), np.cumsum([0, *map(len, parts)])


def given_back(shards: DataFrame, values: DataFrame, use: Callable[[dict, list[dict]], Iterator[pa.RecordBatch]],
               schema: str | T.StructType) -> DataFrame:
    """``use(shard row, rows of values of that shard)`` for each shard, one shard at a time."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [x for row in left.to_pylist() for x in use(row, right.to_pylist())]
        return pa.Table.from_batches(out, arrow) if out else arrow.empty_table()
    payload = shards.select("shard", "rows", "indptr", "terms", "counts", "n_terms")
    return payload.groupBy("shard").cogroup(values.groupBy("shard")).applyInArrow(each, schema)


def document_term_matrix(shards: DataFrame, use: Callable[[dict], Iterator[pa.RecordBatch]] | None = None,
                         schema: str | T.StructType | None = None) -> DataFrame:
    """The shards with global column numbers: ``shard``, ``rows``, ``indptr``, ``columns``, ``counts`` (packed CSR).

    The number of a word is the same in every shard, and no other word has it: its place among the distinct
    words of its bucket, times the number of buckets, plus the bucket.  With ``use``, what that makes of each
    shard (a dict) is returned instead, without a way back through the JVM; ``schema`` is its schema.
    """
    dealt, buckets = entries(shards)

    def encode(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        coded, starts = words_of(table)
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * buckets + key[0].as_py()
        return pa.table({"shard": table.column("shard"), "places": table.column("places"),
                         "numbers": pa.array([pack(number[a:b]) for a, b in zip(starts, starts[1:])], pa.binary())})
    numbers = dealt.groupBy("bucket").applyInArrow(encode, "shard bigint, places binary, numbers binary")
    matrix = T.StructType([shards.schema[c] for c in ("shard", "rows", "indptr")] + [
        T.StructField("columns", T.BinaryType()), shards.schema["counts"]])
    arrow = to_arrow_schema(matrix)

    def encoded(row: dict, found: list[dict]) -> Iterator[pa.RecordBatch]:
        number = np.zeros(row["n_terms"], np.int64)
        for x in found:
            number[unpack(x["places"])] = unpack(x["numbers"])
        row = {"shard": row["shard"], "rows": row["rows"], "indptr": row["indptr"], "counts": row["counts"],
               "columns": pack(number[unpack(row["terms"])])}
        if use:
            yield from use(row)
        else:
            yield pa.RecordBatch.from_pylist([row], schema=arrow)
    return given_back(shards, numbers, encoded, schema or matrix)


def row_sums(values: np.ndarray, indptr: np.ndarray) -> np.ndarray:
    """The sum of each CSR row (an empty one: 0), in whole numbers."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[indptr])
