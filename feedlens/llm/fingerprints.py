"""Order MinHash fingerprints (Marcais et al., 2019), in DataFrame expressions.

A text is cut into units, and its k-mers of ``K`` units are numbered by occurrence.  Units are runs of
up to 8 non-blank characters; a longer run gives its pieces of 8 one after the other (``UNIT``), or, if
``sliding``, the piece of 8 at each of its characters, so that an edit in a text without blanks changes only
the pieces around it and not all later ones.  Signature ``c`` permutes the numbered k-mers by
``hash xor (c in the top bits)``, selects the ``L`` smallest, puts them back into text order and hashes
that tuple.  Two texts agree in a signature only if the selected k-mers and their order agree, so the
likeness falls with edit distance, also where k-mers are merely rearranged.

All permutations share one sorted array of hashes: the ``L`` smallest of permutation ``c`` are among the
first ``L`` entries of each block of hashes with equal top bits, so a text of n units costs two sorts of
longs and some passes over them, whatever the number of signatures.

Defined results: a null text is an empty text; empty texts agree with each other and with no other
text; a text of fewer than ``K`` units has one k-mer; equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlens.llm.columns import ROW, count_below, let, packed, text_of, unpacked

UNIT = r"(\S{1,8})"
SLIDING = r"(?=(\S{1,8}))(?:\S(?=\S{8})|\S++)"   # steps by one character while nine or more are left of the run
K = 3
L = 2
SIGNATURE_BITS = 5          # 32 signatures
SIGNATURES = 1 << SIGNATURE_BITS
POSITION_BITS = 26          # later positions wrap; only ties among their k-mers are affected
HEX = 8                     # digits of a signature


def _kmers(text: Column, sliding: bool) -> Column:
    """array<long>: the hash of the k-mer at each position."""
    def grams(u: Column) -> Column:
        gram = lambda i: F.xxhash64(*[F.get(u, i + o) for o in range(K)])
        all_of = F.transform(F.sequence(F.lit(0), F.greatest(F.size(u) - K, F.lit(0))), gram)
        return F.when(F.size(u) > 0, all_of).otherwise(F.array().cast("array<bigint>"))
    return let(F.regexp_extract_all(text, F.lit(SLIDING if sliding else UNIT), F.lit(1)), grams)


def _pack(h: Column, position: Column) -> Column:
    """37 bits of hash above the position: a non-negative long that sorts by hash, then position."""
    return F.shiftleft(F.shiftrightunsigned(h, 27), POSITION_BITS).bitwiseOR(
        position.cast("long").bitwiseAND((1 << POSITION_BITS) - 1))


def _hash_part(x: Column) -> Column:
    return F.shiftrightunsigned(x, POSITION_BITS)


def _numbered(kmers: Column) -> Column:
    """Sorted array<long> of (hash of k-mer and its occurrence number, position)."""
    by_kmer = F.sort_array(F.transform(kmers, _pack))

    def number(s: Column) -> Column:
        def one(x: Column, j: Column) -> Column:
            run = F.shiftleft(_hash_part(x), POSITION_BITS)
            before = F.when((j > 0) & (F.get(s, j - 1) >= run), j - count_below(s, F.size(s), 1 << POSITION_BITS, run)).otherwise(F.lit(0))
            return _pack(F.xxhash64(_hash_part(x), before), x)
        return F.sort_array(F.transform(s, one))
    return let(by_kmer, number)


def fingerprint(text: Column, sliding: bool = False) -> Column:
    """The fingerprint string: ``SIGNATURES`` groups of ``HEX`` hexadecimal digits."""
    block = lambda x: F.shiftrightunsigned(x, 63 - SIGNATURE_BITS)

    def of(kmers: Column) -> Column:
        def heads(s: Column) -> Column:
            return F.filter(s, lambda x, j: (j < L) | (block(F.get(s, j - L)) != block(x)))

        def signatures(c: Column) -> Column:
            def one(i: Column) -> Column:
                mask = F.shiftleft(i.cast("long"), 63 - SIGNATURE_BITS)
                least = F.when(F.size(c) == SIGNATURES * L, F.slice(c, i * L + 1, F.lit(L))).otherwise(
                    F.slice(F.sort_array(F.transform(c, lambda x: x.bitwiseXOR(mask))), F.lit(1), F.lit(L)))
                in_order = F.sort_array(F.transform(least, lambda x: x.bitwiseAND((1 << POSITION_BITS) - 1)))
                tuple_ = F.transform(in_order, lambda p: F.get(kmers, p.cast("int")))
                return F.right(F.lpad(F.lower(F.hex(F.xxhash64(tuple_))), 16, "0"), F.lit(HEX))
            return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(SIGNATURES - 1)), one), "")
        return let(let(_numbered(kmers), heads), signatures)
    return let(_kmers(text, sliding), of)


def likeness(a: Column, b: Column) -> Column:
    """Share of signatures in which two fingerprints agree, 0 to 1."""
    same = F.filter(F.sequence(F.lit(0), F.lit(SIGNATURES - 1)),
                    lambda i: F.substring(a, i * HEX + 1, F.lit(HEX)) == F.substring(b, i * HEX + 1, F.lit(HEX)))
    return F.size(same) / F.lit(float(SIGNATURES))


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint",
                 sliding: bool = False) -> DataFrame:
    """``docs`` with the fingerprint of each text in ``out_col`` (replaced if present)."""
    return docs.withColumn(out_col, fingerprint(text_of(docs, text_col), sliding))


def with_next(docs: DataFrame, id_col: str, next_cols: dict[str, str], tie_cols: list[str]) -> DataFrame:
    """``docs`` with columns of the next row in descending ``id_col`` (after the last row: the first).

    The rows are dealt to ranges of ids between exact ids of the table (approximate quantiles, a bounded
    number), and the first row of a range is copied to the end of the range before it; so each range finds
    all its successors in a small window of its own.  The id is numeric; null ids come last; equal ids are
    ordered by ``tie_cols``.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx(id_col, cuts, max(10_000, 20 * ranges)).alias("cuts"),
                     F.max(id_col).alias("top")).first()
    top = found["top"]
    marks = sorted({c for c in found["cuts"] or [] if c < top})
    marks_col = F.from_json(F.lit(str(marks)), f"array<{docs.schema[id_col].dataType.simpleString()}>")

    own = count_below(marks_col, F.lit(len(marks)), len(marks), F.col("__id"))
    at = docs.select(packed(docs), docs[id_col].alias("__id")).withColumn("__range", own)
    place = lambda r, kind: F.struct(r.alias("range"), F.lit(kind).alias("kind"))
    places = F.array_compact(F.array(
        place(F.col("__range"), 0),
        F.when(F.get(marks_col, F.col("__range")) == F.col("__id"), place(F.col("__range") + 1, 1)),
        F.when(F.col("__id").eqNullSafe(F.lit(top)), place(F.lit(0), 2))))
    dealt = at.select(ROW, "__id", F.explode(places).alias("__at"))
    ties = [o for c in tie_cols for o in (F.xxhash64(F.col(ROW)[c]), F.col(ROW)[c])]
    w = W.partitionBy("__at.range").orderBy("__at.kind", F.col("__id").desc_nulls_last(), *ties)
    follow = {f"__next_{k}": F.lead(F.col(ROW)[c]).over(w) for k, c in next_cols.items()}
    joined = dealt.withColumns(follow).where(F.col("__at.kind") == 0)
    return unpacked(joined, docs.columns, **{k: F.col(f"__next_{k}") for k in next_cols})
