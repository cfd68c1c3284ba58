"""N-gram Jaccard self-join by a grouped prefix join, exact at the threshold, and its components.

A document is the set of its distinct word shingles (64-bit hashes).  Equal sets are one node from the
start.  The plan:

1. *Counts.*  Each task cuts its documents into shingles, once, and sends the documents' set names and the shingles, packed by range of hash, to one
   reducer per range, which finds in how many distinct sets each shingle occurs.  Shingles of a single set
   can match nothing: they are only counted.  A node keeps its shared shingles, rarest first.
2. *Prefixes.*  Two sets of sizes n and m with Jaccard likeness t or more share a shingle among the first
   n - ceil(t n) + 1 of each, in any one order of all shingles.  In the order by rarity the unshared ones
   come first, so many prefixes are empty and those nodes are done.
3. *Groups.*  Nodes of equal size and equal prefix are one group, indexed once.  Group pairs that meet
   under a shingle are filtered by size and by how many shingles they share with any set at all.
4. *Verification.*  Group pairs are expanded to members and the shared shingles intersected.  First every
   node is held against one leader per group and per index entry (the one with the most shared
   shingles); pairs that are thereby connected need no look for the components, and only pairs from
   different components are then looked at; bitmaps of the shared shingles bound their overlap within
   the join, and what passes is verified.  So a large group of near copies costs links in proportion to
   its members, and none is lost: every pair that could link is verified or already connected.

Defined results: a null or blank text has no shingles and links with nothing; a text of fewer words than
``k`` is one shingle; rows of equal text share everything; null ids are smaller than none (a component
takes its smallest non-null id); an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.columns import let
from feedlens.llm.components import connected_components
from feedlens.llm.words import NOT_BLANK, chained, mix, word_groups
from feedlens.session import materialize

K = 5
WORDS = 16                        # 64-bit words of the bitmap that bounds the overlap of a pair
NUMERATOR, DENOMINATOR = 4, 5     # likeness of at least 4 / 5
FLUSH = 500_000                   # shingles that a task packs at a time


def set_groups(column: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of consecutive texts: the size of each one's set, its 64-bit name, and the sorted sets one after the other.

    Everything but the sort is done for a group of texts at once.
    """
    for _, bounds, h, _, _ in word_groups(column, NOT_BLANK):
        words = np.diff(bounds)
        counts = np.where(words >= k, words - k + 1, np.minimum(words, 1))
        cuts = np.concatenate([[0], np.cumsum(counts)])
        flat = np.zeros(cuts[-1], np.uint64)
        if len(h) >= k:
            at = np.arange(len(h) - k + 1)
            inside = at + k <= np.repeat(bounds[1:], words)[:len(at)]  # a window does not go on into the next text
            flat[np.repeat(words >= k, counts)] = chained(h, k)[inside]
        for d in np.flatnonzero((words > 0) & (words < k)).tolist():
            flat[cuts[d]] = chained(h[bounds[d]:bounds[d + 1]], k)[0]
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            flat[a:b].sort()
        new = np.ones(len(flat), bool)
        new[1:] = flat[1:] != flat[:-1]
        new[cuts[:-1][counts > 0]] = True
        kept = np.concatenate([[0], np.cumsum(new)])[cuts]
        sizes, flat = np.diff(kept), flat[new]
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(mix(flat + np.repeat(sizes, sizes).astype(np.uint64)), out=sums[1:])
        yield sizes, (sums[kept[1:]] - sums[kept[:-1]]).astype(np.int64), flat


def _range_of(shingles: np.ndarray, ranges: int) -> np.ndarray:
    where = ((shingles >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return where.astype(np.uint16 if ranges <= 1 << 16 else np.uint32)


def shingled(docs: DataFrame, id_col: str, text_col: str, k: int, ranges: int) -> DataFrame:
    """One pass over the texts: (id, node, n) of each document, its set's name and size, with a null shingle and df, and
    (node, n, shingle, df) of each shingle that at least two distinct sets hold, with a null id.

    Shingles travel as their range and a 32-bit rest, 32 + log2(ranges) bits.  Two that agree there count as one:
    two in different sets add to the overlap of a pair, two in one set lower it.  A text of 1,000 shingles has
    such a pair of its own with a probability of about 5e5 / (ranges x 2**32).
    """
    packs = [("range", pa.int64()), *[(c, pa.binary()) for c in ("rest", "counts", "nodes", "sizes")]]
    named = ["id", "node", "n"]

    def both(batch: pa.RecordBatch, kind: pa.DataType) -> pa.RecordBatch:
        """Packs (ranges 0 and up) and named documents (``ranges`` and up) have the same columns."""
        every = pa.schema([*packs, ("id", kind), ("node", pa.int64()), ("n", pa.int64())])
        return pa.RecordBatch.from_arrays([batch.column(f.name) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type)
                                           for f in every], schema=every)

    def pack(nodes: list[np.ndarray], sizes: list[np.ndarray], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        node, size = np.concatenate(nodes), np.concatenate(sizes).astype(np.int32)
        at = np.repeat(np.arange(len(node), dtype=np.uint32), size)
        every = np.concatenate(sets)
        where = _range_of(every, ranges)
        order = np.argsort(where, kind="stable")
        every, at = mix(every[order]).astype(np.uint32), at[order]
        cuts = np.searchsorted(where[order], np.arange(ranges + 1))
        rows = []
        for r in np.flatnonzero(np.diff(cuts)).tolist():
            mine = at[cuts[r]:cuts[r + 1]]
            new = np.empty(len(mine), bool)   # sets follow each other within a range
            new[0], new[1:] = True, mine[1:] != mine[:-1]
            holders, each = mine[new], np.diff(np.flatnonzero(np.append(new, True))).astype(np.uint32)
            rows.append((r, every[cuts[r]:cuts[r + 1]].tobytes(), each.tobytes(), node[holders].tobytes(), size[holders].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)],
                                         schema=pa.schema(packs))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sizes, sets, seen, held = [], [], [], set(), 0
        for batch in batches:
            kind, of = batch.schema.field("id").type, []
            for size, name, flat in set_groups(batch.column("text"), k):
                of.append((size, name))
                new = np.zeros(len(size), bool)
                for d, (x, n) in enumerate(zip(name.tolist(), size.tolist())):
                    if n and x not in seen:
                        seen.add(x)
                        new[d] = True
                nodes.append(name[new])
                sizes.append(size[new])
                sets.append(flat if new.all() else flat[np.repeat(new, size)])
                held += len(sets[-1])
                if held >= FLUSH:
                    yield from (both(b, kind) for b in pack(nodes, sizes, sets))
                    nodes, sizes, sets, seen, held = [], [], [], set(), 0
            if batch.num_rows:
                size, name = (np.concatenate(x) for x in zip(*of))
                yield both(pa.RecordBatch.from_arrays(
                    [pa.array(ranges + np.arange(len(size)) % ranges), batch.column("id"), pa.array(name, mask=size == 0),
                     pa.array(size, pa.int64())], ["range", *named]), kind)
        if held:
            yield from (both(b, kind) for b in pack(nodes, sizes, sets))

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() >= ranges:
            none = pa.nulls(len(table), pa.int64())
            return pa.table({c: table.column(c) for c in named} | {"shingle": none, "df": none})
        whole = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        rest, counts = whole("rest", np.uint32), whole("counts", np.uint32)
        nodes, sizes = whole("nodes", np.int64), whole("sizes", np.int32)
        distinct, holder = np.unique(nodes, return_inverse=True)  # a set may come from several tasks
        n_of = np.zeros(len(distinct), np.int64)
        n_of[holder] = sizes
        pair = np.unique(rest.astype(np.uint64) << np.uint64(32) | np.repeat(holder, counts).astype(np.uint64))
        rest, holder = pair >> np.uint64(32), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, rest[1:] != rest[:-1])) if len(rest) else np.zeros(0, np.int64)
        df = np.repeat(np.diff(starts, append=len(rest)), np.diff(starts, append=len(rest)))
        some = df >= 2
        shingle = (rest[some] | np.uint64(int(key[0].as_py()) << 32)).astype(np.int64)
        return pa.table({"id": pa.nulls(int(some.sum()), table.schema.field("id").type), "node": distinct[holder[some]], "n": n_of[holder[some]], "shingle": shingle,
                         "df": df[some].astype(np.int64)})

    kind = docs.schema[id_col].dataType.simpleString()
    packed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(
        send, f"range bigint, rest binary, counts binary, nodes binary, sizes binary, id {kind}, node bigint, n bigint")
    return packed.groupBy("range").applyInArrow(count, f"id {kind}, node bigint, n bigint, shingle bigint, df bigint")


def _prefix_length(n: Column) -> Column:
    """n - ceil(t n) + 1."""
    return n - F.floor((n * NUMERATOR + DENOMINATOR - 1) / DENOMINATOR).cast("long") + 1


def _possible(n1: Column, s1: Column, n2: Column, s2: Column) -> Column:
    """Sizes n with s shared shingles allow the likeness: overlap is at most the smaller s and the smaller n."""
    top = F.least(s1, s2)
    return top * (NUMERATOR + DENOMINATOR) >= (n1 + n2) * NUMERATOR


def _bits(shared: Column) -> Column:
    """The shared shingles as a bitmap of 64 * ``WORDS`` bits."""
    mixed = F.transform(shared, lambda x: F.xxhash64(x))
    word = lambda m, w: F.aggregate(F.filter(m, lambda x: x.bitwiseAND(WORDS - 1) == w), F.lit(0).cast("long"),
                                    lambda bits, x: bits.bitwiseOR(_bit(x)))
    return let(mixed, lambda m: F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: word(m, w)))


def _bit(x: Column) -> Column:
    """One of 64 bits, chosen by bits 8 to 13."""
    powers = F.lit([1 << b if b < 63 else -1 << 63 for b in range(64)])
    return F.get(powers.cast("array<bigint>"), F.shiftrightunsigned(x, 8).bitwiseAND(63).cast("int"))


def _missing(bits1: Column, bits2: Column) -> Column:
    """At least so many shingles of the first set are not in the second: bits that only the first has."""
    only = F.zip_with(bits1, bits2, lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b))))
    return F.aggregate(only, F.lit(0), lambda n, c: n + c).cast("long")


def _links(shared1: Column, n1: Column, shared2: Column, n2: Column) -> Column:
    """Likeness reached: overlap / (n1 + n2 - overlap) >= t, in integers."""
    return F.size(F.array_intersect(shared1, shared2)) * (NUMERATOR + DENOMINATOR) >= (n1 + n2) * NUMERATOR


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that link.  Each shared list travels once per pair on one side, once on the other."""
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    return pairs.join(right, "b").join(left, "a").where(
        _links(F.col("sa"), F.col("na"), F.col("sb"), F.col("nb"))).select("a", "b")


def similar_links(shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, components) between names of distinct shingle sets, from (node, n, shingle, df).

    ``links``: verified pairs (a, b) that connect each component; ``components``: (node, root).
    """
    nodes = shared.groupBy("node").agg(F.first("n").alias("n"), F.sort_array(
        F.collect_list(F.struct("df", "shingle"))).alias("by_rarity"))
    s = F.size("by_rarity").cast("long")
    in_prefix = _prefix_length(F.col("n")) - (F.col("n") - s)
    nodes = nodes.where(in_prefix > 0).select(
        "node", "n", s.alias("s"), F.col("by_rarity.shingle").alias("shared"), in_prefix.cast("int").alias("p"))
    nodes = materialize(nodes, "join-nodes")

    # groups of equal size and prefix; a group is named by its smallest node, and that node leads it
    prefix = F.slice("shared", 1, F.col("p"))
    member = nodes.select("node", "n", "s", F.xxhash64("n", "s", prefix).alias("key"), prefix.alias("prefix"))
    group = member.groupBy("key").agg(F.min("node").alias("gid"), F.first("n").alias("n"), F.first("s").alias("s"),
                                      F.min_by("prefix", "node").alias("prefix"))
    group = materialize(group, "join-groups")
    members = materialize(member.select("node", "key").join(group.select("key", "gid"), "key").select("node", "gid"),
                          "join-members")
    held = members.groupBy("gid").agg(F.count("*").alias("held"))
    entries = group.join(held, "gid").select("gid", "n", "s", "held", F.explode("prefix").alias("shingle"))

    # one leader per index entry: the group with the most shared shingles
    leader = entries.groupBy("shingle").agg(F.min(F.struct((-F.col("s")).alias("o"), "gid", "n", "s")).alias("top"),
                                            F.sum("held").alias("size")).where(F.col("size") > 1)
    index = materialize(entries.join(leader.select("shingle", "top"), "shingle"), "join-index")
    led = index.where((F.col("gid") != F.col("top.gid")) & _possible(
        F.col("n"), F.col("s"), F.col("top.n"), F.col("top.s"))).select("gid", F.col("top.gid").alias("lead")).distinct()
    stars = (led.join(members, "gid").select(F.col("node").alias("a"), F.col("lead").alias("b"))
             .unionByName(members.where("node <> gid").select(F.col("node").alias("a"), F.col("gid").alias("b")))).distinct()
    first = materialize(_verified(stars, nodes), "join-stars")
    known = connected_components(first, "a", "b")

    # pairs of members that meet under a shingle (or in a group) and are not connected yet
    placed = members.join(
        known.withColumnRenamed("node", "known"), F.col("node") == F.col("known"), "left").select(
            "node", "gid", F.coalesce("root", "node").alias("root"))
    placed = materialize(placed, "join-placed")
    entry = index.select("shingle", "gid").join(placed, "gid").select("shingle", "node", "root")
    several = entry.groupBy("shingle").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2")
    rows = materialize(entry.join(several.select("shingle"), "shingle").join(
        nodes.select("node", "n", "s", _bits(F.col("shared")).alias("bits")), "node"), "join-open")
    x, y = (rows.select("shingle", *[F.col(c).alias(f"{c}{i}") for c in ("node", "n", "s", "root", "bits")]) for i in (1, 2))
    met = x.join(y, "shingle").where(
        (F.col("node1") < F.col("node2")) & (F.col("root1") != F.col("root2"))
        & _possible(F.col("n1"), F.col("s1"), F.col("n2"), F.col("s2"))
        & _possible(F.col("n1"), F.col("s1") - _missing(F.col("bits1"), F.col("bits2")),
                    F.col("n2"), F.col("s2") - _missing(F.col("bits2"), F.col("bits1"))))
    more = _verified(met.select(F.col("node1").alias("a"), F.col("node2").alias("b")).distinct(), nodes)
    links = materialize(first.unionByName(more), "join-links")
    return links, connected_components(links, "a", "b")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(id, n_shingles, component_id) of every row: the smallest id that links reach."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = materialize(shingled(docs, id_col, text_col, k, ranges), "join-sets")
    sets = once.where("shingle is null").select("id", "node", "n")
    _, parts = similar_links(once.where("shingle is not null").select("node", "n", "shingle", "df"))
    least = sets.where("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    rooted = least.join(parts.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left").select(
        "node", "least", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of_node = rooted.join(smallest, "root").select(F.col("node").alias("of"), "component")
    out = sets.join(of_node, F.col("node") == F.col("of"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "id").alias("component_id"))
