"""Merkle manifest of a table by time-forward processing (Chiang et al., 1995).

Every group of rows (a source) has a tree of fan-out 16 over its leaves, and a tree of the same kind over the
groups' roots gives the root of the table.  Nodes are labelled in post-order, (group, last leaf below, level), so
children come before their parent.

*Forward.*  A node's digest is a message to its parent, and messages wait in a priority queue ordered by the
parent's label.  The queue is Spark's range-partitioned external sort; within a task it goes on as a heap: the
task pops all messages of the smallest label, and if all children are there it hashes them and pushes the digest
on to the next parent.  A parent whose children lie on both sides of a partition's bound cannot be hashed there;
those messages (a few dozen a partition) are the next round's queue, with fewer partitions, until none is left.

*Reversed.*  The rounds are swept backwards, each task in descending label order: a node receives the suffix of
the proof from its parent, prepends the siblings of each of its children and sends it on; what belongs to an
earlier round goes to the partition that hashed that child.  What arrives at the last level is joined to the
leaves, one row per run of 16.

No tree, level or group passes through one task: a task holds its heap, which is at most 16 messages a level.

Defined results: nulls in any column are hashed as ``-``; a null id is ordered first and never tampered; rows of
equal id are ordered by their digest, and equal rows are leaves of their own; a null source is a group of its
own, before all others; an empty table gives an empty result; texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlens.session import materialize

FAN_OUT_BITS = 4
FAN_OUT = 1 << FAN_OUT_BITS
PER_TASK = 50_000   # messages of a task in the rounds after the first

_PATH = "array<struct<left: string, right: string>>"
_ARROW_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of the columns, each as its byte count, a colon and its value, or ``-``."""
    return F.sha2(F.concat(*[_field(c) for c in columns]), 256)


def group_key(c: Column) -> Column:
    """A string that is never null and orders as the column does, nulls first."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with ``i``, the place of a row in its group ``g`` by ``order``, and ``n``, the size of the group."""
    spark = leaves.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["g", *order]
    ranged = leaves.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema) + ", part int, seq bigint"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            seq = []
            for g in batch.column("g").to_pylist():
                group, at = g, at + 1 if g == group else 0
                seq.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(seq), pa.int32()), pa.array(seq, pa.int64())],
                                             names=[*batch.schema.names, "part", "seq"])
    placed = materialize(ranged.mapInArrow(number, schema), "merkle-placed")
    counts = placed.groupBy("g", "part").agg(F.count("*").alias("c"))  # at most one row per part and one per group more
    by = W.partitionBy("g")
    before = by.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(F.col("g").alias("og"), F.col("part").alias("op"), F.sum("c").over(by).alias("n"),
                            F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"))
    offsets = materialize(offsets, "merkle-offsets")
    return placed.join(offsets, (F.col("g") == F.col("og")) & (F.col("part") == F.col("op"))).select(
        *leaves.columns, "n", (F.col("start") + F.col("seq")).alias("i"))


def height(n: int) -> int:
    """Level of the root over ``n`` leaves."""
    h = 0
    while 1 << FAN_OUT_BITS * h < n:
        h += 1
    return h


def _end(n: int, level: int, i: int) -> int:
    """The leaf after the last one below the node."""
    return min(n, (i + 1) << FAN_OUT_BITS * level)


def _children(n: int, level: int, i: int) -> int:
    """How many nodes lie just below."""
    below = -(-n >> FAN_OUT_BITS * (level - 1))
    return min(FAN_OUT, below - (i << FAN_OUT_BITS))


def _sweep_up(round_no: int):
    """Messages in order of the parent's label -> nodes (kind 0) and messages that wait for another partition (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = round_no << 32 | TaskContext.get().partitionId()
        heap: list[tuple] = []
        out: list[dict] = []

        def push(g: str, n: int, level: int, i: int, digest: str, tag: int) -> None:
            up = i >> FAN_OUT_BITS
            heappush(heap, (g, _end(n, level + 1, up), level + 1, up, i, n, digest, tag))

        def process() -> None:
            label = heap[0][:4]
            kids = []
            while heap and heap[0][:4] == label:
                kids.append(heappop(heap))
            g, _, level, i = label
            n = kids[0][5]
            if len(kids) < _children(n, level, i):
                out.extend({"kind": 1, "g": g, "n": n, "level": level - 1, "i": k[4], "digest": k[6], "tag": k[7]} for k in kids)
                return
            whole = "".join(k[6] for k in kids)
            digest = hashlib.sha256(whole.encode()).hexdigest()
            out.append({"kind": 0, "g": g, "n": n, "level": level, "i": i, "digest": digest, "tag": mine, "children": whole,
                        "tags": [k[7] for k in kids]})
            if level < height(n):
                push(g, n, level, i, digest, mine)

        for batch in batches:
            for r in batch.to_pylist():
                up = r["i"] >> FAN_OUT_BITS
                label = (r["g"], _end(r["n"], r["level"] + 1, up), r["level"] + 1, up)
                while heap and heap[0][:4] < label:
                    process()
                push(r["g"], r["n"], r["level"], r["i"], r["digest"], r["tag"])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_NODES)
                out.clear()
        while heap:
            process()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_NODES)
    return run


_NODES = pa.schema([("kind", pa.int32()), ("g", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("i", pa.int64()),
                    ("digest", pa.string()), ("tag", pa.int64()), ("children", pa.string()), ("tags", pa.list_(pa.int64()))])
_NODES_DDL = ("kind int, g string, n bigint, level int, i bigint, digest string, tag bigint, children string, "
              "tags array<bigint>")


def _level_end(level: Column, i: Column) -> Column:
    """``_end`` as an expression."""
    width = F.lit(1).cast("long")
    return F.least(F.col("n"), (i + 1) * F.call_function("shiftleft", width, level * FAN_OUT_BITS))


def _is_root() -> Column:
    """Nodes that cover all leaves of their group."""
    width = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("level") * FAN_OUT_BITS)
    return (F.col("i") == 0) & (width >= F.col("n"))


def forward(leaves: DataFrame) -> list[DataFrame]:
    """The inner nodes of all trees over ``leaves`` (g, n, i, digest), a written table for each round."""
    spark = leaves.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    waiting = leaves.where("n > 1").select("g", "n", F.lit(0).alias("level"), "i", "digest", F.lit(0).cast("long").alias("tag"))
    rounds: list[DataFrame] = []
    while True:
        up, level = F.shiftright("i", FAN_OUT_BITS), F.col("level") + 1
        queue = waiting.withColumns({"pend": _level_end(level, up), "plevel": level, "pi": up})
        label = ["g", "pend", "plevel", "pi"]
        queue = queue.repartitionByRange(parts, *label).sortWithinPartitions(*label, "i").drop(*label[1:])
        made = materialize(queue.select("g", "n", "level", "i", "digest", "tag").mapInArrow(
            _sweep_up(len(rounds) + 1), _NODES_DDL), "merkle-round")
        rounds.append(made.where("kind = 0"))
        waiting = made.where("kind = 1").select("g", "n", "level", "i", "digest", "tag")
        left = waiting.count()
        if not left:
            return rounds
        parts = 1 if parts <= 2 else max(1, min(parts // 2, -(-left // PER_TASK)))


_RUNS = pa.schema([("kind", pa.int32()), ("tag", pa.int64()), ("g", pa.string()), ("n", pa.int64()), ("level", pa.int32()),
                   ("i", pa.int64()), ("children", pa.string()), ("path", _ARROW_PATH), ("top", pa.string())])
_RUNS_DDL = f"kind int, tag bigint, g string, n bigint, level int, i bigint, children string, path {_PATH}, top string"


def _sweep_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes (kind 0) and suffixes for them (kind 1) in descending label order -> suffixes for nodes of earlier
    rounds (kind 1) and for runs of leaves (kind 2)."""
    heap: list[tuple] = []   # by descending label; the suffix that waits for each node
    for batch in batches:
        out: list[dict] = []
        for r in batch.to_pylist():
            g, n, level, i = r["g"], r["n"], r["level"], r["i"]
            label = (r["tag"], g, -_end(n, level, i), -level)
            if r["kind"] == 1:
                heappush(heap, (*label, len(heap), r["path"], r["top"]))
                continue
            found = heappop(heap)
            if found[:4] != label:
                raise ValueError(f"a node without the suffix of its proof: {label}")
            path, top, whole = found[5], found[6], r["children"]
            same = {"g": g, "n": n, "top": top}
            if level == 1:
                out.append(same | {"kind": 2, "tag": 0, "level": 0, "i": i, "children": whole, "path": path})
                continue
            for j, tag in enumerate(r["tags"]):
                down = [{"left": whole[:64 * j], "right": whole[64 * (j + 1):]}, *path]
                child = (i << FAN_OUT_BITS) + j
                if tag == r["tag"]:
                    heappush(heap, (tag, g, -_end(n, level - 1, child), 1 - level, child, down, top))
                else:
                    out.append(same | {"kind": 1, "tag": tag, "level": level - 1, "i": child, "path": down})
        yield pa.RecordBatch.from_pylist(out, schema=_RUNS)


def backward(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(g, run, children, path, top) of each run of leaves; ``tops``: (g, path, top) that the root of a group begins with."""
    null = F.lit(None)
    nodes = rounds[0].withColumn("round", F.lit(1))
    for r, x in enumerate(rounds[1:], 2):
        nodes = nodes.unionByName(x.withColumn("round", F.lit(r)))
    root = nodes.where(_is_root())
    sent = root.join(tops, "g").select(F.lit(1).alias("kind"), "tag", "g", "n", "level", "i", null.cast("string").alias("children"),
                                       F.col("path").cast(_PATH).alias("path"), "top", "round")
    sent = materialize(sent, "merkle-tops")
    runs = []
    for r in range(len(rounds), 0, -1):
        mine = sent.where(F.col("round") == r).drop("round").withColumn("tags", null.cast("array<bigint>")).unionByName(
            rounds[r - 1].select(F.lit(0).alias("kind"), "tag", "g", "n", "level", "i", "children", null.cast(_PATH).alias("path"),
                                 null.cast("string").alias("top"), "tags"))
        mine = mine.withColumn("end", _level_end(F.col("level"), F.col("i")))
        mine = mine.repartition("tag").sortWithinPartitions("tag", "g", F.desc("end"), F.desc("level"), F.desc("kind")).drop("end")
        out = materialize(mine.mapInArrow(_sweep_down, _RUNS_DDL), "merkle-proofs")
        runs.append(out.where("kind = 2").select("g", F.col("i").alias("run"), "children", "path", "top"))
        if r > 1:
            sent = sent.where(F.col("round") < r).unionByName(out.where("kind = 1").withColumn(
                "round", F.shiftright("tag", 32).cast("int")))
    found = runs[0]
    for x in runs[1:]:
        found = found.unionByName(x)
    return found


def _roots(leaves: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(g, digest) of each tree; a lone leaf is its own root."""
    roots = leaves.where("n = 1").select("g", "digest")
    for x in rounds:
        roots = roots.unionByName(x.where(_is_root()).select("g", "digest"))
    return roots


def _with_paths(leaves: DataFrame, rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``leaves`` with ``path`` (the left and right siblings on each level up to the root) and ``top``."""
    j = F.col("i").bitwiseAND(FAN_OUT - 1).cast("int")
    runs = backward(rounds, tops).select(F.col("g").alias("rg"), "run", "children", "path", "top")
    many = leaves.where("n > 1").withColumn("at", F.shiftright("i", FAN_OUT_BITS))
    many = many.join(runs, (F.col("g") == F.col("rg")) & (F.col("at") == F.col("run")))
    own = F.struct(F.substring("children", F.lit(1), j * 64).alias("left"),
                   F.substring("children", j * 64 + 65, F.lit(64 * FAN_OUT)).alias("right"))
    many = many.select(*leaves.columns, F.concat(F.array(own), "path").cast(_PATH).alias("path"), "top")
    alone = leaves.where("n = 1").join(tops.select("g", F.col("path").cast(_PATH).alias("path"), "top"), "g")
    return many.unionByName(alone.select(*many.columns))


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, digest, lambda d, x: F.sha2(F.concat(x["left"], d, x["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def manifest(leaves: DataFrame, group_col: str, order: list[str]) -> tuple[DataFrame, str | None]:
    """``leaves`` (with a hex ``digest``) with their ``subroot`` and ``path``, and the root of the table (None: it is empty).

    ``order``: columns that order the leaves of a group, before the digest.
    """
    kept = leaves.columns
    keyed = leaves.withColumn("g", group_key(F.col(f"`{group_col}`"))).withColumn("row", F.monotonically_increasing_id())
    placed = materialize(numbered(materialize(keyed, "merkle-leaves"), [*order, "digest", "row"]), "merkle-numbered")
    rounds = forward(placed)
    roots = _roots(placed, rounds)
    groups = roots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest")
    groups = materialize(numbered(groups, ["name"]), "merkle-groups")
    above = forward(groups)
    none = F.array().cast(_PATH)
    found = _roots(groups, above).select("digest").first()  # the root of the table
    if found is None:
        return placed.select(*kept, F.col("digest").alias("subroot"), none.alias("path")), None
    tops = groups.sparkSession.createDataFrame([("", found[0])], "g string, top string").withColumn("path", none)
    to_root = materialize(_with_paths(groups, above, tops).select(
        F.col("name").alias("g"), "path", F.col("digest").alias("top")), "merkle-subroots")
    proved = _with_paths(placed, rounds, to_root)
    return proved.select(*kept, F.col("top").alias("subroot"), "path"), found[0]
