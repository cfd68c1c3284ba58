"""One large JSON document, read in parallel by byte ranges.

The published files are single documents: an object keyed by id, alone or as a field of the document.  Spark's JSON
reader takes such a file as one row in one task.  Here the text source cuts the file at commas, which it
can do from any byte range, and three passes find the entries of the object:

1. Each range is scanned twice, as if it began outside and inside a string, and tells for each case in which state it
   ends, how the nesting depth changes, how many commas lie on each depth (in all, and since the last one on a lower
   depth), and the last key and opening bracket on each depth.
2. These few numbers per range are chained in file order, which fixes state, depth, entry number and key at the
   start of every range.
3. Each range is scanned once more and gives out its entries.  Only the first and last entry of a range can go
   on in another one; those pieces are joined by entry number.

No task holds more than a range and the longest entry, or with ``keyed_members`` the longest member of an entry's list.  Documents must be valid JSON in UTF-8; broken documents give
entries that later fail to parse.  An empty object, and a missing field, have no entries.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.session import ship_package

_ESCAPE = re.compile(r"\\.", re.S)
_MARKS = re.compile(r"[{}\[\]:]")


class Scanner:
    """Follows JSON text through segments that a comma parts."""

    def __init__(self, inside: bool, depth: int = 0, keys: dict[int, str] | None = None, opened: dict[int, str] | None = None,
                 since: dict[int, int] | None = None):
        self.inside = inside
        self.depth = depth
        self.keys = keys or {}          # last key on each depth
        self.opened = opened or {}      # last opening bracket of each depth
        self.commas: dict[int, int] = {}
        self.since = since or {}        # commas since the last one on a lower depth
        self._text = ""                  # of the string that is open

    def feed(self, segment: str) -> Iterator[tuple[str, int]]:
        """The brackets outside strings with their places; depth is the one after an opening, before a closing bracket."""
        at = 0
        last = self._text
        parts = _ESCAPE.sub("xx", segment).split('"')
        for k, part in enumerate(parts):
            if k:
                at += 1
                if not self.inside:
                    last = ""
                self.inside = not self.inside
            if self.inside:
                last += segment[at:at + len(part)]
            else:
                for m in _MARKS.finditer(part):
                    c = m[0]
                    if c in "{[":
                        self.depth += 1
                        self.opened[self.depth] = c
                        yield c, at + m.start()
                    elif c in "}]":
                        yield c, at + m.start()
                        self.depth -= 1
                    else:
                        self.keys[self.depth] = last
            at += len(part)
        self._text = last

    def comma(self) -> None:
        """The comma between two segments."""
        if self.inside:
            self._text += ","
        else:
            self.commas[self.depth] = self.commas.get(self.depth, 0) + 1
            if self.since and max(self.since) > self.depth:
                self.since = {d: n for d, n in self.since.items() if d <= self.depth}
            self.since[self.depth] = self.since.get(self.depth, 0) + 1


_SUMMARY = pa.schema([("file", pa.string()), ("start", pa.int64()), ("inside", pa.bool_()), ("ends_inside", pa.bool_()),
                      ("delta", pa.int32()), ("commas", pa.map_(pa.int32(), pa.int64())), ("keys", pa.map_(pa.int32(), pa.string())),
                      ("opened", pa.map_(pa.int32(), pa.string())), ("since", pa.map_(pa.int32(), pa.int64()))])
_SUMMARY_DDL = ("file string, start bigint, inside boolean, ends_inside boolean, delta int, commas map<int, bigint>, keys map<int, string>, "
                "opened map<int, string>, since map<int, bigint>")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """The segments of each range, in order; a range is read to its end before the next one."""
    import itertools
    rows = ((f, s, v) for b in batches for f, s, v in zip(*[b.column(c).to_pylist() for c in ("file", "start", "value")]))
    for key, group in itertools.groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2] for r in group)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, start), segments in _ranges(batches):
        both = [Scanner(False), Scanner(True)]
        for segment in segments:
            for s in both:
                for _ in s.feed(segment):
                    pass
                s.comma()  # one follows each segment, except the last of the file, where it does not matter
        yield pa.RecordBatch.from_pylist([
            {"file": file, "start": start, "inside": k == 1, "ends_inside": s.inside, "delta": s.depth,
             "commas": list(s.commas.items()), "keys": list(s.keys.items()),
             "opened": list(s.opened.items()), "since": list(s.since.items())} for k, s in enumerate(both)], schema=_SUMMARY)


def _starts(rows: list, level: int) -> dict[tuple[str, int], tuple[bool, int, dict, dict, dict, int]]:
    """State, depth, keys, opening brackets, commas since lower ones and entries so far at the start of each range."""
    found = {(r["file"], r["start"], r["inside"]): r for r in rows}
    out = {}
    file, state = None, (False, 0, {}, {}, {}, 0)
    for name, start in sorted({(r["file"], r["start"]) for r in rows}):
        if name != file:
            file, state = name, (False, 0, {}, {}, {}, 0)
        out[name, start] = state
        inside, depth, keys, opened, since, entries = state
        r = found[name, start, inside]
        lowest = min((depth + d for d in r["commas"]), default=math.inf)
        since = {d: n for d, n in since.items() if d <= lowest}
        for d, n in r["since"].items():
            since[depth + d] = since.get(depth + d, 0) + n
        state = (r["ends_inside"], depth + r["delta"], keys | {depth + d: k for d, k in r["keys"].items()},
                 opened | {depth + d: c for d, c in r["opened"].items()}, since, entries + r["commas"].get(level - depth, 0))
    return out


_PIECE = pa.schema([("file", pa.string()), ("entry", pa.int64()), ("key", pa.string()), ("pos", pa.int64()), ("start", pa.int64()), ("edge", pa.bool_()), ("text", pa.string())])


def keyed_entries(spark: SparkSession, path: str, field: str | None = None) -> DataFrame:
    """(file, entry, text): each entry ``"key": value`` of the document's object, or of the object in its field ``field``.

    ``path``: a file or folder that Spark reads, in ranges of ``spark.sql.files.maxPartitionBytes``.
    """
    return _entries(spark, path, 1 if field is None else 2, field).select("file", "entry", "text")


def keyed_members(spark: SparkSession, path: str) -> DataFrame:
    """(file, entry, key, pos, text): each member of the lists that are the values of the document's object.

    So an entry may be longer than a task can hold.  Values that are no lists have no members.
    """
    return _entries(spark, path, 2, None)


def _entries(spark: SparkSession, path: str, level: int, field: str | None) -> DataFrame:
    ship_package(spark)
    members = level == 2 and field is None
    counted = 1 if members else level  # depth of the commas that count entries
    raw = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    starts = _starts(raw.mapInArrow(_summaries, _SUMMARY_DDL).collect(), counted)  # two rows per range

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), segments in _ranges(batches):
            inside, depth, keys, opened, since, entry = starts[file, start]
            scan = Scanner(inside, depth, dict(keys), dict(opened), dict(since))
            wanted = lambda: scan.opened.get(2) == "[" if members else field is None or scan.keys.get(1) == field
            pieces: list[str] = []           # of the entry that is open
            first, out = True, []

            def close(edge: bool) -> None:
                out.append({"file": file, "entry": entry, "key": scan.keys.get(1) if members else None,
                            "pos": scan.since.get(2, 0) if members else None, "start": start, "edge": edge, "text": ",".join(pieces)})
                pieces.clear()
            for segment in segments:
                begin = 0 if scan.depth >= level and wanted() else None
                for mark, at in scan.feed(segment):
                    if mark in "{[" and scan.depth == level and wanted():
                        begin = at + 1
                    elif mark in "}]" and scan.depth == level and begin is not None:
                        pieces.append(segment[begin:at])
                        close(first)
                        first, begin = False, None
                if begin is not None:
                    pieces.append(segment[begin:])
                    if scan.depth == level and not scan.inside:
                        close(first)
                        first = False
                before = scan.commas.get(counted, 0)
                scan.comma()
                entry += scan.commas.get(counted, 0) - before
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=_PIECE)
                    out = []
            if pieces:
                close(True)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_PIECE)
    pieces = raw.mapInArrow(cut, "file string, entry bigint, key string, pos bigint, start bigint, edge boolean, text string")
    name = ["file", "entry", "key", "pos"]
    whole = pieces.where(~F.col("edge")).select(*name, "text")
    parts = pieces.where("edge").groupBy(*name).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), ",").alias("text"))
    return whole.unionByName(parts).where(F.trim("text") != "")
