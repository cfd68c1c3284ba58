"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The automaton of all items is built once per Python worker; each document streams its words through it
and tracks the longest match that ends at each word.  A match of ``window`` words or more, or of a whole
item that is shorter, is a hit: its words are spans to remove.  Words outside the items' vocabulary reset
the match, so only runs of known words reach the automaton.

The items are dealt to blocks of at most ``BLOCK_BYTES`` of text (one block for usual benchmarks).  Each
block is one broadcast of bounded size and one pass over the documents that adds to the hits found so far.

Defined results: a null text has no words; an item without words matches nothing; a null item id is not
reported, but its words are hits; equal items all count; an empty benchmark leaves all documents as they
are; columns of the caller are kept, and those named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlens.llm.words import ALNUM, word_groups

WINDOW = 10
BLOCK_BYTES = 4 << 20


class SuffixAutomaton:
    """Generalised suffix automaton of the items' word sequences, with what each state says about items."""

    def __init__(self, items: list[list[int]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.items: list[set[int]] = [set() for _ in self.link]       # items that hold the state's words
        self.whole: list[list[tuple[int, int]]] = [[] for _ in self.link]  # short items that end here: (length, item)
        for k, words in enumerate(items):
            state = 0
            for w in words:
                state = self.next[state][w]
                up = state
                while up > 0 and self.length[up] >= window and k not in self.items[up]:
                    self.items[up].add(k)
                    up = self.link[up]
            if 0 < len(words) < window:
                self.whole[state].append((len(words), k))
        self.shorter = [-1] * len(self.link)  # nearest state at or above in which short items end
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.shorter[s] = s if self.whole[s] else self.shorter[self.link[s]]

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _clone(self, p: int, q: int, w: int) -> int:
        c = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:  # the prefix is known from an earlier item
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w)
        cur, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return cur

    def hits(self, words: list[int]) -> Iterator[tuple[int, int, set[int]]]:
        """(first word, end, items) of each hit in a run of words: overlapping, in order of their ends."""
        link, length, step, window = self.link, self.length, self.next, self.window
        state = matched = 0
        for i, w in enumerate(words):
            to = step[state].get(w)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = step[state].get(w)
            if to is None:
                continue
            state, matched = to, matched + 1
            if matched >= window:
                s = state
                while length[link[s]] >= window:
                    s = link[s]
                yield i + 1 - matched, i + 1, self.items[s]
            s = self.shorter[state]
            while s > 0:
                for n, k in self.whole[s]:
                    if n <= matched:
                        yield i + 1 - n, i + 1, {k}
                s = self.shorter[link[s]]


class Index:
    """The automaton of a block of items, with word hashes numbered by the items' vocabulary."""

    _of: dict = {}

    def __init__(self, items: list[tuple], window: int):
        column = pa.array([text for _, text in items], pa.string())
        words: list[np.ndarray] = []
        for _, bounds, h, _, _ in word_groups(column, ALNUM):
            words += [h[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.ids = [i for i, _ in items]
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        sequences = [np.searchsorted(self.vocabulary, w).tolist() for w in words]
        self.least = min([min(window, len(s)) for s in sequences if s], default=0)
        self.automaton = SuffixAutomaton(sequences, window)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    @classmethod
    def of(cls, items: Broadcast, window: int) -> Index:
        """One per Python worker and broadcast."""
        key = (items._path if hasattr(items, "_path") else id(items), window, len(items.value))
        if key not in cls._of:
            cls._of.clear()
            cls._of[key] = cls(items.value, window)
        return cls._of[key]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of the words, -1 for others."""
        out = np.full(len(h), -1, np.int64)
        at = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        if len(at):
            found = np.searchsorted(self.vocabulary, h[at])
            found[found == len(self.vocabulary)] = 0
            out[at] = np.where(self.vocabulary[found] == h[at], found, -1)
        return out

    def find(self, column: pa.Array) -> tuple[list[int], list[list[tuple[int, int, int, int]]], list[set]]:
        """Per document: its number of words, its hit runs (first word, end, first byte, end byte), its items."""
        n_words, runs, items = [0] * len(column), [[] for _ in range(len(column))], [set() for _ in range(len(column))]
        for first, bounds, h, starts, ends in word_groups(column, ALNUM):
            for i, n in enumerate(np.diff(bounds).tolist()):
                n_words[first + i] = n
            if not self.least:
                continue
            ids = self.numbers(h)
            known = np.zeros(len(ids) + 1, bool)
            known[:-1] = ids >= 0
            new = known.copy()
            new[1:] ^= known[:-1]
            new[bounds[:-1]] |= known[bounds[:-1]]
            cuts = np.flatnonzero(new)
            length = np.diff(cuts, append=len(ids))
            keep = known[cuts] & (length >= self.least)
            doc_of = np.searchsorted(bounds, cuts, side="right") - 1
            for a, n, d in zip(cuts[keep].tolist(), length[keep].tolist(), doc_of[keep].tolist(), strict=True):
                end = min(a + n, int(bounds[d + 1]))
                for s, e, which in self.automaton.hits(ids[a:end].tolist()):
                    s, e = a + s, a + e
                    mine = runs[first + d]
                    while mine and mine[-1][1] >= s:
                        s = min(s, mine.pop()[0])
                    mine.append((s, e))
                    items[first + d] |= which
            for d in range(len(bounds) - 1):
                if runs[first + d]:
                    b = int(bounds[d])
                    runs[first + d] = [(s - b, e - b, int(starts[s]), int(ends[e - 1])) for s, e in runs[first + d]]
        return n_words, runs, [{self.ids[k] for k in s} - {None} for s in items]


SPAN = T.StructType([T.StructField(n, T.IntegerType()) for n in ("first_word", "end_word", "first_byte", "end_byte")])


def _joined(old: list, new: list) -> list:
    """Union of two lists of spans, each in order and without overlap."""
    out: list = []
    for span in sorted([tuple(x) for x in old] + [tuple(x) for x in new]):
        if out and out[-1][1] >= span[0]:
            a, b = out[-1], span
            out[-1] = (a[0], max(a[1], b[1]), a[2], max(a[3], b[3]))
        else:
            out.append(span)
    return out


def _cut(text: str, spans: list) -> str:
    """The text without the spans, what is left joined as it stood."""
    raw, at, parts = text.encode(), 0, []
    for _, _, a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]]).decode()


def _pass(docs: DataFrame, items: Broadcast, window: int, text_col: str, last: bool, keep: list[str],
          with_text: bool) -> DataFrame:
    id_type = docs.schema["__items"].dataType
    fields = [f for f in docs.schema.fields if not f.name.startswith("__")]
    if last:
        fields = [f for f in fields if f.name in keep]
    fields += [T.StructField("__words", T.IntegerType()), T.StructField("__spans", T.ArrayType(SPAN)),
               T.StructField("__items", id_type)]
    if last and with_text:
        fields.append(T.StructField("__clean", T.StringType()))
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.of(items, window)
        for batch in batches:
            column = batch.column(text_col)
            n_words, runs, found = index.find(column)
            old_spans, old_items = batch.column("__spans").to_pylist(), batch.column("__items").to_pylist()
            spans = [_joined([tuple(s.values()) for s in a], b) if a else b
                     for a, b in zip(old_spans, runs, strict=True)]
            got = [sorted({*a, *b}) for a, b in zip(old_items, found, strict=True)]
            made = {"__words": n_words, "__items": got,
                    "__spans": [[dict(zip(SPAN.names, s, strict=True)) for s in x] for x in spans]}
            if last and with_text:
                made["__clean"] = [_cut(t.as_py() or "", x) if x else t.as_py() for t, x in zip(column, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name).cast(f.type) for f in arrow],
                schema=arrow)
    return docs.mapInArrow(run, schema)


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[list[tuple]]:
    """The items in blocks of about ``BLOCK_BYTES`` at most (a longer item is a block of its own size)."""
    items = benchmark.select(benchmark[id_col].alias("id"), benchmark[text_col].cast("string").alias("text"))
    items = items.where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + 2 * total // BLOCK_BYTES if total > BLOCK_BYTES else 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [[(r["id"], r["text"]) for r in items.where(block == b).collect()] for b in range(n)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, keep: list[str] | None = None,
                       with_text: bool = False, prefix: str = "") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with what the benchmark's items hit.

    Adds ``n_words``, ``n_hit`` (words inside hits), ``spans`` (word and byte positions), ``item_ids``
    (distinct, ascending) and, ``with_text``, ``clean_text`` without the spans; all named with ``prefix``.
    """
    sc = docs.sparkSession.sparkContext
    keep = docs.columns if keep is None else keep
    blocks = item_blocks(benchmark, item_id, item_text)
    id_type = benchmark.schema[item_id].dataType
    found = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])],
                        F.array().cast(T.ArrayType(SPAN)).alias("__spans"),
                        F.array().cast(T.ArrayType(id_type)).alias("__items"))
    for k, items in enumerate(blocks):
        found = _pass(found, sc.broadcast(items), window, text_col, k == len(blocks) - 1, keep, with_text)
    hit = F.aggregate("__spans", F.lit(0), lambda n, s: n + s["end_word"] - s["first_word"])
    new = {"n_words": F.col("__words").cast("long"), "n_hit": hit.cast("long"),
           "spans": F.col("__spans"), "item_ids": F.col("__items")}
    if with_text:
        new["clean_text"] = F.col("__clean")
    new = {prefix + c: v for c, v in new.items()}
    return found.select(*[F.col(f"`{c}`") for c in keep if c not in new], *[v.alias(c) for c, v in new.items()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
                  max_coverage: float = 0.8) -> DataFrame:
    """``docs`` without hit spans; documents of which more than ``max_coverage`` of the words are hit go."""
    found = find_contamination(docs, benchmark, text_col, window=window, with_text=True, prefix="__c_")
    kept = found.where(F.col("__c_n_hit") <= F.greatest(max_coverage * F.col("__c_n_words"), F.lit(0.0)))
    return kept.select(*[F.col("__c_clean_text" if c == text_col else f"`{c}`").alias(c) for c in docs.columns])
