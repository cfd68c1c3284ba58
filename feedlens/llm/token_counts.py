"""Token counts of byte-level BPE by heap-and-linked-list merging.

A text is cut into pre-tokens; the symbols of a pre-token form a linked list, and the adjacent pairs that
the vocabulary merges wait in a heap by rank, then position.  Each valid pop merges one pair, so the count
is the number of bytes minus the number of merges; no identifiers are made.  Special strings inside a
text count as one token each and cut it.

Counts of short pre-tokens are kept per Python worker in a table of bounded size.  The cost of a pre-token
of n bytes is O(n log n), so a text without any blank is no special case.

Defined results: a null text is empty and has no tokens; an empty table gives an empty table; columns of
the caller are kept, and those named ``n_bytes`` or ``n_tokens`` are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Fixed value: how byte-level BPE cuts a text.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CACHED_BYTES = 64
CACHED = 400_000


def _byte_names() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: itself, or one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class PairCounter(dict):
    """str -> number of tokens of a pre-token, kept while it is short and the table is not full."""

    _of: dict = {}

    def __init__(self, path: str):
        import regex
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        number = {name: byte for name, byte in _byte_names().items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            made = number.setdefault(left + right, len(number))
            self.merges.setdefault((number[left], number[right]), (rank, made))
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(regex.escape(x) for x in sorted(specials, key=len, reverse=True))) \
            if specials else None
        self.cut = regex.compile(PRE_TOKEN).findall

    @classmethod
    def of(cls, path: str) -> PairCounter:
        """One per Python worker and vocabulary."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def merged(self, raw: bytes) -> int:
        """Symbols left when no adjacent pair can be merged."""
        symbols, n = list(raw), len(raw)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        heap = [(found[0], i) for i in range(n - 1) if (found := merges.get((symbols[i], symbols[i + 1])))]
        heapify(heap)
        count = n
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            found = merges.get((symbols[i], symbols[j]))
            if found is None or found[0] != rank:  # one of the pair has been merged meanwhile
                continue
            symbols[i], symbols[j] = found[1], -1
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((symbols[i], symbols[k])):
                    heappush(heap, (found[0], i))
            h = before[i]
            if h >= 0 and (found := merges.get((symbols[h], symbols[i]))):
                heappush(heap, (found[0], h))
        return count

    def __missing__(self, token: str) -> int:
        raw = token.encode()
        count = self.merged(raw)
        if len(raw) <= CACHED_BYTES:
            if len(self) >= CACHED:
                self.clear()
            self[token] = count
        return count

    def count(self, text: str) -> int:
        get = self.__getitem__
        if self.special is None:
            return sum(map(get, self.cut(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(get, self.cut(p))) for p in parts)


def count_tokens(docs: DataFrame, vocabulary: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with ``n_bytes`` (UTF-8) and ``n_tokens``.

    ``vocabulary``: path of a byte-level BPE file in the JSON form of the ``tokenizers`` library, readable on
    every worker.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_bytes", "n_tokens")]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PairCounter.of(vocabulary)
        for batch in batches:
            sizes, counts = [], []
            for text in batch.column("__text"):
                text = text.as_py()
                sizes.append(len(text.encode()))
                counts.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).cast(arrow.field(c).type) for c in keep], pa.array(sizes, pa.int64()),
                 pa.array(counts, pa.int64())], schema=arrow)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text")
    return docs.select(*[F.col(f"`{c}`") for c in keep], text).mapInArrow(run, schema)
