"""Words of Arrow text columns as 64-bit hashes, computed for many documents at a time with numpy.

A word is a maximal run of bytes that a table marks as word bytes (A-Z are lower-cased first).  Its hash is
a polynomial over a table of random values, taken from prefix sums, so that the cost per byte is a few
vector operations.  Memory is bounded by ``CHUNK`` bytes of text (or by the longest word), not by the
longest text: a text beyond that is hashed piece by piece, cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_RADIX = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

#: Words between ASCII white space.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
#: Words of digits, letters and all bytes beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """At least ``n`` powers; what is kept in the worker covers a group of texts, longer tables go when they have been used."""
    if len(_powers[0]) >= n:
        return _powers
    tables = []
    for r in (_RADIX, pow(_RADIX, -1, 1 << 64)):
        p = np.full(max(n, CHUNK + 2), r, np.uint64)
        p[0] = 1
        tables.append(np.cumprod(p))
    if n <= CHUNK + 2:
        _powers[:] = tables
    return tables


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a text column (a null text is empty)."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _hash(data: np.ndarray, bounds: np.ndarray, word_bytes: np.ndarray):
    """Hashes, starts and ends of the words of ``data``; documents begin at ``bounds``."""
    low = LOWER[data]
    word = word_bytes[low]
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begin[inner] |= word[inner]
    end[inner - 1] |= word[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[low] * power[:len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64)), starts, ends


def _pieces(data: np.ndarray, word_bytes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of one long text, cut between words."""
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + CHUNK)
        if to < n:
            gaps = np.flatnonzero(~word_bytes[LOWER[data[at:to]]])
            if len(gaps):
                to = at + int(gaps[-1]) + 1
            while to < n and not len(gaps):
                gaps = np.flatnonzero(~word_bytes[LOWER[data[to:to + CHUNK]]])
                to = to + int(gaps[0]) + 1 if len(gaps) else min(n, to + CHUNK)
        yield at, to
        at = to


def word_groups(column: pa.Array, word_bytes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of consecutive documents: the first one's index, word bounds of each document, and the words.

    Yields (first, bounds, hashes, starts, ends): document ``first + i`` has the words ``bounds[i]`` to
    ``bounds[i + 1]``, whose byte positions are relative to the start of their own document.
    """
    data, offsets = text_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = first + 1
        while last < n and offsets[last + 1] - offsets[first] <= CHUNK:
            last += 1
        base, part = offsets[first], data[offsets[first]:offsets[last]]
        if last == first + 1 and len(part) > CHUNK:
            found = [(h, s + at, e + at) for at, to in _pieces(part, word_bytes)
                     for h, s, e in [_hash(part[at:to], np.zeros(1, np.int64), word_bytes)]]
            h, s, e = (np.concatenate(x) for x in zip(*found, strict=True))
            yield first, np.array([0, len(h)]), h, s, e
        else:
            docs = offsets[first:last + 1] - base
            h, s, e = _hash(part, docs[:-1], word_bytes)
            bounds = np.searchsorted(s, docs)
            shift = np.repeat(docs[:-1], np.diff(bounds))
            yield first, bounds, h, s - shift, e - shift
        first = last


def chained(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (all of them if there are fewer; none if none)."""
    k = min(k, len(h))
    if not k:
        return h
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i])
    return out
