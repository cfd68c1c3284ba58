"""Language-model scores by subword lattice likelihood.

A token is a path through a lattice whose arcs are the pieces of an existing subword vocabulary; each arc weighs
as much as the vocabulary's score of its piece, and the probability of the token is the sum over *all* its
segmentations, found by forward recursion in log space.  Characters that no piece covers are spelt by their byte
pieces.  A piece never spans two tokens, so the probability of a text is the product over its tokens and its end,
and the recursion runs once per distinct word of the corpus, not once per occurrence.

The vocabulary's scores are taken as log probabilities if they are some; the scores of a merge-ordered
vocabulary are ranks, and rank r becomes the Zipf weight 1 / (r + ``ZIPF_SHIFT``).

From the training rows the model learns two things.  ``ROUNDS`` of expectation-maximisation over the distinct
training words, each counted once, refine the weights of the pieces: the expected uses of each piece over all
segmentations (forward-backward), with the vocabulary's weights as a prior.  And a token that the training rows
hold gets one more arc, over its whole length, so that for c occurrences among N tokens and lattice probability L

    P(token) = (c + a L(token)) / (N + a),   a = number of tokens that occur once in training (at least 1).

The end of a text is a token like any other, with the lattice probability ``END_PRIOR``.

Counts and values travel by the distinct words of a shard (``term_matrix``); what reaches the driver is one
number per vocabulary piece and round.  Sums of a text do not depend on the order of its words (``fsum``), so
equal texts have equal scores.

Defined results: a null or empty text has one token, its end; rows without an id are training rows; with no
training row the lattice alone decides; very long words are recursed in windows; an empty table gives an empty
table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.term_matrix import entries, given_back, joined, pack, parted, term_shards, unpack, words_of
from feedlens.session import materialize

ZIPF_SHIFT = 2.7
ROUNDS = 1
PRIOR = 1000.0        # weight of the vocabulary's scores, in expected uses
END_PRIOR = 0.01
WINDOW = 1 << 18      # lattice cells (words x positions) that are held at a time
MARK = "▁"       # fixed value: begins the first piece of a token


@dataclass
class Lattice:
    """The pieces as a trie over code points: edges are sorted keys (state, symbol), so that many positions step at once."""

    keys: np.ndarray      # state << 21 | code point, ascending
    to: np.ndarray        # state after each edge
    piece: np.ndarray     # piece that ends in each state, or -1
    depth: int            # length of the longest piece
    log_weight: np.ndarray
    bytes_of: np.ndarray  # pieces of the 256 bytes, or -1

    @classmethod
    def load(cls, path: str) -> Lattice:
        """From a SentencePiece model file."""
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        text = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in plain if text[i] and MARK not in text[i][1:]]  # others cannot lie within a token
        score = np.array([model.get_score(i) for i in range(n)])
        bytes_of = np.full(256, -1)
        for i in range(n):
            if model.is_byte(i):
                bytes_of[int(text[i][1:-1], 16)] = i
        weight = np.zeros(n)
        if np.allclose(score[plain], np.round(score[plain])):
            weight[plain] = 1 / (np.maximum(-score[plain], 0) + ZIPF_SHIFT)
        else:
            weight[plain] = np.exp(score[plain])
        rest = bytes_of[bytes_of >= 0]
        weight[rest] = weight[plain].min() / 16
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for i in plain:
            state = 0
            for c in map(ord, text[i]):
                if c not in children[state]:
                    children[state][c] = len(children)
                    children.append({})
                    ends.append(-1)
                state = children[state][c]
            ends[state] = i
        edges = sorted((s << 21 | c, t) for s, d in enumerate(children) for c, t in d.items())
        with np.errstate(divide="ignore"):
            return cls(np.array([e[0] for e in edges]), np.array([e[1] for e in edges]), np.array(ends),
                       max(len(text[i]) for i in plain), np.log(weight / weight.sum()), bytes_of)

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states after one more symbol, -1 where the trie has no such edge."""
        key = states << 21 | symbols
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def arcs(self, codes: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Pieces by (row, start, length - 1) for the starts ``begin`` to ``end``, and the log weight of spelling one symbol.

        ``codes``: code points of one word a row, -1 beyond its end.
        """
        rows, width = codes.shape
        found = np.full((rows, end - begin, self.depth), -1, np.int32)
        row, start = np.nonzero(codes[:, begin:end] >= 0)
        state = np.zeros(len(row), np.int64)
        for length in range(self.depth):
            at = start + begin + length
            inside = at < width
            row, start, state, at = row[inside], start[inside], state[inside], at[inside]
            symbol = codes[row, at]
            inside = (symbol >= 0) & ((symbol != ord(MARK)) | (at == 0))
            row, start = row[inside], start[inside]
            state = self.step(state[inside], symbol[inside])
            go = state >= 0
            row, start, state = row[go], start[go], state[go]
            if not len(row):
                break
            found[row, start, length] = self.piece[state]
        return found, self.spelt(codes[:, begin:end])

    def spelt(self, codes: np.ndarray) -> np.ndarray:
        """Log weight of each code point by its UTF-8 bytes."""
        flat, back = np.unique(codes, return_inverse=True)
        cost = np.full(len(flat), -np.inf)
        for k, c in enumerate(flat.tolist()):
            if c >= 0:
                pieces = self.bytes_of[list(chr(c).encode("utf-8", "surrogatepass"))]
                if (pieces >= 0).all():
                    cost[k] = self.log_weight[pieces].sum()
        return cost[back].reshape(codes.shape)

    def _weights(self, found: np.ndarray, spelt: np.ndarray) -> np.ndarray:
        """Log weight of each arc; spelling counts where no piece is a single symbol."""
        w = np.where(found >= 0, self.log_weight[found], -np.inf)
        w[:, :, 0] = np.where(found[:, :, 0] >= 0, w[:, :, 0], spelt)
        return w

    def forward(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of every prefix: alpha[row, p] sums all segmentations of the first p symbols."""
        rows, width = codes.shape
        alpha = np.full((rows, width + 1), -np.inf)
        alpha[:, 0] = 0
        size = max(self.depth, WINDOW // (rows * self.depth))
        for begin in range(0, width, size):
            end = min(width, begin + size)
            w = self._weights(*self.arcs(codes, begin, end))
            for p in range(begin, end):  # by start: alpha[p] is complete when its turn comes
                to = min(width, p + self.depth)
                alpha[:, p + 1:to + 1] = np.logaddexp(alpha[:, p + 1:to + 1], alpha[:, p, None] + w[:, p - begin, :to - p])
        return alpha

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Natural logarithm of the lattice probability of each word."""
        out = np.zeros(len(words))
        for index, codes, lengths in _batches(words):
            out[index] = self.forward(codes)[np.arange(len(index)), lengths]
        return out

    def expected(self, words: list[str]) -> np.ndarray:
        """Expected uses of each piece over all segmentations of the words."""
        uses = np.zeros(len(self.log_weight))
        for _, codes, lengths in _batches(words):
            rows, width = codes.shape
            alpha = self.forward(codes)
            total = alpha[np.arange(rows), lengths]
            beta = np.full((rows, width + 1), -np.inf)
            beta[np.arange(rows), lengths] = 0
            size = max(self.depth, WINDOW // (rows * self.depth))
            for begin in range((width - 1) // size * size, -1, -size):
                end = min(width, begin + size)
                found, spelt = self.arcs(codes, begin, end)
                w = self._weights(found, spelt)
                for p in range(end - 1, begin - 1, -1):
                    to = min(width, p + self.depth)
                    step = w[:, p - begin, :to - p] + beta[:, p + 1:to + 1]
                    top = np.maximum(step.max(1), beta[:, p])
                    safe = np.where(np.isfinite(top), top, 0)
                    with np.errstate(divide="ignore"):
                        inner = np.log(np.exp(step - safe[:, None]).sum(1)) + safe
                    beta[:, p] = np.where(lengths == p, 0.0, inner)
                    share = np.exp(alpha[:, p, None] + step - total[:, None])
                    at = found[:, p - begin, :to - p]
                    uses += np.bincount(at[at >= 0], share[at >= 0], len(uses))
        return uses

    def refined(self, uses: np.ndarray) -> Lattice:
        """The same pieces with weights in proportion to the uses and the present weights as a prior."""
        weight = uses + PRIOR * np.exp(self.log_weight)
        with np.errstate(divide="ignore"):
            return Lattice(self.keys, self.to, self.piece, self.depth, np.log(weight / weight.sum()), self.bytes_of)


def _batches(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, code points, lengths) of words of like length, as many as a window holds; the mark goes before each."""
    lengths = np.array([len(x) + 1 for x in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and (to + 1 - at) * lengths[order[to]] <= WINDOW // 8:
            to = min(len(order), to + max(1, (to - at) // 2))
        while to > at + 1 and (to - at) * lengths[order[to - 1]] > WINDOW // 8:
            to -= 1
        index = order[at:to]
        n = lengths[index]
        text = "".join(MARK + words[k] for k in index.tolist())
        flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        codes = np.full((len(index), int(n.max())), -1, np.int64)
        codes[np.arange(codes.shape[1])[None, :] < n[:, None]] = flat
        yield index, codes, n
        at = to


def dictionary(shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((bucket, words, counts), entries): the distinct words of the corpus and how often training rows hold them."""
    dealt, _ = entries(shards)
    dealt = materialize(dealt, "lattice-entries")

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        coded, starts = words_of(table)
        weight = np.concatenate([unpack(x) for x in table.column("weight").to_pylist()])
        sums = np.bincount(coded.indices.to_numpy(zero_copy_only=False), weight, len(coded.dictionary)).astype(np.int64)
        return pa.table({"bucket": [key[0].as_py()], "words": [joined(coded.dictionary)],
                         "counts": pa.array([pack(sums)], pa.binary()), "tokens": [int(sums.sum())],
                         "distinct": [int((sums > 0).sum())], "once": [int((sums == 1).sum())]})
    words = dealt.groupBy("bucket").applyInArrow(
        count, "bucket bigint, words string, counts binary, tokens bigint, distinct bigint, once bigint")
    return materialize(words, "lattice-words"), dealt


def fit(words: DataFrame, vocabulary: str, rounds: int = ROUNDS) -> Lattice:
    """The lattice of the vocabulary with its weights refined on the distinct training words of ``dictionary``."""
    lattice = Lattice.load(vocabulary)
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], lattice: Lattice = lattice) -> Iterator[pa.RecordBatch]:
            uses = np.zeros(len(lattice.log_weight))
            for batch in batches:
                for text, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                    uses += lattice.expected(parted(text).filter(pa.array(unpack(counts) > 0)).to_pylist())
            at = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(uses[at])], names=["piece", "uses"])
        # one row per piece of the vocabulary, whose size is fixed
        sums = words.select("words", "counts").mapInArrow(expect, "piece bigint, uses double").groupBy("piece").agg(
            F.sum(F.round("uses", 6).cast("decimal(28,6)")).cast("double").alias("uses")).collect()
        uses = np.zeros(len(lattice.log_weight))
        for r in sums:
            uses[r["piece"]] = r["uses"]
        lattice = lattice.refined(uses)
    return lattice


def score(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
          rounds: int = ROUNDS) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``lattice_score``.

    Scores are log10 probabilities of the whole text; ``base_score`` is the add-half unigram model of the
    training rows, ``lattice_score`` that of the vocabulary's pieces alone, with the learned share of ends.
    Rows whose CRC-32 of the id is 1 modulo 5 are held out.  ``vocabulary``: path of a SentencePiece model
    file on the driver.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    key = F.col(f"`{id_col}`")
    held = F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))
    rows = docs.select(key.alias("id"), held.alias("held_out"), (~held).alias("train"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shards = term_shards(rows, "text", lower=True, weight_col="train")
    words, dealt = dictionary(shards)
    seen = words.agg(F.sum("tokens"), F.sum("distinct"), F.sum("once")).first()
    ends = rows.where("train").count()
    tokens, distinct, once = (int(x or 0) for x in seen)
    n, v, a = tokens + ends, distinct + (ends > 0), max(1, once)
    lattice = fit(words, vocabulary, rounds)
    end_share = ends / n if n else END_PRIOR

    def value(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        coded, starts = words_of(table)
        of = coded.indices.to_numpy(zero_copy_only=False)
        weight = np.concatenate([unpack(x) for x in table.column("weight").to_pylist()])
        counts = np.bincount(of, weight, len(coded.dictionary)).astype(np.int64)
        logs = lattice.log_probabilities(coded.dictionary.to_pylist())
        spans = list(zip(starts, starts[1:]))
        return pa.table({"shard": table.column("shard"), "places": table.column("places"),
                         "seen": pa.array([pack(counts[of[s:t]]) for s, t in spans], pa.binary()),
                         "logs": pa.array([logs[of[s:t]].tobytes() for s, t in spans], pa.binary())})
    values = dealt.groupBy("bucket").applyInArrow(value, "shard bigint, places binary, seen binary, logs binary")
    schema = (f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
              "score double, lattice_score double")

    def use(row: dict, found: list[dict]) -> Iterator[pa.RecordBatch]:
        seen, logs = np.zeros(row["n_terms"], np.int64), np.zeros(row["n_terms"])
        for x in found:
            at = unpack(x["places"])
            seen[at], logs[at] = unpack(x["seen"]), np.frombuffer(x["logs"])
        with np.errstate(under="ignore"):
            likely = (seen + a * (1 - END_PRIOR) * np.exp(logs))
        rare = likely == 0  # the probability of a very long word is below the least double
        model = np.where(rare, (np.log(a * (1 - END_PRIOR)) + logs) / math.log(10), np.log10(np.where(rare, 1, likely))) - math.log10(n + a)
        per_term = np.stack([np.log10((seen + 0.5) / (n + 0.5 * (v + 1))), model, (logs + math.log1p(-end_share)) / math.log(10)])
        at_end = [math.log10((ends + 0.5) / (n + 0.5 * (v + 1))), math.log10((ends + a * END_PRIOR) / (n + a)), math.log10(end_share or END_PRIOR)]
        indptr, terms, counts = (unpack(row[c]) for c in ("indptr", "terms", "counts"))
        products = (per_term[:, terms] * counts).tolist()
        known = counts * (seen[terms] > 0)
        out = []
        for i, r in enumerate(row["rows"]):
            s, t = int(indptr[i]), int(indptr[i + 1])
            sums = [math.fsum([*x[s:t], e]) for x, e in zip(products, at_end)]
            out.append({"id": r["id"], "held_out": r["held_out"], "n_tokens": int(counts[s:t].sum()) + 1,
                        "n_known": int(known[s:t].sum()) + (ends > 0), "train_tokens": n,
                        "base_score": sums[0], "score": sums[1], "lattice_score": sums[2]})
        yield pa.RecordBatch.from_pylist(out)
    return given_back(shards, values, use, schema).withColumnRenamed("id", id_col)
