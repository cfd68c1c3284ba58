"""Quality classifier by co-training (Blum and Mitchell, 1998) of a text view and a metadata view.

Each document has two views: its text (shares of character classes and punctuation marks, word statistics,
hashed words) and its page metadata (categories such as source and language, and its stated length).  Two
logistic regressions start from the labelled rows; in each round, each view labels all unlabelled documents that it is
confident of, after calibration on held-out rows, for the other view to learn from.  At the end the two
calibrated views are combined by a small regression on the held-out rows, and every document is scored.

The features of all documents are written once to the shared folder, and every step of a fit is one pass over
them: tasks sum gradients and Hessians over their confident rows, so what is gathered has the size of the
model, and no unlabelled document is left out.  The pseudo-labels of a class together weigh at most as much as its labelled
rows.  Only the labelled rows are bounded: at most ``max_labelled``, taken by hash of the id, are gathered on the
driver (a few hundred floats each); labels beyond that are not used, their rows count as unlabelled.

Defined results: a null text is an empty text; null metadata is a category of its own; labels that are null
or contradict each other are not used; with fewer than ``LEAST`` rows of a class every document scores 1 and
none is rejected; an empty table gives an empty table; columns of the caller are kept, and those named like
a result column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.llm.words import NOT_BLANK, text_buffers, word_groups
from feedlens.session import materialize

MAX_LABELLED = 6000
ROUNDS = 5
STEPS = 3                # Newton steps over all documents in a round, each from where the last one ended
SLOTS = 16               # partial sums of a pass are added up in so many parts
CONFIDENT = 0.95
LEAST = 5
HASHED_WORDS = 128
HASHED_CATEGORIES = 32
RESULTS = ("text_score", "metadata_score", "quality_score")

_PUNCTUATION = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_CLASSES = [list(range(0x41, 0x5B)), list(range(0x61, 0x7B)), list(range(0x30, 0x3A)), [0x20], [0x0A],
            [b for b in range(0x20) if b != 0x0A] + [0x7F], list(range(0x80, 0x100)), _PUNCTUATION]


def text_features(column: pa.Array) -> np.ndarray:
    """One row of floats per text."""
    data, offsets = text_buffers(column)
    n = len(column)
    shares = np.zeros((n, len(_CLASSES) + len(_PUNCTUATION)), np.float32)
    for i in range(n):
        part = data[offsets[i]:offsets[i + 1]]
        if len(part):
            counts = sum(np.bincount(part[at:at + (1 << 22)], minlength=256) for at in range(0, len(part), 1 << 22))
            shares[i] = [counts[c].sum() / len(part) for c in _CLASSES] + (counts[_PUNCTUATION] / len(part)).tolist()
    stats = np.zeros((n, 6), np.float32)
    hashed = np.zeros((n, HASHED_WORDS), np.float32)
    for first, bounds, h, starts, ends in word_groups(column, NOT_BLANK):
        for d in range(len(bounds) - 1):
            a, b = bounds[d], bounds[d + 1]
            if a == b:
                continue
            w, i = h[a:b], first + d
            distinct, counts = np.unique(w, return_counts=True)
            stats[i] = (np.log1p(len(w)), (ends[a:b] - starts[a:b]).mean() / 10, len(distinct) / len(w),
                        (w[1:] == w[:-1]).mean() if len(w) > 1 else 0, counts.max() / len(w), np.log1p(len(distinct)))
            hashed[i] = np.bincount((w % np.uint64(HASHED_WORDS)).astype(np.int64), minlength=HASHED_WORDS) / len(w)
    return np.hstack([np.sqrt(shares), stats, np.sqrt(hashed)])


def metadata_features(categories: list[list], lengths: list) -> np.ndarray:
    """Hashed categories, the logarithm of the stated length and its square, and whether it is missing."""
    n = len(lengths)
    out = np.zeros((n, HASHED_CATEGORIES * len(categories) + 3), np.float32)
    for k, values in enumerate(categories):
        slots = {v: zlib.crc32(repr(v).encode()) % HASHED_CATEGORIES for v in set(values)}
        out[np.arange(n), [HASHED_CATEGORIES * k + slots[v] for v in values]] = 1
    size = np.log1p(np.array([0 if x is None else max(0, x) for x in lengths], np.float64)) / 10
    out[:, -3], out[:, -2], out[:, -1] = size, size ** 2, [x is None for x in lengths]
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


PENALTY = 1.0


def _standard(mean: np.ndarray, variance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scale = np.sqrt(np.maximum(variance, 0))
    return mean, np.where(scale > 1e-6, scale, np.inf)


@dataclass
class Logistic:
    """Logistic regression on standardised features, fitted by Newton steps with an L2 penalty."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = PENALTY,
            standard: tuple[np.ndarray, np.ndarray] | None = None) -> Logistic:
        mean, scale = standard or _standard(x.mean(0), x.var(0))
        model = cls(mean, scale, np.zeros(x.shape[1] + 1))
        for _ in range(25):
            gradient, hessian = model.sums(x, y)
            step = model.step(gradient, hessian, penalty)
            if np.abs(step).max() < 1e-5:
                break
        return model

    def sums(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of the likelihood of these rows."""
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))]).astype(np.float64)
        p = _sigmoid(z @ self.weights)
        return z.T @ (y - p), (z * (p * (1 - p) + 1e-9)[:, None]).T @ z

    def step(self, gradient: np.ndarray, hessian: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
        """One Newton step with an L2 penalty; the weights move."""
        ridge = np.full(len(self.weights), penalty)
        ridge[-1] = 1e-6
        step = np.linalg.solve(hessian + np.diag(ridge), gradient - ridge * self.weights)
        self.weights = self.weights + step
        return step

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]


@dataclass
class CoTrained:
    views: list[Logistic]
    calibrations: list[Logistic]
    combination: Logistic | None
    students: list[Logistic] | None = None   # the models that learn from these views in a round

    def scores(self, views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality by text, by metadata and by both."""
        logits = [c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibrations, views, strict=True)]
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(self.combination.logit(np.stack(logits, 1)))


def confident_sums(teacher: CoTrained, views: list[np.ndarray]) -> dict[tuple[int, int], list[np.ndarray]]:
    """(view, class) -> [rows, gradient, Hessian] over the rows that the other view is confident of."""
    out = {}
    for k in (0, 1):
        p = _sigmoid(teacher.calibrations[1 - k].logit(teacher.views[1 - k].logit(views[1 - k])[:, None]))
        for c, rows in ((0, p <= 1 - CONFIDENT), (1, p >= CONFIDENT)):
            if rows.any():
                out[k, c] = [np.array(float(rows.sum())), *teacher.students[k].sums(views[k][rows], np.full(int(rows.sum()), float(c)))]
    return out


Pass = Callable[[CoTrained], dict[tuple[int, int], list[np.ndarray]]]


def co_train(views: list[np.ndarray], y: np.ndarray, pool: Pass | None, rounds: int = ROUNDS,
             standards: list[tuple[np.ndarray, np.ndarray]] | None = None) -> CoTrained:
    """Fit both views; every fourth labelled row is held out for calibration and combination.

    ``pool`` gives ``confident_sums`` over all unlabelled rows.
    """
    held = np.arange(len(y)) % 4 == 3
    if min(y[held].sum(), (1 - y[held]).sum()) < 1:
        held[:] = True
    train = ~held if not held.all() else held
    standards = standards or [_standard(x.mean(0), x.var(0)) for x in views]
    models = [Logistic.fit(x[train], y[train], standard=s) for x, s in zip(views, standards, strict=True)]

    def calibrated() -> list[Logistic]:
        return [Logistic.fit(m.logit(x[held])[:, None], y[held], penalty=0.1) for m, x in zip(models, views, strict=True)]
    for _ in range(rounds if pool else 0):
        teachers = [Logistic(m.mean, m.scale, m.weights.copy()) for m in models]
        scales = calibrated()
        for _ in range(STEPS):
            found = pool(CoTrained(teachers, scales, None, models))
            for k, model in enumerate(models):
                gradient, hessian = model.sums(views[k][train], y[train])
                for c in (0, 1):
                    if (k, c) in found:
                        n, g, h = found[k, c]
                        share = min(1.0, float((y[train] == c).sum()) / float(n))
                        gradient, hessian = gradient + share * g, hessian + share * h
                model.step(gradient, hessian)
    scales = calibrated()
    logits = np.stack([c.logit(m.logit(x[held])[:, None]) for m, c, x in zip(models, scales, views, strict=True)], 1)
    return CoTrained(models, scales, Logistic.fit(logits, y[held], penalty=0.1))


def _features(batch: pa.RecordBatch, n_categories: int) -> list[np.ndarray]:
    return [text_features(batch.column("__text")),
            metadata_features([batch.column(f"__c{i}").to_pylist() for i in range(n_categories)],
                              batch.column("__length").to_pylist())]


_SUMS = "view int, cls int, slot int, n double, g binary, h binary"


def _pool_pass(table: DataFrame, sizes: list[int]) -> Pass:
    """``confident_sums`` over the unlabelled rows of the feature table."""
    def add(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, g, h = 0.0, 0.0, 0.0
        for batch in parts:
            for r in batch.to_pylist():
                n, g, h = n + r["n"], g + np.frombuffer(r["g"]), h + np.frombuffer(r["h"])
        yield pa.RecordBatch.from_pylist([{"view": key[0].as_py(), "cls": key[1].as_py(), "slot": key[2].as_py(), "n": n,
                                           "g": g.tobytes(), "h": h.tobytes()}], schema=_SUMS_ARROW)

    def run(teacher: CoTrained) -> dict[tuple[int, int], list[np.ndarray]]:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], list[np.ndarray]] = {}
            for batch in batches:
                views = [_matrix(batch.column(c), n) for c, n in zip("xm", sizes)]
                for key, values in confident_sums(teacher, views).items():
                    total[key] = [a + b for a, b in zip(total[key], values)] if key in total else values
            slot = TaskContext.get().partitionId() % SLOTS
            yield pa.RecordBatch.from_pylist([{"view": k, "cls": c, "slot": slot, "n": float(n), "g": g.tobytes(), "h": h.tobytes()}
                                              for (k, c), (n, g, h) in total.items()], schema=_SUMS_ARROW)
        found = table.where("y is null").select("x", "m").mapInArrow(sums, _SUMS).groupBy("view", "cls", "slot").applyInArrow(add, _SUMS)
        out: dict[tuple[int, int], list[np.ndarray]] = {}
        for r in sorted(found.collect(), key=lambda r: (r["view"], r["cls"], r["slot"])):  # at most 4 x SLOTS rows
            d = sizes[r["view"]] + 1
            values = [np.array(r["n"]), np.frombuffer(r["g"]), np.frombuffer(r["h"]).reshape(d, d)]
            key = (r["view"], r["cls"])
            out[key] = [a + b for a, b in zip(out[key], values)] if key in out else values
        return out
    return run


_SUMS_ARROW = pa.schema([("view", pa.int32()), ("cls", pa.int32()), ("slot", pa.int32()), ("n", pa.float64()), ("g", pa.binary()), ("h", pa.binary())])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of packed floats."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), width)


def _spread(table: DataFrame, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Mean and scale of each view over all documents."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0.0, np.zeros(n), np.zeros(n)] for n in sizes]
        for batch in batches:
            for t, c, n in zip(total, "xm", sizes):
                v = _matrix(batch.column(c), n).astype(np.float64)
                t[0], t[1], t[2] = t[0] + len(v), t[1] + v.sum(0), t[2] + (v * v).sum(0)
        yield pa.RecordBatch.from_pylist([{"view": k, "n": t[0], "g": t[1].tobytes(), "h": t[2].tobytes()} for k, t in enumerate(total)])
    rows = table.select("x", "m").mapInArrow(moments, "view bigint, n double, g binary, h binary").collect()  # two rows per task
    out = []
    for k in range(len(sizes)):
        n, s, q = (sum(x) for x in zip(*[(r["n"], np.frombuffer(r["g"]), np.frombuffer(r["h"])) for r in rows if r["view"] == k]))
        mean = s / max(n, 1)
        out.append(_standard(mean, q / max(n, 1) - mean * mean))
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, category_cols: list[str], length_col: str,
        label_col: str, max_labelled: int = MAX_LABELLED) -> CoTrained | None:
    """The co-trained model, or None with too few labels."""
    n_categories = len(category_cols)
    clean = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.min(label_col).alias("y"), F.max(label_col).alias("y1")).where("y = y1").select("id", F.col("y").cast("double"))
    by_hash = F.xxhash64(F.lit(5), "id")
    ids = docs.select(F.col(f"`{id_col}`").alias("id"))
    chosen = [(r["id"], r["y"]) for r in ids.join(clean, "id").orderBy(by_hash, "id").limit(max_labelled).collect()]
    if min(sum(y == 1 for _, y in chosen), sum(y == 0 for _, y in chosen)) < LEAST:
        return None
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    picked = spark.createDataFrame(chosen, T.StructType([T.StructField("__id", kind), T.StructField("__y", T.DoubleType())]))
    rows = _viewed(docs, [], text_col, category_cols, length_col, F.col(f"`{id_col}`").alias("__id")).join(
        F.broadcast(picked.distinct()), "__id", "left")  # at most ``max_labelled`` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = (v.astype(np.float32) for v in _features(batch, n_categories))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__y"), *[pa.array([r.tobytes() for r in v], pa.binary()) for v in (x, m)]],
                ["id", "y", "x", "m"])
    table = materialize(rows.mapInArrow(run, T.StructType([
        T.StructField("id", kind), T.StructField("y", T.DoubleType()), T.StructField("x", T.BinaryType()),
        T.StructField("m", T.BinaryType())])), "quality-features")
    got = sorted(table.where("y is not null").collect(), key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["id"], r["x"]))
    views = [np.array([np.frombuffer(r[c], np.float32) for r in got]) for c in ("x", "m")]
    sizes = [v.shape[1] for v in views]
    return co_train(views, np.array([r["y"] for r in got]), _pool_pass(table, sizes), standards=_spread(table, sizes))


def _viewed(docs: DataFrame, keep: list[str], text_col: str, category_cols: list[str], length_col: str, *more) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text"),
                       *[F.col(f"`{c}`").cast("string").alias(f"__c{i}") for i, c in enumerate(category_cols)],
                       F.col(f"`{length_col}`").cast("long").alias("__length"), *more)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          category_cols: tuple[str, ...] = ("source", "lang"), length_col: str = "n_chars", label_col: str = "quality",
          keep: list[str] | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with the scores ``RESULTS``, each 0 to 1 (good)."""
    category_cols = list(category_cols)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    model = fit(docs, labels, id_col, text_col, category_cols, length_col, label_col, max_labelled)
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in keep], *[F.lit(1.0).alias(c) for c in RESULTS])
    n_categories = len(category_cols)

    # an Arrow function of the columns: each text goes to Python once and does not come back
    @F.arrow_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in RESULTS]))
    def scores(text: pa.Array, length: pa.Array, *categories: pa.Array) -> pa.Array:
        views = [text_features(text), metadata_features([c.to_pylist() for c in categories[:n_categories]], length.to_pylist())]
        return pa.StructArray.from_arrays([pa.array(s.astype(np.float64)) for s in model.scores(views)], list(RESULTS))
    one = scores(F.col(f"`{text_col}`").cast("string"), F.col(f"`{length_col}`").cast("long"),
                 *[F.col(f"`{c}`").cast("string") for c in category_cols])
    scored = docs.select(*[F.col(f"`{c}`") for c in keep], one.alias("__scores"))
    return scored.select(*[F.col(f"`{c}`") for c in keep], *[F.col("__scores")[c].alias(c) for c in RESULTS])
