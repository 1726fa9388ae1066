"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

Statistics are taken from whole texts in one pass. The features ``sqrt(2/D) cos(Wx + b)`` approximate a
Gaussian kernel; every partition sums its part of the normal equations and Spark adds the parts, so
only D x D numbers reach the driver. A fold of the labelled rows that the ridge fit never saw gives
the isotonic calibration, from counts in a fixed number of bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listlake.llm.common import SPACES, fingerprinted, fold, mix, saved, slices, utf8, word_hashes, words

FEATURES = 160
RIDGE = 1e-3
BINS = 2000
THRESHOLD = 0.7

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_LOWER[128:] = True  # letters beyond ASCII
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:"]] = True
_LOUD = np.zeros(256, bool)
_LOUD[[ord(c) for c in "!?"]] = True
_SYMBOL = ~(SPACES | _UPPER | _LOWER | _DIGIT | _STOP | _LOUD)


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: the number of distinct values, and the count of the most frequent one."""
    if not len(values):
        return np.zeros(rows), np.zeros(rows)
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (r[1:] != r[:-1])]))
    counts = np.diff(np.append(first, len(v)))
    most = np.zeros(rows)
    np.maximum.at(most, r[first], counts)
    return np.bincount(r[first], minlength=rows).astype(float), most


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The statistics of each row, one column each; an empty text has a row of fixed values."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    start, end, row = words(data, offsets)
    count = np.bincount(row, minlength=n).astype(float)
    length = (end - start).astype(float)
    has_size, has_words = np.maximum(size, 1), np.maximum(count, 1)
    share = {name: _per_row(flags[data], offsets) / has_size for name, flags in (
        ("upper", _UPPER), ("lower", _LOWER), ("digit", _DIGIT), ("stop", _STOP), ("loud", _LOUD), ("symbol", _SYMBOL), ("space", SPACES))}
    newlines = _per_row(data == 10, offsets)
    hashes = word_hashes(data, start, end)
    same = row[1:] == row[:-1]
    pairs = mix(hashes[:-1] * np.uint64(0x2545F4914F6CDD1D) + hashes[1:])[same]
    distinct, most = _distinct(hashes, row, n)
    distinct_pairs, most_pairs = _distinct(pairs, row[1:][same], n)
    has_pairs = np.maximum(count - 1, 1)
    repeats = np.bincount(row[1:][same & (hashes[1:] == hashes[:-1])], minlength=n)
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    mean = np.bincount(row, length, n) / has_words
    spread = np.sqrt(np.maximum(0, np.bincount(row, length**2, n) / has_words - mean**2))
    by_row = lambda flags: np.bincount(row, flags, n) / has_words
    return np.column_stack([
        np.log1p(size) / 3, np.log1p(count) / 3, *share.values(), np.sqrt(share["symbol"]), np.sqrt(share["loud"]),
        newlines / has_words, np.log1p(mean), np.log1p(spread), by_row(length <= 2), by_row(_SYMBOL[last]), by_row(_LOUD[last]),
        by_row(_STOP[last]), distinct / has_words, np.log(distinct + 1) / np.log(count + 2), most / has_words,
        distinct_pairs / has_pairs, most_pairs / has_pairs, repeats / has_words,
    ])


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """``id, x``: the key and the statistics of each row's whole text (null: empty); ``row`` is carried along."""
    carried = ["id", *([row] if row else [])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = measures(*utf8(batch.column("text"))).astype(np.float32)
            flat = pa.array(x.ravel())
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays([*map(batch.column, carried), rows], [*carried, "x"])

    rows = docs.select(F.col(key).cast("long").alias("id"), *carried[1:], F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, ", ".join(f"`{c}` long" for c in carried) + ", x array<float>")


@dataclass
class Model:
    """The fitted parameters; a few hundred numbers for each of ``FEATURES``."""

    centre: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        out = np.cos(z @ self.w + self.b) * np.sqrt(2 / self.w.shape[1])
        return np.column_stack([np.ones(len(x)), out])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        level = np.interp(raw, self.knots, self.values)
        # A small share of the raw score keeps the order within one level.
        return np.clip(0.999 * level + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    lists = batch.column(name)
    return lists.flatten().to_numpy().astype(np.float64).reshape(len(lists), -1)


def isotonic(centres: np.ndarray, positive: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing levels, as knots over the bins' centres."""
    levels: list[list[float]] = []
    for x, p, n in zip(centres, positive, count, strict=True):
        levels.append([x, x, p, n])
        while len(levels) > 1 and levels[-2][2] * levels[-1][3] >= levels[-1][2] * levels[-2][3]:
            _, hi, p2, n2 = levels.pop()
            lo, _, p1, n1 = levels.pop()
            levels.append([lo, hi, p1 + p2, n1 + n2])
    knots = [x for lo, hi, _, _ in levels for x in ((lo, hi) if hi > lo else (lo,))]
    values = [p / n for lo, hi, p, n in levels for _ in ((lo, hi) if hi > lo else (lo,))]
    return np.array(knots), np.array(values)


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = 7) -> Model | None:
    """The model of rows ``x, label, calibrate``; None if there is no labelled row.

    Rows with ``calibrate`` go to the isotonic fit, the rest to the ridge fit; if either part is empty,
    all rows serve both.
    """
    width = 1 + len(labelled.select("x").first()["x"] if (some := labelled.limit(1).count()) else [])
    if not some:
        return None
    sums = [F.sum(F.get("x", F.lit(i)).cast("double")).alias(f"s{i}") for i in range(width - 1)]
    squares = [F.sum(F.pow(F.get("x", F.lit(i)).cast("double"), F.lit(2))).alias(f"q{i}") for i in range(width - 1)]
    total = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("calibrate").cast("int")).alias("c"), *sums, *squares).first()
    centre = np.array([total[f"s{i}"] / total["n"] for i in range(width - 1)])
    spread = np.sqrt(np.maximum(0, np.array([total[f"q{i}"] / total["n"] for i in range(width - 1)]) - centre**2))
    rng = np.random.default_rng(seed)
    # The kernel's width: the distance of two standardised rows is about sqrt(2 * width).
    w = rng.normal(0, 1 / np.sqrt(width), (width - 1, features))
    model = Model(centre, np.maximum(spread, 1e-3), w, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(1), np.zeros(1))
    split = 0 < total["c"] < total["n"]
    train, check = (labelled.filter("not calibrate"), labelled.filter("calibrate")) if split else (labelled, labelled)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = features + 1
        a = np.zeros((d, d + 1))
        for batch in batches:
            if batch.num_rows:
                z = model.features(_matrix(batch))
                a[:, :d] += z.T @ z
                a[:, d] += z.T @ batch.column("label").to_numpy(zero_copy_only=False)
        i, j = np.triu_indices(d, 0, d + 1)
        if a.any():
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(a[i, j])], ["i", "j", "v"])

    cells = train.select("x", "label").mapInArrow(equations, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    a = np.zeros((features + 1, features + 2))
    a[cells["i"], cells["j"]] = cells["v"]
    gram = np.triu(a[:, :-1]) + np.triu(a[:, :-1], 1).T
    model.weights = np.linalg.solve(gram + ridge * max(1.0, gram[0, 0]) * np.eye(features + 1) / features, a[:, -1])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.clip((model.raw(_matrix(batch)) + 0.5) * BINS / 2, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], ["bin", "label"])

    bins = check.select("x", "label").mapInArrow(raw, "bin long, label double").groupBy("bin")
    bins = bins.agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n")).orderBy("bin").toPandas()
    model.knots, model.values = isotonic((bins["bin"].to_numpy() + 0.5) * 2 / BINS - 0.5, bins["p"].to_numpy(), bins["n"].to_numpy())
    return model


def quality_scores(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    learn: Column | None = None, threshold: float = THRESHOLD, features: int = FEATURES, row: str | None = None,
) -> DataFrame:
    """``<key>, held_out, score, predicted`` for every row of ``docs``, and the column ``row``, if one is named.

    ``learn`` says of a key (column ``id``) whether its label may be used; by default those whose crc32
    modulo 4 is not 2. Rows of ``labels`` without key or label are left out; a key with several labels
    counts once for each. Null and empty texts get the score of an empty text. Without any label, every
    score is 0.5. Other columns are ignored.
    """
    x = saved(statistics(docs, key, text, row), "statistics")
    carried = ["id", *([row] if row else [])]
    marks = labels.select(F.col(key).cast("long").alias("id"), F.col(label).cast("double").alias("label")).dropna()
    learn = (fold(F.col("id")) != 2) if learn is None else learn
    labelled = saved(x.join(marks.filter(learn), "id").select("x", "label", (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("calibrate")), "labelled")
    model = fit(labelled, features)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_matrix(batch)) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([*map(batch.column, carried), pa.array(s)], [*carried, "score"])

    scored = x.mapInArrow(score, ", ".join(f"`{c}` long" for c in carried) + ", score double")
    return scored.select(
        F.col("id").alias(key), *carried[1:], (fold(F.col("id")) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be bad, with all their columns.

    Each row is judged by its own text, whatever its key: of rows with one key, or none, some may go and
    others stay.
    """
    rows, row = fingerprinted(docs, key, text)
    bad = quality_scores(rows, labels, key, text, threshold=threshold, row=row).filter("predicted = 0").select(row).distinct()
    return rows.join(bad, row, "left_anti").select(*docs.columns)
