"""Quality scores: document statistics, random Fourier features, ridge from partition sums, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import LOWER_VALUES, range_hashes, row_of, slices, text_bytes, word_ranges
from .tables import cut_lineage, held_out, text_of

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_dev", "upper", "digits", "signs", "stops", "lines", "outside_ascii",
    "sign_words", "ends_in_sign", "repeats_last", "distinct", "distinct_lines",
)


def _mask(codes: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


_ALL = bytes(range(256))
_SPACE = _mask(b"\t\n\x0b\x0c\r ")
_UPPER, _LETTER = _mask(_ALL[65:91]), _mask(_ALL[65:91] + _ALL[97:123] + _ALL[128:])
_DIGIT, _STOP = _mask(b"0123456789"), _mask(b".,;:?'-")
_SIGN = ~(_SPACE | _LETTER | _DIGIT | _STOP)


def _per_row(of: np.ndarray, limits: np.ndarray) -> np.ndarray:
    upto = np.zeros(len(of) + 1, np.int64)
    np.cumsum(of, out=upto[1:])
    return (upto[limits[1:]] - upto[limits[:-1]]).astype(float)


def _distinct(values: np.ndarray, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many different values each row has."""
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[new], minlength=len(first) - 1).astype(float)


def statistics_of(column: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text; an empty text has zeros."""
    data, limits = text_bytes(column)
    size = np.diff(limits).astype(float)
    starts, ends = word_ranges(data, limits, ~_SPACE)
    first = row_of(starts, limits)
    words = np.diff(first).astype(float)
    rows = np.repeat(np.arange(len(words)), np.diff(first))
    hashes = range_hashes(data, starts, ends, LOWER_VALUES)
    lengths = (ends - starts).astype(float)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    line_at, line_to = word_ranges(data, limits, ~_mask(b"\n"))
    line_first = row_of(line_at, limits)
    line_rows = np.repeat(np.arange(len(words)), np.diff(line_first))
    lines = np.diff(line_first).astype(float)
    some, letters = np.maximum(words, 1), np.maximum(_per_row(_LETTER[data], limits), 1)
    signs = _SIGN[data]
    alone = np.zeros(len(starts), bool)
    if len(starts):
        alone = signs[starts] & (ends - starts == 1)
    mean = np.bincount(rows, lengths, len(words)) / some
    spread = np.bincount(rows, lengths**2, len(words)) / some - mean**2
    count = np.maximum(size, 1)
    return np.column_stack([
        np.log1p(size), np.log1p(words), np.minimum(mean, 50), np.minimum(np.sqrt(np.maximum(spread, 0)), 50),
        _per_row(_UPPER[data], limits) / letters, _per_row(_DIGIT[data], limits) / count, _per_row(signs, limits) / count,
        _per_row(_STOP[data], limits) / count, _per_row(data == 10, limits) / count, _per_row(data >= 128, limits) / count,
        np.bincount(rows, alone, len(words)) / some,
        np.bincount(rows, signs[ends - 1] if len(ends) else None, len(words)) / some if len(ends) else np.zeros(len(words)),
        np.bincount(rows, again, len(words)) / some, _distinct(hashes, rows, first) / some,
        _distinct(range_hashes(data, line_at, line_to), line_rows, line_first) / np.maximum(lines, 1),
    ])


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``x`` (array of ``STATISTICS``) for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            x = statistics_of(batch.column(1))
            flat = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.ravel())
            yield pa.record_batch([batch.column(0), flat], ["doc_id", "x"])

    return rows.mapInArrow(run, f"doc_id {kind}, x array<double>")


class Fourier:
    """Random features whose products approximate a Gaussian kernel of the standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, dev: np.ndarray, features: int, width: float, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.dev = mean, np.where(dev > 1e-9, dev, 1.0)
        self.turn = rng.normal(0, 1 / width, (len(mean), features))
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.dev, -8, 8)
        return np.column_stack([np.sqrt(2 / len(self.phase)) * np.cos(z @ self.turn + self.phase), np.ones(len(x))])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _normal_equations(rows: DataFrame, features: Fourier, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over all rows of (x, y). Each task sends its own sums, entry by entry, and Spark adds them up."""
    d = len(features.phase) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((d, d + 1))
        for batch in batches:
            z = features(_matrix(batch.column(0), width))
            gram += z.T @ np.column_stack([z, batch.column(1).to_numpy(zero_copy_only=False)])
        if gram.any():
            at = np.arange(gram.size, dtype=np.int32)
            yield pa.record_batch([at, gram.ravel()], ["at", "v"])

    total = np.zeros(d * (d + 1))
    for at, v in rows.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v")).collect():  # d * (d + 1) numbers
        total[at] = v
    total = total.reshape(d, d + 1)
    return total[:, :d], total[:, d]


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the nearest rising step function through (x, y), as the middles and heights of its steps."""
    steps: list[list[float]] = []
    for a, b, w in zip(x, y, weight):
        steps.append([a * w, b * w, w])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            last = steps.pop()
            steps[-1] = [p + q for p, q in zip(steps[-1], last)]
    out = np.array(steps).reshape(-1, 3)
    return out[:, 0] / out[:, 2], out[:, 1] / out[:, 2]


class Model:
    """Ridge weights over random features, and the steps that turn raw scores into probabilities."""

    def __init__(self, fourier: Fourier, weights: np.ndarray, grid: int) -> None:
        self.fourier, self.weights, self.grid = fourier, weights, grid
        self.xs, self.ys = np.zeros(1), np.full(1, 0.5)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.fourier(x) @ self.weights, -1.0, 2.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.xs, self.ys), 0, 1)

    def calibrate(self, training: DataFrame, width: int) -> None:
        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.round(self.raw(_matrix(batch.column(0), width)) * self.grid).astype(np.int32)
                yield pa.record_batch([at, batch.column(1)], ["at", "y"])

        # at most 3 * grid + 1 steps, as raw scores are cut to -1..2
        steps = sorted(training.mapInArrow(binned, "at int, y double").groupBy("at").agg(F.avg("y"), F.count("*")).collect())
        if steps:
            at, height, count = (np.array(c, float) for c in zip(*steps))
            self.xs, self.ys = isotonic(at / self.grid, height, count)


def fit_quality(
    kept: DataFrame, labels: DataFrame, label: str = "quality", features: int = 256, width: float = 3.0, ridge: float = 1e-3,
    grid: int = 512, seed: int = 7,
) -> Model:
    """Fit on stored statistics of all texts and on the labels of all rows that are not held out."""
    n_x = len(STATISTICS)
    moments = kept.agg(*(f(F.col("x")[i]) for i in range(n_x) for f in (F.avg, F.stddev_pop))).first()
    mean, dev = (np.array([v or 0.0 for v in moments[i::2]]) for i in (0, 1))
    fourier = Fourier(mean, dev, features, width, seed)
    known = labels.select(F.col("doc_id").alias("of"), F.col(label).cast("double").alias("y")).filter("y IS NOT NULL AND of IS NOT NULL")
    training = kept.filter(~held_out()).join(known, F.col("doc_id") == F.col("of")).select("x", "y")
    gram, target = _normal_equations(training, fourier, n_x)
    weights = np.linalg.solve(gram + ridge * max(gram[-1, -1], 1) / features * np.eye(len(gram)), target)
    model = Model(fourier, weights, grid)
    model.calibrate(training, n_x)
    return model


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options,
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` in 0..1 (higher: label 1 likelier), ``predicted``.

    Labels are read only from rows that are not held out (crc32 of the id modulo 5). Statistics of every text are stored
    once; their means and deviations come from all rows, the normal equations from all training rows as sums per
    partition. The ridge scores are calibrated by isotonic regression over ``grid`` steps per unit, joined by lines.

    Null and empty texts have zero statistics and get a score; null labels and ids train nothing; repeated rows each get
    their score; without training rows every score is 0.5; no rows give no rows. Other columns are not read.
    """
    kept = cut_lineage(statistics(docs, id_col, text_col))
    model = fit_quality(kept, labels, label, **options)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), model.score(_matrix(batch.column(1), len(STATISTICS)))], ["doc_id", "score"])

    kind = kept.schema["doc_id"].dataType.simpleString()
    out = kept.select("doc_id", "x").mapInArrow(scored, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(
    docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches ``threshold``. No shuffle of texts: the fitted
    model goes over the rows a second time."""
    model = fit_quality(cut_lineage(statistics(docs, id_col, text_col)), labels, label, **options)
    at = docs.columns.index(text_col)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            keep = model.score(statistics_of(pc.fill_null(batch.column(at), ""))) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(good, docs.schema)
