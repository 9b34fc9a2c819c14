"""Quality scores from document statistics: random Fourier features, ridge, isotonic calibration.

Cosines of random projections approximate a Gaussian kernel over standardised
statistics of a text. Their normal equations are summed per partition, then over
groups of partitions, so the ridge is fitted on every labelled training row while
only matrices of fixed size travel. An isotonic curve, fitted on training rows
that the ridge has not seen, turns its values into probabilities.

Labels are learned only from rows outside the held-out fold. Labels, language,
source and id never enter a score; the id only chooses the fold.

NULL is scored as the empty text. Without labels of both kinds there is nothing
to learn: every score is then the share of label 1, or 0.5 without labels. Rows
that repeat an id are scored one by one, and each learns from each of its labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.words import SPACED_WORDS, slices, text_bytes, tidy, word_bounds, word_hashes
from landfall.session import materialize

# Random features, the kernel's width over standardised statistics, the ridge, and the seed.
FEATURES = 160
GAMMA = 0.15
RIDGE = 1e-3
SEED = 20240229

# Statistics are limited to so many standard deviations.
CLIP = 6.0

# Steps of the raw value that calibration tells apart, and the weight of the raw
# value in a score, which keeps the order within flat stretches of the curve.
STEPS = 256
ORDER_WEIGHT = 0.01

FOLDS = 5
THRESHOLD = 0.3

STATISTICS = (
    "log_words", "word_length", "long_words", "symbols", "capitals", "digits", "punctuation", "shouts", "bars",
    "repeated_next", "different_words", "line_length", "repeated_lines", "non_ascii", "stops", "commas",
)


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars.encode())] = True
    return out


_SYMBOLS = _table("#*$%&|<>")
_CAPITALS = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTERS = _CAPITALS | _table("abcdefghijklmnopqrstuvwxyz")
_DIGITS = _table("0123456789")
_PUNCTUATION = _table("!\"'()+,-./:;=?@[\\]^_`{}~")


def _different(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each owner has."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new], minlength=n)


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text, each in a bounded range whatever the length of the text."""
    n = len(texts)
    data, at = text_bytes(texts)
    begin, end, owner = word_bounds(data, at, SPACED_WORDS)
    words = np.bincount(owner, minlength=n)

    def per_text(table: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(table[data])))
        return (total[at[1:]] - total[at[:-1]]).astype(float)

    size = np.maximum(np.diff(at), 1).astype(float)
    many = np.maximum(words, 1).astype(float)
    length = end - begin
    hashes = word_hashes(data, begin, end)
    again = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]) if len(hashes) else np.zeros(0, dtype=bool)
    last = data[end - 1] if len(end) else np.zeros(0, dtype=np.uint8)
    is_line = np.ones(256, dtype=bool)
    is_line[10] = False
    lo, hi, line_owner = word_bounds(data, at, is_line)
    lines = np.maximum(np.bincount(line_owner, minlength=n), 1).astype(float)
    counted = [
        np.log1p(words),
        np.minimum(np.bincount(owner, weights=length, minlength=n) / many, 40.0),
        np.bincount(owner, weights=length > 20, minlength=n) / many,
        per_text(_SYMBOLS) / size,
        per_text(_CAPITALS) / np.maximum(per_text(_LETTERS), 1),
        per_text(_DIGITS) / size,
        per_text(_PUNCTUATION) / size,
        np.bincount(owner, weights=last == ord("!"), minlength=n) / many,
        np.bincount(owner, weights=(length == 1) & (last == ord("|")), minlength=n) / many,
        np.bincount(owner[1:][again], minlength=n) / many,
        _different(hashes, owner, n) / many**0.9,
        np.log1p(words / lines),
        1 - _different(word_hashes(data, lo, hi), line_owner, n) / lines * (np.bincount(line_owner, minlength=n) > 0),
        (np.bincount(np.searchsorted(at, np.flatnonzero(data >= 0x80), side="right") - 1, minlength=n)[:n]) / size,
        np.bincount(owner, weights=last == ord("."), minlength=n) / many,
        np.bincount(owner, weights=last == ord(","), minlength=n) / many,
    ]
    return np.stack(counted, axis=1).astype(np.float64)


def fold(id_col: str = "doc_id") -> Column:
    """The fold of a row: CRC-32 of its id as text, modulo ``FOLDS``. A missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id and statistics, from the whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                found = statistics(piece.column("text"))
                at = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.ListArray.from_arrays(at, found.reshape(-1))], ["id", "x"]
                )

    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(tidy(rows), "id long, x array<double>")


@dataclass
class Model:
    """A fitted classifier; a few hundred numbers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return random_features(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        curve = np.interp(raw, self.knots, self.values)
        return np.clip((1 - ORDER_WEIGHT) * curve + ORDER_WEIGHT * np.clip((raw + 1) / 3, 0, 1), 0, 1)


def random_features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """A constant, the standardised statistics, and the cosines; the same draw everywhere."""
    rng = np.random.default_rng(SEED)
    x = np.clip((x - mean) / scale, -CLIP, CLIP)
    turns = rng.normal(0, np.sqrt(2 * GAMMA), (x.shape[1], FEATURES))
    cosines = np.cos(x @ turns + rng.uniform(0, 2 * np.pi, FEATURES)) * np.sqrt(2 / FEATURES)
    return np.concatenate([np.ones((len(x), 1)), x / 10, cosines], axis=1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, len(STATISTICS))


def _summed(rows: DataFrame, terms, size: int, groups: int = 64) -> np.ndarray:
    """Sum of ``terms(x, y)``, a vector of ``size``, over all rows: per partition, then per group of partitions."""

    def partial(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += terms(_matrix(batch), batch.column("y").to_numpy())
        number = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([number % groups]), pa.array([total.tobytes()])], ["part", "total"])

    def added(key, table):
        total = np.sum([np.frombuffer(t, dtype=float) for t in table.column("total").to_pylist()], axis=0)
        return pa.table({"part": [key[0].as_py()], "total": [total.tobytes()]})

    kind = "part long, total binary"
    parts = rows.select("x", "y").mapInArrow(tidy(partial), kind).groupBy("part").applyInArrow(added, kind).collect()
    return np.sum([np.zeros(size), *(np.frombuffer(r.total, dtype=float) for r in parts)], axis=0)


def pooled(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """The best non-falling curve of shares by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    for n, k in zip(total.tolist(), good.tolist(), strict=True):
        blocks.append([n, k, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, k, size = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + k, blocks[-1][2] + size]
    return np.concatenate([np.full(size, k / n if n else 0.0) for n, k, size in blocks])


def fit(rows: DataFrame) -> Model:
    """A model of rows with ``x``, ``y`` (0 or 1) and ``calibrates``, which tells the rows kept for calibration."""
    width = len(STATISTICS)
    fitted = rows.filter("not calibrates")
    sums = _summed(fitted, lambda x, y: np.concatenate(([len(y), y.sum()], x.sum(0), (x * x).sum(0))), 2 + 2 * width)
    n, good = sums[0], sums[1]
    if n == 0 or good in (0, n):
        share = good / n if n else 0.5
        flat = np.zeros(1 + width + FEATURES)
        return Model(np.zeros(width), np.ones(width), flat, np.array([0.0]), np.array([share]))
    mean = sums[2 : 2 + width] / n
    scale = np.sqrt(np.maximum(sums[2 + width :] / n - mean**2, 0)) + 1e-3
    size = 1 + width + FEATURES

    def normal(x, y):
        z = random_features(x, mean, scale)
        # Both labels weigh the same in all.
        weight = np.where(y > 0, 0.5 * n / good, 0.5 * n / (n - good))[:, None]
        return np.concatenate([(z.T @ (weight * z)).reshape(-1), z.T @ (weight[:, 0] * y)])

    total = _summed(fitted, normal, size * size + size)
    left = total[: size * size].reshape(size, size) / n
    penalty = RIDGE * np.eye(size)
    penalty[0, 0] = 0
    weights = np.linalg.solve(left + penalty, total[size * size :] / n)
    model = Model(mean, scale, weights, np.array([0.0]), np.array([0.0]))

    def binned(x, y):
        step = np.clip(((model.raw(x) + 0.5) * STEPS / 2).astype(int), 0, STEPS - 1)
        return np.concatenate([np.bincount(step, minlength=STEPS), np.bincount(step, weights=y, minlength=STEPS)])

    counts = _summed(rows.filter("calibrates"), binned, 2 * STEPS)
    total, right = counts[:STEPS], counts[STEPS:]
    used = total > 0
    if not used.any():
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return model
    model.knots = ((np.arange(STEPS) + 0.5) * 2 / STEPS - 0.5)[used]
    model.values = pooled(total[used], right[used])
    return model


def trained(stats: DataFrame, labels: DataFrame) -> Model:
    """A model from rows of ``id`` and ``x`` and their labels outside the held-out fold."""
    labels = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("double").alias("y"))
    rows = stats.join(labels.filter("y in (0, 1)"), F.col("id") == F.col("_id"))
    number = fold("id")
    return fit(materialize(rows.filter(number != 0).select("x", "y", (number == FOLDS - 1).alias("calibrates"))))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Per row of ``docs`` its id, ``held_out``, ``score`` and ``predicted``."""
    stats = materialize(with_statistics(docs, id_col, text_col))
    model = docs.sparkSession.sparkContext.broadcast(trained(stats, labels))

    def scored(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("id"), model.value.score(_matrix(batch))], ["id", "score"])

    out = stats.mapInArrow(tidy(scored), "id long, score double")
    return out.select(
        F.col("id").alias(id_col),
        (fold("id") == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(trained(with_statistics(docs, id_col, text_col), labels))
    columns = docs.columns
    names = [f"_c{k}" for k in range(len(columns))]  # extra columns may have any name

    def kept(batches):
        for batch in batches:
            for piece in slices(batch, text):
                good = model.value.score(statistics(piece.column(text))) >= threshold
                yield piece.filter(pa.array(good))

    text = names[columns.index(text_col)]
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(columns, names, strict=True)])
    kinds = ", ".join(f"{k} {f.dataType.simpleString()}" for k, f in zip(names, docs.schema.fields, strict=True))
    rows = rows.mapInArrow(tidy(kept), kinds)
    return rows.select(*[F.col(k).alias(c) for k, c in zip(names, columns, strict=True)])
