"""Hard negatives: rows of another label that score a little below an anchor's positives.

Vectors are integers, and a score is their exact inner product. Every row stores
its norm and its angles to a few reference directions. For an anchor a, a row x
and each reference r, the angle between a and x lies between ``|t_r(a) - t_r(x)|``
and ``min(t_r(a) + t_r(x), 2 pi - t_r(a) - t_r(x))``, which bounds its cosine and,
times the norms and rounded outwards, the score. Integer scores are computed only
where these bounds overlap a window that is asked for.

Rows are stored once in blocks, sorted by label, nearest reference and angle, so
that a block covers a small range of angles. Blocks of anchors meet blocks of rows
as blocks: the ranges of angles decide first which pairs of blocks may overlap (on
a directory of one row per block), then within a pair which anchors and which rows.
Positives are searched in blocks of the anchor's label and above the score of the
k-th best row of the anchor's own block; negatives in blocks of other labels and
within the windows of the positives. A task holds one pair of blocks at a time, so
a label with most of the rows is spread like all others. Results of pairs, a few
rows per anchor, are ranked at the end.

Rows with a NULL id, label or vector, or a component that is NULL or not finite,
take no part. Rows that are equal in id, label and vector count once; rows that
share only an id are rows of their own, but never partners of each other. Of
vectors of different length the shorter one counts as ending in zeros, hence a zero
or empty vector scores 0. Anchors without positives give no rows, nor do positives
without negatives or an empty table. Components whose products might leave 64 bits
raise an error. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.vectors import binary_rows, doubles, from_binary, is_finite, lists, longest, matrix, whole_numbers
from landfall.llm.words import tidy
from landfall.session import materialize

# Reference directions, and the rows they are chosen from: those of the smallest hashes.
REFERENCES = 16
SAMPLE = 2048

# Rows in a block.
ROWS = 4096

# What bounds are widened by: angles in radians, scores relatively and absolutely. Far
# above the rounding of an arc cosine, about 2e-8 at its ends.
ANGLE_SLACK = 1e-6
SCORE_SLACK = 1e-9

# Up to here sums of products of doubles that hold integers are exact.
EXACT = float(2**53)

_BLOCKS = (
    "block long, n int, ids binary, x binary, norms binary, angles binary, anchors binary, "
    "lo array<double>, hi array<double>, least_norm double, most_norm double"
)


def reference_directions(x: np.ndarray, count: int = REFERENCES) -> np.ndarray:
    """Unit vectors that are far from each other: each is the row at the largest angle to all before."""
    norms = np.linalg.norm(x, axis=1)
    units = x[norms > 0] / norms[norms > 0, None]
    if not len(units):
        return np.eye(1, x.shape[1])
    chosen = [0]
    nearest = units @ units[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def angles_to(x: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of each row to each reference; of a zero vector, right angles."""
    cosines = (x @ references.T) / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def score_bounds(least, most, norm_least, norm_most):
    """Scores that the inner product never leaves, given bounds of the angle and of the product of norms."""
    top, bottom = np.cos(np.maximum(least - ANGLE_SLACK, 0.0)), np.cos(np.minimum(most + ANGLE_SLACK, np.pi))
    high = np.where(top >= 0, top * norm_most, top * norm_least)
    low = np.where(bottom >= 0, bottom * norm_least, bottom * norm_most)
    slack = 1.0 + SCORE_SLACK * norm_most
    return np.floor(low - slack), np.ceil(high + slack)


def angle_bounds(angles: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most angle of each row (by its angles to the references) to points whose angles lie in ``lo`` to ``hi``."""
    least = np.maximum(np.maximum(lo - angles, angles - hi), 0.0).max(axis=1)
    most = np.minimum(angles + hi, 2 * np.pi - angles - lo).min(axis=1)
    return least, np.clip(most, least, np.pi)


def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``x``."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(a.shape[1], 1)
    if bound < EXACT:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return a @ x.T


def best(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the highest scores, the smaller id first among equals."""
    if len(score) > count:
        cut = np.partition(score, len(score) - count)[len(score) - count]
        keep = np.flatnonzero(score >= cut)
    else:
        keep = np.arange(len(score))
    return keep[np.lexsort((ids[keep], -score[keep]))][:count]


class Block:
    """A block's rows as arrays."""

    def __init__(self, row: dict, prefix: str, width: int, references: int):
        self.ids = np.frombuffer(row[f"{prefix}ids"], dtype=np.int64)
        self.x = np.frombuffer(row[f"{prefix}x"], dtype=np.int64).reshape(len(self.ids), width)
        self.norms = np.frombuffer(row[f"{prefix}norms"], dtype=np.float64)
        self.angles = np.frombuffer(row[f"{prefix}angles"], dtype=np.float64).reshape(len(self.ids), references)

    def taken(self, rows: np.ndarray) -> Block:
        out = object.__new__(Block)
        out.ids, out.x, out.norms, out.angles = self.ids[rows], self.x[rows], self.norms[rows], self.angles[rows]
        return out

    def overlapping(self, other: Block, least: np.ndarray | float, most: np.ndarray | float) -> np.ndarray:
        """Rows whose score with some row of ``other`` may lie between ``least`` and ``most``."""
        near, far = angle_bounds(self.angles, other.angles.min(axis=0), other.angles.max(axis=0))
        low, high = score_bounds(near, far, self.norms * other.norms.min(), self.norms * other.norms.max())
        return np.flatnonzero((high >= least) & (low <= most))


def _stored(rows: DataFrame, references: np.ndarray, width: int, scale: float) -> DataFrame:
    """All rows in blocks: of one label each, sorted by nearest reference and the angle to it."""
    count = len(references)
    label_type = rows.schema["label"].dataType.simpleString()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_numbers(matrix(batch.column("vector"), width), scale)
            norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
            angles = angles_to(x.astype(np.float64), norms, references)
            cell = angles.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    batch.column("anchor"),
                    pa.array(cell.astype(np.int32)),
                    pa.array(angles[np.arange(len(x)), cell]),
                    binary_rows(x),
                ],
                ["id", "label", "anchor", "cell", "angle", "x"],
            )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        waiting: list[tuple] = []
        label = before = None

        def block() -> pa.RecordBatch:
            nonlocal number
            ids = np.array([r[0] for r in waiting], dtype=np.int64)
            x = np.frombuffer(b"".join(r[1] for r in waiting), dtype=np.int64).reshape(len(ids), width)
            norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
            angles = angles_to(x.astype(np.float64), norms, references)
            anchors = np.flatnonzero([r[2] for r in waiting])
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([label]).cast(batch.schema.field("label").type),
                    pa.array([number]),
                    pa.array([len(ids)], pa.int32()),
                    *(pa.array([v.tobytes()], pa.binary()) for v in (ids, x, norms, angles, anchors.astype(np.int64))),
                    *(lists(v[None, :]) for v in (angles.min(axis=0), angles.max(axis=0))),
                    pa.array([norms.min()]),
                    pa.array([norms.max()]),
                ],
                ["label", *(part.split()[0] for part in _BLOCKS.split(", "))],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("id", "x", "anchor", "label"))
            for i, x, anchor, this in zip(*columns, strict=True):
                if (i, x, this) == before:
                    continue  # equal rows are neighbours
                before = (i, x, this)
                if waiting and (this != label or len(waiting) == ROWS):
                    yield block()
                    waiting.clear()
                label = this
                waiting.append((i, x, anchor))
        if waiting:
            yield block()

    order = ["label", "cell", "angle", "id", "x"]
    sorted_rows = (
        rows.mapInArrow(tidy(measured), f"id long, label {label_type}, anchor boolean, cell int, angle double, x binary")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    return materialize(sorted_rows.mapInArrow(tidy(packed), f"label {label_type}, {_BLOCKS}"))


def _anchor_blocks(blocks: DataFrame, positives: int, width: int, references: int) -> DataFrame:
    """The anchors of each block, with the score that their k-th best row reaches at least."""
    label_type = blocks.schema["label"].dataType.simpleString()
    schema = (
        f"label {label_type}, block long, ids binary, x binary, norms binary, angles binary, floors binary, "
        "lo array<double>, hi array<double>, least_norm double, most_norm double, floor double"
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                anchors = np.frombuffer(row["anchors"], dtype=np.int64)
                if not len(anchors):
                    continue
                block = Block(row, "", width, references)
                mine = block.taken(anchors)
                reached = scores(mine.x, block.x).astype(np.float64)
                reached[mine.ids[:, None] == block.ids] = -np.inf
                floors = np.full(len(anchors), -np.inf)
                # Rows that repeat an id are one partner, so only different ones count.
                if len(np.unique(block.ids)) == len(block.ids) > positives:
                    floors = np.partition(reached, -positives, axis=1)[:, -positives]
                parts = (mine.ids, mine.x, mine.norms, mine.angles, floors)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").slice(i, 1),
                        pa.array([row["block"]]),
                        *(pa.array([v.tobytes()], pa.binary()) for v in parts),
                        *(lists(v[None, :]) for v in (mine.angles.min(axis=0), mine.angles.max(axis=0))),
                        *(pa.array([float(v)]) for v in (mine.norms.min(), mine.norms.max(), floors.min())),
                    ],
                    [part.split()[0] for part in schema.split(", ")],
                )

    return materialize(blocks.mapInArrow(tidy(rows), schema))


def _bounds_of_blocks() -> tuple[Column, Column]:
    """Least and most score of an anchor block ``a`` and a row block ``b``, by their ranges of angles and norms."""
    ranges = F.arrays_zip("a_lo", "a_hi", "lo", "hi")
    least = F.array_max(
        F.transform(ranges, lambda r: F.greatest(r["lo"] - r["a_hi"], r["a_lo"] - r["hi"], F.lit(0.0)))
    )
    most = F.array_min(
        F.transform(ranges, lambda r: F.least(r["a_hi"] + r["hi"], F.lit(2 * np.pi) - r["a_lo"] - r["lo"]))
    )
    top = F.cos(F.greatest(least - ANGLE_SLACK, F.lit(0.0)))
    bottom = F.cos(F.least(F.greatest(most, least) + ANGLE_SLACK, F.lit(np.pi)))
    norm_least, norm_most = F.col("a_least_norm") * F.col("least_norm"), F.col("a_most_norm") * F.col("most_norm")
    slack = F.lit(1.0) + SCORE_SLACK * norm_most
    high = F.when(top >= 0, top * norm_most).otherwise(top * norm_least) + slack
    low = F.when(bottom >= 0, bottom * norm_least).otherwise(bottom * norm_most) - slack
    return low, high


def _meeting(anchors: DataFrame, blocks: DataFrame, same_label: bool, wanted: Column) -> DataFrame:
    """Each anchor block beside every row block of the same or another label whose scores may be ``wanted``.

    Directories of blocks, without their rows, are joined first. For other labels
    each directory row of an anchor block is sent to all parts of the other one.
    """
    heavy = ("ids", "x", "norms", "angles", "floors", "windows", "anchors")
    left = anchors.drop(*heavy)
    left = left.select(*(F.col(c).alias(f"a_{c}") for c in left.columns))
    right = blocks.drop(*heavy)
    if same_label:
        pairs = left.join(right, F.col("a_label") == F.col("label"))
    else:
        parts = 32
        right = right.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
        left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        pairs = left.join(right, "part").filter(F.col("a_label") != F.col("label"))
    pairs = pairs.filter(wanted).select("a_block", "block")
    loaded = anchors.select(
        F.col("block").alias("a_block"),
        *(F.col(c).alias(f"a_{c}") for c in anchors.columns if c in heavy),
    )
    return pairs.join(loaded, "a_block").join(blocks.select("block", "ids", "x", "norms", "angles"), "block")


def _positives(anchors: DataFrame, blocks: DataFrame, count: int, width: int, references: int) -> DataFrame:
    """The best rows of each anchor's label: anchor block, place in it, id and score."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                mine, block = Block(row, "a_", width, references), Block(row, "", width, references)
                floors = np.frombuffer(row["a_floors"], dtype=np.float64)
                asked = mine.overlapping(block, floors, np.inf)
                if not len(asked):
                    continue
                mine = mine.taken(asked)
                block = block.taken(block.overlapping(mine, floors[asked].min(), np.inf))
                if not len(block.ids):
                    continue
                found = scores(mine.x, block.x)
                for k, place in enumerate(asked.tolist()):
                    far = np.flatnonzero((block.ids != mine.ids[k]) & (found[k] >= floors[place]))
                    # A repeated id keeps its best row only.
                    far = far[np.lexsort((-found[k, far], block.ids[far]))]
                    far = far[np.unique(block.ids[far], return_index=True)[1]]
                    top = far[best(found[k, far], block.ids[far], count)]
                    out += [
                        (row["a_block"], place, int(mine.ids[k]), i, s)
                        for i, s in zip(block.ids[top].tolist(), found[k, top].tolist(), strict=True)
                    ]
            names = ["a_block", "place", "anchor_id", "positive_id", "positive_score"]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    _, high = _bounds_of_blocks()
    pairs = _meeting(anchors, blocks, True, high >= F.col("a_floor"))
    schema = "a_block long, place long, anchor_id long, positive_id long, positive_score long"
    found = pairs.mapInArrow(tidy(rows), schema)
    # A repeated id may have rows in several blocks.
    found = found.groupBy("a_block", "place", "anchor_id", "positive_id").agg(
        F.max("positive_score").alias("positive_score")
    )
    order = Window.partitionBy("a_block", "place").orderBy(F.desc("positive_score"), "positive_id")
    return materialize(found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= count).drop("_rank"))


def _negatives(anchors: DataFrame, blocks: DataFrame, count: int, width: int, references: int) -> DataFrame:
    """The best rows of other labels within each positive's window."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                mine, block = Block(row, "a_", width, references), Block(row, "", width, references)
                windows = [w for w in row["a_windows"] if w["least"] <= w["most"]]
                low, high = np.full(len(mine.ids), np.inf), np.full(len(mine.ids), -np.inf)
                for w in windows:
                    low[w["place"]] = min(low[w["place"]], w["least"])
                    high[w["place"]] = max(high[w["place"]], w["most"])
                asked = mine.overlapping(block, low, high)
                asked = asked[low[asked] <= high[asked]]
                if not len(asked):
                    continue
                block = block.taken(block.overlapping(mine.taken(asked), low[asked].min(), high[asked].max()))
                if not len(block.ids):
                    continue
                found = dict(zip(asked.tolist(), scores(mine.x[asked], block.x), strict=True))
                for w in windows:
                    score = found.get(w["place"])
                    if score is None:
                        continue
                    within = np.flatnonzero(
                        (score >= w["least"]) & (score <= w["most"]) & (block.ids != mine.ids[w["place"]])
                    )
                    top = within[best(score[within], block.ids[within], count)]
                    out += [
                        (row["a_block"], w["place"], w["positive_id"], i, s)
                        for i, s in zip(block.ids[top].tolist(), score[top].tolist(), strict=True)
                    ]
            names = ["a_block", "place", "positive_id", "negative_id", "negative_score"]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    low, high = _bounds_of_blocks()
    pairs = _meeting(anchors, blocks, False, (high >= F.col("a_least")) & (low <= F.col("a_most")))
    schema = "a_block long, place long, positive_id long, negative_id long, negative_score long"
    order = Window.partitionBy("a_block", "place", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = pairs.mapInArrow(tidy(rows), schema).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= count)


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    scale: float = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    Components become ``floor(scale * x)``. Anchors are the rows for which ``anchor``
    holds. A positive's negatives are the best rows of other labels whose score is at
    least ``least_percent`` and at most ``most_percent`` hundredths of its own. Ranks
    count from 1; of equal scores the smaller id comes first.
    """
    spark = df.sparkSession
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        doubles(vector_col).alias("vector"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & is_finite(F.col("vector")))
    width = max(longest(rows, "vector"), 1)
    sample = rows.select("vector").orderBy(F.xxhash64("id"), "vector").limit(SAMPLE).toArrow().column("vector")
    if not len(sample):
        return spark.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
        )
    references = reference_directions(np.floor(scale * matrix(sample.combine_chunks(), width)))
    blocks = _stored(rows, references, width, scale)
    anchors = _anchor_blocks(blocks, positives, width, len(references))
    chosen = _positives(anchors, blocks, positives, width, len(references))
    # 100 * s >= p * score and 100 * s <= q * score, for integers s.
    score = F.col("positive_score").cast("decimal(20,0)")
    windows = chosen.withColumns(
        {
            "least": (-F.floor(-score * least_percent / 100)).cast("long"),
            "most": F.floor(score * most_percent / 100).cast("long"),
        }
    )
    # At most as many windows as positives per anchor of a block.
    asked = windows.groupBy(F.col("a_block").alias("block")).agg(
        F.collect_list(F.struct("place", "positive_id", "least", "most")).alias("windows"),
        F.min(F.when(F.col("least") <= F.col("most"), F.col("least"))).alias("least"),
        F.max(F.when(F.col("least") <= F.col("most"), F.col("most"))).alias("most"),
    )
    searching = materialize(anchors.join(asked.filter("least is not null"), "block"))
    found = _negatives(searching, blocks, negatives, width, len(references))
    key = ["a_block", "place", "positive_id"]
    return found.join(chosen, key).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
        "negative_score",
    )
