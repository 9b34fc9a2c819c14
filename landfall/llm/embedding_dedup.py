"""Near duplicates among vectors: iterative quantisation, multi-index Hamming tables, exact rerank.

* **Codes.** Principal directions of a bounded sample are rotated so that signs lose
  least (iterative quantisation, from ``ROTATIONS`` starts, or more for short
  vectors). Each bit is cut in the widest gap around its median in the sample, which
  balances it. The sample holds one vector of each group of near copies, or else
  large groups would draw the cuts into their midst. Every vector gets a code of
  ``BITS`` bits.
* **Balls.** Groups of near copies would put all their pairs into a few buckets.
  Where a bucket is far fuller than an even spread makes it, its mean direction
  becomes the centre of a ball, and vectors of the bucket within half the linking
  angle of it belong to the ball: all pairs in there are linked, as two such angles
  make no more than the linking angle. So a group of copies of any size costs one
  row a member. All other vectors are centres of their own.
* **Tables.** Codes are cut into substrings of ``PART`` bits. Two centres are
  candidates if some substring differs in one bit at most and the whole codes in at
  most ``LIMIT`` bits (more if planted pairs do). A pair that differs in one bit is met from the side where that
  bit is set, so a table holds one row per centre and is asked about half of them
  besides.
* **Rerank.** Candidates are compared by the cosine of the vectors themselves. For
  balls the angle between centres and the radii often prove that all or none of the
  pairs are linked; else members are compared block by block, and counts travel
  rather than pairs.

Linked are pairs with a cosine of at least ``threshold`` in double precision and no
others. Candidate search is approximate: a pair at the threshold of 0.9 is found with
a probability of about 0.94, at 0.95 with 0.99, beyond with more; tests measure the
recall against all pairs. Components join what links connect.

Equal vectors are looked at once and linked with each other. Rows that repeat an id
are vectors of their own. A NULL, empty or zero vector and one with a component that is
NULL or not finite has no links; nor has a row without an id, whose component is NULL.
Vectors of different length are never linked. An empty table gives no rows, and
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.graph import connected_components
from landfall.llm.vectors import binary_rows, doubles, from_binary, is_finite, lists, longest, matrix, pieces
from landfall.llm.words import tidy
from landfall.session import materialize

# Bits in a code, in a substring, and by how many codes of candidates may differ at least.
# Vectors at a cosine of 0.9 differ in 18 bits on average (deviation 4), unrelated ones in 64 (6).
BITS = 128
PART = 16
LIMIT = 40

# The share of pairs at the threshold that the tables should find in the sample.
RECALL = 0.93
ROTATIONS = 2
TURNS = 30

# Vectors the rotation is learned from: those of the smallest hashes.
SAMPLE = 8192
SEED = 7

# A bucket is full from so many times its even share, and so many vectors.
FULL = 8
LEAST_FULL = 32

# Members of a ball that are compared at once.
BLOCK = 256

# Angles are computed within about 2e-8.
SLACK = 1e-6

# Rows handled at once, which bounds a task's memory.
ROWS = 4096


@dataclass
class Codes:
    """Directions and cuts that turn a vector into bits."""

    mean: np.ndarray
    directions: np.ndarray
    cuts: np.ndarray
    limit: int  # how many bits of candidates may differ

    def bits(self, units: np.ndarray) -> np.ndarray:
        return (units - self.mean) @ self.directions > self.cuts

    def words(self, units: np.ndarray) -> np.ndarray:
        """Codes as 64-bit integers, one column each."""
        packed = np.packbits(self.bits(units), axis=1, bitorder="little")
        return np.ascontiguousarray(packed).view("<i8")


def thinned(units: np.ndarray, threshold: float, step: int = 256) -> np.ndarray:
    """Rows without those that lie near an earlier row that is kept."""
    kept = units[:0]
    for start in range(0, len(units), step):
        new = units[start : start + step]
        new = new[(new @ kept.T < threshold).all(axis=1)]
        close = new @ new.T >= threshold
        chosen: list[int] = []
        for row in range(len(new)):
            if not close[row, chosen].any():
                chosen.append(row)
        kept = np.concatenate((kept, new[chosen]))
    return kept


def balanced_cuts(values: np.ndarray) -> np.ndarray:
    """For each column the middle of the widest gap between its values around the median."""
    ordered = np.sort(values, axis=0)
    last = len(ordered) - 1
    middle = ordered[math.floor(0.4 * last) : math.ceil(0.6 * last) + 1]
    if len(middle) < 2:
        return middle[0] - 0.5
    gap = np.diff(middle, axis=0).argmax(axis=0)
    columns = np.arange(values.shape[1])
    return (middle[gap, columns] + middle[gap + 1, columns]) / 2


def planted(units: np.ndarray, cosine: float, seed: int = SEED) -> np.ndarray:
    """For each row a unit vector at a given cosine to it, in a random direction."""
    noise = np.random.default_rng(seed).standard_normal(units.shape)
    noise -= (noise * units).sum(axis=1)[:, None] * units
    size = np.linalg.norm(noise, axis=1)[:, None]
    return cosine * units + math.sqrt(1 - cosine * cosine) * noise / np.where(size > 0, size, 1.0)


def _quantised(units: np.ndarray, mean: np.ndarray, balanced: bool, seed: int) -> Codes:
    """Iterative quantisation: rotations that bring principal directions close to their signs."""
    rng = np.random.default_rng(seed)
    width = min(units.shape[1], BITS // ROTATIONS)
    _, axes = np.linalg.eigh((units - mean).T @ (units - mean))
    axes = axes[:, ::-1][:, :width]
    projected = (units - mean) @ axes
    found = []
    for _ in range(-(-BITS // width)):
        rotation, _ = np.linalg.qr(rng.standard_normal((width, width)))
        for _ in range(TURNS):
            signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ signs)
            rotation = left @ right
        found.append(axes @ rotation)
    directions = np.concatenate(found, axis=1)[:, :BITS]
    cuts = balanced_cuts((units - mean) @ directions) if balanced else np.zeros(BITS)
    return Codes(mean, directions, cuts, LIMIT)


def table_recall(differing: np.ndarray) -> float:
    """The share of pairs, given the bits in which they differ, that some table finds."""
    return float((differing.reshape(len(differing), -1, PART).sum(axis=2) <= 1).any(axis=1).mean())


def learned_codes(units: np.ndarray, threshold: float, seed: int = SEED) -> Codes:
    """Codes that are balanced as far as pairs planted at the threshold are still found.

    Where vectors crowd around their mean, cuts through it tear such pairs apart; then
    cuts through half the mean, or through the origin, take their place.
    """
    near = planted(units, threshold, seed)
    best = None
    for share in (1.0, 0.5, 0.0):
        codes = _quantised(units, share * units.mean(axis=0), share > 0, seed)
        differing = codes.bits(units) != codes.bits(near)
        recall = table_recall(differing)
        if best is None or recall > best[0]:
            total = differing.sum(axis=1)
            codes.limit = max(LIMIT, math.ceil(total.mean() + 5 * total.std()))
            best = recall, codes
        if best[0] >= RECALL:
            break
    return best[1]


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def _distinct(rows: DataFrame) -> DataFrame:
    """Different vectors by digest, with their smallest id and the number of their rows."""
    return rows.groupBy("digest").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector")
    )


def _digested(rows: DataFrame) -> DataFrame:
    """Rows with a digest of their vector; zeros of either sign are equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ROWS):
            digests = [
                hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest()
                for v in piece.column("vector").to_numpy(zero_copy_only=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(digests, pa.binary()), piece.column("vector")], ["id", "digest", "vector"]
            )

    return rows.mapInArrow(tidy(run), "id long, digest binary, vector array<double>")


def _coded(df: DataFrame, codes: Codes, width: int) -> DataFrame:
    """Vectors with their codes: ``words``, an array of 64-bit integers."""
    kept = [c for c in df.columns if c != "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ROWS):
            words = codes.words(_units(matrix(piece.column("vector"), width)))
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in kept), piece.column("vector"), lists(words)], [*kept, "vector", "words"]
            )

    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in kept)
    return df.select(*kept, "vector").mapInArrow(tidy(run), f"{schema}, vector array<double>, words array<long>")


def _substrings(words: Column, length: Column) -> Column:
    """Keys of all tables: the table, the vector's length and the substring, as one integer each."""
    per_word = 64 // PART
    keys = []
    for table in range(BITS // PART):
        part = F.shiftrightunsigned(words[table // per_word], PART * (table % per_word)).bitwiseAND(F.lit((1 << PART) - 1))
        keys.append((length.cast("long") * F.lit(BITS // PART) + F.lit(table)) * F.lit(1 << PART) + part)
    return F.array(*keys)


def _means(members: DataFrame, width: int) -> DataFrame:
    """The mean direction of every key's vectors; tasks sum theirs before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ROWS):
            keys, of = np.unique(piece.column("key").to_numpy(), return_inverse=True)
            total = np.zeros((len(keys), width))
            np.add.at(total, of, _units(matrix(piece.column("vector"), width)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), lists(total)], ["key", "total"])

    parts = members.mapInArrow(tidy(run), "key long, total array<double>")
    # Sums of doubles depend on their order; rounding them makes a ball's centre, which is free to choose, steady.
    summed = parts.select("key", F.posexplode("total").alias("place", "x")).groupBy("key", "place").agg(
        F.round(F.sum("x"), 6).alias("x")
    )
    ordered = F.array_sort(F.collect_list(F.struct("place", "x")))
    centres = summed.groupBy("key").agg(F.transform(ordered, lambda s: s["x"]).alias("centre"))
    return centres.filter(F.exists("centre", lambda x: x != 0))


def _balls(coded: DataFrame, count: int, width: int, radius: float) -> tuple[DataFrame, DataFrame]:
    """Members of balls (the vector's id, its ball's key, and the angle to its centre), and the centres."""
    keyed = coded.select("id", "vector", F.explode("keys").alias("key"))
    full = max(LEAST_FULL, FULL * count / 2**PART)
    # At most 2**PART / FULL keys a table, whatever the number of vectors.
    counts = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= full))
    members = keyed.join(counts, "key")
    centres = materialize(_means(members, width).join(counts, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ROWS):
            x, c = (_units(matrix(piece.column(name), width)) for name in ("vector", "centre"))
            angle = np.arccos(np.clip((x * c).sum(axis=1), -1, 1))
            near = pa.array(angle <= radius)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("key"), piece.column("size"), pa.array(angle)],
                ["id", "key", "size", "angle"],
            ).filter(near)

    near = keyed.join(centres, "key").mapInArrow(tidy(run), "id long, key long, size long, angle double")
    # Of several balls, the one of the fullest bucket.
    chosen = near.groupBy("id").agg(F.max(F.struct("size", "key", "angle")).alias("ball"))
    return materialize(chosen.select("id", "ball.key", "ball.angle")), centres


def _candidates(centres: DataFrame, limit: int) -> DataFrame:
    """Pairs of centres whose codes agree in a substring up to one bit, and as a whole nearly."""
    own = centres.select("centre_id", "words", F.explode("keys").alias("key"))
    bits = F.array(*(F.lit(1 << b).cast("long") for b in range(PART)))
    flips = F.filter(bits, lambda bit: F.col("key").bitwiseAND(bit) != 0)
    asked = own.select(
        "key", F.col("centre_id").alias("b"), F.col("words").alias("b_words"), F.lit(False).alias("flipped")
    ).union(
        own.select(
            F.explode(F.transform(flips, lambda bit: F.col("key") - bit)).alias("key"),
            F.col("centre_id").alias("b"),
            F.col("words").alias("b_words"),
            F.lit(True).alias("flipped"),
        )
    )
    differing = sum(
        F.bit_count(F.col("words")[i].bitwiseXOR(F.col("b_words")[i])) for i in range(BITS // 64)
    )
    pairs = own.withColumnRenamed("centre_id", "a").join(asked, "key")
    pairs = pairs.filter((F.col("flipped") | (F.col("a") < F.col("b"))) & (differing <= limit))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _judged(pairs: DataFrame, centres: DataFrame, width: int, threshold: float) -> DataFrame:
    """Candidates that may be linked, and whether all their members are."""
    widest = math.acos(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ROWS):
            x, y = (matrix(piece.column(name), width) for name in ("a_vector", "b_vector"))
            cosine = (x * y).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
            reach = piece.column("a_radius").to_numpy() + piece.column("b_radius").to_numpy()
            angle = np.arccos(np.clip(cosine, -1, 1))
            points = reach == 0
            every = np.where(points, cosine >= threshold, angle + reach <= widest - SLACK)
            some = np.where(points, every, angle - reach <= widest + SLACK)
            yield pa.RecordBatch.from_arrays(
                [piece.column("a"), piece.column("b"), pa.array(every)], ["a", "b", "every"]
            ).filter(pa.array(some))

    def side(name: str) -> DataFrame:
        return centres.select(
            F.col("centre_id").alias(name), F.col("vector").alias(f"{name}_vector"), F.col("radius").alias(f"{name}_radius")
        )

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.mapInArrow(tidy(run), "a long, b long, every boolean")


def _compared(pairs: DataFrame, members: DataFrame, width: int, threshold: float) -> DataFrame:
    """For pairs of balls with some links, each member's number of links with the other ball.

    Members come in blocks; blocks of one ball meet blocks of the other.
    """
    size = members.groupBy("centre_id").agg(F.count(F.lit(1)).alias("size"))
    dealt = members.join(size, "centre_id").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / F.lit(BLOCK)).cast("long"))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ROWS):
            x = matrix(piece.column("vector"), width)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in ("centre_id", "part", "id", "copies")), binary_rows(x)],
                ["centre_id", "part", "id", "copies", "x"],
            )

    packed = dealt.select("centre_id", "part", "id", "copies", "vector").mapInArrow(
        tidy(pack), "centre_id long, part long, id long, copies long, x binary"
    )
    blocks = packed.groupBy("centre_id", "part").agg(F.collect_list(F.struct("id", "copies", "x")).alias("rows"))
    blocks = materialize(blocks.drop("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, links, pairs_of = [], [], []
            for row in batch.to_pylist():
                left, right = (
                    _units(np.frombuffer(b"".join(r["x"] for r in row[side]), dtype=np.float64).reshape(-1, width))
                    for side in ("a_rows", "b_rows")
                )
                linked = left @ right.T >= threshold
                for side, other, found in (("a_rows", "b_rows", linked), ("b_rows", "a_rows", linked.T)):
                    copies = np.array([r["copies"] for r in row[other]], dtype=np.int64)
                    ids += [r["id"] for r in row[side]]
                    links += (found @ copies).tolist()
                    pairs_of += [(row["a"], row["b"])] * len(row[side])
            a, b = zip(*pairs_of, strict=True) if pairs_of else ((), ())
            yield pa.RecordBatch.from_pydict(
                {n: pa.array(v, pa.int64()) for n, v in (("a", a), ("b", b), ("id", ids), ("links", links))}
            ).filter(pa.array(np.array(links, dtype=np.int64) > 0))

    joined = pairs.join(blocks.select(F.col("centre_id").alias("a"), F.col("rows").alias("a_rows")), "a").join(
        blocks.select(F.col("centre_id").alias("b"), F.col("rows").alias("b_rows")), "b"
    )
    return joined.mapInArrow(tidy(run), "a long, b long, id long, links long")


def vector_links(
    df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Per row its id, ``n_links`` (other rows linked), ``component_id`` (smallest id reachable) and ``kept``.

    ``threshold`` is above 0 and at most 1; the codes are laid out for 0.9 or more.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), doubles(vector_col).alias("vector"))
    usable = F.col("id").isNotNull() & is_finite(F.col("vector"))
    usable = usable & F.exists("vector", lambda x: x != 0)
    valid = rows.filter(usable)
    rest = rows.filter(~F.coalesce(usable, F.lit(False)))
    width = max(longest(valid, "vector"), 1)
    digested = materialize(_digested(valid))
    distinct = _distinct(digested).withColumn("length", F.size("vector"))
    sample = distinct.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow().column("vector")
    if len(sample):
        units = thinned(_units(matrix(sample.combine_chunks(), width)), threshold)
    else:
        units = np.eye(1, width)
    codes = learned_codes(units, threshold)
    keys = _substrings(F.col("words"), F.col("length"))
    coded = materialize(_coded(distinct, codes, width).withColumn("keys", keys))
    radius = math.acos(threshold) / 2 - SLACK
    inside, means = _balls(coded, coded.count(), width, radius)

    balls = inside.groupBy("key").agg(
        F.min("id").alias("centre_id"), F.max("angle").alias("radius"), F.count(F.lit(1)).alias("size")
    )
    # A ball of one vector is that vector.
    balls = balls.filter("size > 1")
    in_ball = inside.join(balls.select("key", "centre_id"), "key").select("id", "centre_id")
    # Each vector beside its centre.
    placed = materialize(
        coded.join(in_ball, "id", "left").withColumn("alone", F.col("centre_id").isNull())
        .withColumn("centre_id", F.coalesce("centre_id", "id"))
    )
    weights = placed.groupBy("centre_id").agg(F.sum("copies").alias("weight"))
    points = placed.filter("alone").select("centre_id", F.lit(0.0).alias("radius"), "vector", "length", "words", "keys")
    shells = balls.join(means, "key").select(
        "centre_id",
        F.greatest(F.col("radius"), F.lit(SLACK)).alias("radius"),
        F.col("centre").alias("vector"),
        F.expr(f"cast(key div {(BITS // PART) << PART} as int)").alias("length"),
    )
    shells = _coded(shells, codes, width).withColumn("keys", keys)
    centres = materialize(points.unionByName(shells.select(*points.columns)))

    judged = materialize(_judged(_candidates(centres, codes.limit), centres, width, threshold))
    every = judged.filter("every").select("a", "b")
    mixed = judged.filter("not every").select("a", "b")
    open_ids = mixed.select(F.explode(F.array("a", "b")).alias("centre_id")).distinct()
    counted = materialize(_compared(mixed, placed.join(open_ids, "centre_id", "left_semi"), width, threshold))

    edges = every.union(counted.select("a", "b").distinct())
    reached = connected_components(edges)
    both = every.union(every.select(F.col("b").alias("a"), F.col("a").alias("b")))
    whole = both.join(weights.withColumnRenamed("centre_id", "b"), "b").groupBy(F.col("a").alias("centre_id")).agg(
        F.sum("weight").alias("whole_links")
    )
    parts = counted.groupBy("id").agg(F.sum("links").alias("part_links"))
    found = (
        placed.select("digest", "id", "centre_id")
        .join(weights, "centre_id")
        .join(whole, "centre_id", "left")
        .join(reached.select(F.col("node").alias("centre_id"), "component"), "centre_id", "left")
        .join(parts, "id", "left")
        .select(
            "digest",
            (
                F.col("weight") - 1 + F.coalesce("whole_links", F.lit(0)) + F.coalesce("part_links", F.lit(0))
            ).alias("n_links"),
            F.coalesce("component", "centre_id").alias("component_id"),
        )
    )
    linked = digested.select("id", "digest").join(found, "digest").select("id", "n_links", "component_id")
    alone = rest.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(
        F.col("id").alias(id_col),
        "n_links",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
