"""The operators on vectors against all pairs compared one by one."""

import hashlib
import math

import numpy as np
import pytest

from landfall.llm import embedding_dedup, hard_negatives
from landfall.llm.centroids import Pivots, clustered, lower_bounds, squared
from landfall.llm.embedding_dedup import vector_links
from landfall.llm.hard_negatives import angle_bounds, angles_to, reference_directions, score_bounds

NAN, INF = float("nan"), float("inf")

# Extra columns bear names that the operators use themselves.
SCHEMA = "vec_id long, embedding array<float>, label int, id string, x int, key string, vector int, a long, block string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", 1, "k", 2, 3, "b") for r in rows], SCHEMA)


def near(rng, x, cosine):
    """A unit vector at a given cosine to another."""
    x = x / np.linalg.norm(x)
    y = rng.standard_normal(len(x))
    y -= (y @ x) * x
    return cosine * x + math.sqrt(1 - cosine**2) * y / np.linalg.norm(y)


ODD = [None, [], [0.0] * 8, [1.0, None, *[0.5] * 6], [NAN] * 8, [INF, *[1.0] * 7], [0.3, -0.2, 0.4]]


# Near duplicates


def links_of_all_pairs(rows, threshold=0.9):
    def usable(i, v):
        return i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)

    vectors = [(i, np.array(v, dtype=np.float32).astype(float)) if usable(i, v) else (i, None) for i, v, *_ in rows]
    linked = [[] for _ in rows]
    for size in {len(v) for _, v in vectors if v is not None}:
        which = [k for k, (_, v) in enumerate(vectors) if v is not None and len(v) == size]
        x = np.stack([vectors[k][1] for k in which])
        x /= np.linalg.norm(x, axis=1)[:, None]
        for p, q in zip(*np.nonzero(x @ x.T >= threshold), strict=True):
            if p != q:
                linked[which[p]].append(which[q])
    component = {}
    for start in sorted((k for k in range(len(rows)) if rows[k][0] is not None), key=lambda k: rows[k][0]):
        todo = [start]
        while todo:
            k = todo.pop()
            if k not in component:
                component[k] = rows[start][0]
                todo += linked[k]
    return [
        (i, len(linked[k]), component.get(k), component.get(k) == i) for k, (i, *_) in enumerate(rows)
    ]


def found_links(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def test_links_equal_all_pairs(spark):
    """Groups of near copies, exact copies, scaled copies, chains, repeated ids and rows, and odd vectors."""
    rng = np.random.default_rng(5)
    rows = [(1000 + k, v, 0) for k, v in enumerate(ODD)]
    number = 0
    for size, cosine in ((300, 0.995), (90, 0.98), (5, 0.97), (2, 0.96), *[(1, 1.0)] * 150):
        centre = rng.standard_normal(8)
        for _ in range(size):
            rows.append((number, (rng.uniform(0.5, 3) * near(rng, centre, cosine)).tolist(), number % 3))
            number += 1
    twin = rng.standard_normal(8).tolist()
    rows += [(2000 + k, twin, None) for k in range(40)]  # copies
    rows += [(2000, twin, 7), (3000, [-0.0, *[1.0] * 7], 1), (3001, [0.0, *[1.0] * 7], 1), (None, twin, 1)]
    step = rng.standard_normal(8)
    for k in range(6):  # a chain: the ends are not linked directly
        rows.append((4000 + k, step.tolist(), 0))
        step = near(rng, step, 0.95)
    expected = [(i, n, c, True if i is None else kept) for i, n, c, kept in links_of_all_pairs(rows)]
    assert found_links(vector_links(frame(spark, rows))) == sorted(expected, key=str)


def test_recall_at_the_threshold(spark):
    """Pairs right above the threshold are the hardest to find; those below are never linked."""
    rng = np.random.default_rng(6)
    rows = []
    for k in range(1500):
        x = rng.standard_normal(64)
        rows.append((2 * k, x.tolist(), 0))
        rows.append((2 * k + 1, near(rng, x, 0.9 + (k % 50 + 0.5) / 1000 if k % 3 else 0.89).tolist(), 0))
    found = {r.vec_id: r for r in vector_links(frame(spark, rows)).collect()}
    expected = {i: (n, c) for i, n, c, _ in links_of_all_pairs(rows)}
    linked = [i for i, (n, _) in expected.items() if n]
    assert sum(found[i].n_links for i in linked) >= 0.95 * sum(expected[i][0] for i in linked)
    assert not [i for i, (n, _) in expected.items() if not n and found[i].n_links]
    close = [i for i in linked if (i // 2) % 50 >= 40]  # cosines of 0.94 to 0.95
    assert sum(found[i].n_links for i in close) >= 0.98 * len(close)


def test_loose_groups_are_compared_by_blocks(spark, monkeypatch):
    """Balls whose pairs are linked in part, with members in several blocks, if all centres are candidates."""

    def all_pairs(centres, limit):
        ids = sorted(r.centre_id for r in centres.collect())
        return spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "a long, b long")

    monkeypatch.setattr(embedding_dedup, "_candidates", all_pairs)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "LEAST_FULL", 4)
    monkeypatch.setattr(embedding_dedup, "FULL", 0)
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(6)
    rows = [(k, near(rng, centre, rng.uniform(0.9, 1)).tolist(), 0) for k in range(250)]
    assert found_links(vector_links(frame(spark, rows))) == sorted(links_of_all_pairs(rows), key=str)


@pytest.mark.parametrize("spread", [0.2, 0.7])
def test_recall_in_a_crowd(spark, spread):
    """Vectors that all lie around one direction: half of all pairs are linked, or few."""
    rng = np.random.default_rng(12)
    centre = rng.standard_normal(32) * 1 / math.sqrt(32)
    rows = [(k, (centre + spread * rng.standard_normal(32) / math.sqrt(32)).tolist(), 0) for k in range(400)]
    for k in range(0, 400, 4):
        rows[k + 1] = (k + 1, near(rng, np.array(rows[k][1]), 0.92).tolist(), 0)
    found = {r.vec_id: r.n_links for r in vector_links(frame(spark, rows)).collect()}
    expected = {i: n for i, n, _, _ in links_of_all_pairs(rows)}
    assert all(found[i] <= n for i, n in expected.items())
    assert sum(found.values()) >= 0.9 * sum(expected.values()) > 0


def test_empty_tables(spark):
    none = frame(spark, [])
    assert vector_links(none).collect() == [] and clustered(none).collect() == []
    assert hard_negatives.hard_negatives(none, none.vec_id > 0).collect() == []
    odd = frame(spark, [(k, v, 0) for k, v in enumerate(ODD[:-1])])
    assert {(r.n_links, r.kept) for r in vector_links(odd).collect()} == {(0, True)}
    assert clustered(odd, width=8).count() == 1  # the zero vector


# Hard negatives


def mined(rows, every, positives=5, negatives=3, low=50, high=95, scale=256):
    kept = {
        (i, label, tuple(math.floor(scale * float(np.float32(c))) for c in v))
        for i, v, label in rows
        if i is not None and v is not None and label is not None and all(c is not None and math.isfinite(c) for c in v)
    }
    out = set()
    for i, label, v in kept:
        if i % every:
            continue
        score = [(-sum(a * b for a, b in zip(v, w, strict=False)), j, other) for j, other, w in kept if j != i]
        best = {}
        for s, j, other in sorted(score):
            if other == label:
                best.setdefault(j, s)
        chosen = sorted((s, j) for j, s in best.items())[:positives]
        for p, j in chosen:
            within = sorted(
                (s, k) for s, k, other in score if other != label and low * -p <= 100 * -s <= high * -p
            )[:negatives]
            out |= {(i, j, rank, k, -p, -s) for rank, (s, k) in enumerate(within, 1)}
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 7])
def test_negatives_equal_all_pairs(spark, monkeypatch, block):
    """Ties, repeated rows, a hot label, odd vectors, and vectors of different length."""
    monkeypatch.setattr(hard_negatives, "ROWS", block)
    rng = np.random.default_rng(8)
    rows = [(1000 + 10 * k, v, k % 2) for k, v in enumerate(ODD)]
    centres = rng.standard_normal((3, 8))
    for k in range(260):
        v = near(rng, centres[k % 3], rng.uniform(0.5, 1)) * rng.uniform(0.2, 2)
        rows.append((k, v.tolist(), [None, 1, 2, 3, 1, 1][int(rng.integers(6))]))
    rows += rows[20:40]  # repeated rows
    rows += [(300 + k, rows[50][1], k % 3) for k in range(30)]  # ties
    rows += [(None, rows[60][1], 1), (340, [0.0] * 8, 1), (350, [], 2)]
    df = frame(spark, rows)
    found = hard_negatives.hard_negatives(df, df.vec_id % 10 == 0)
    assert found.schema["rank"].dataType.simpleString() == "int"
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == mined(rows, 10)


def test_score_bounds_hold():
    """Scores lie within their bounds, also for equal, opposite, tiny and zero vectors; most unrelated pairs are ruled out."""
    rng = np.random.default_rng(9)
    x = np.floor(256 * rng.standard_normal((300, 16)))
    x[100:200] = np.floor(x[:100] + rng.integers(-3, 4, (100, 16)))
    x[200], x[201], x[202], x[203] = -x[0], x[0], 0, 10 * x[0]
    norms = np.linalg.norm(x, axis=1)
    angles = angles_to(x, norms, reference_directions(x[:120]))
    for k in range(len(x)):
        least, most = angle_bounds(angles, angles[k], angles[k])
        low, high = score_bounds(least, most, norms * norms[k], norms * norms[k])
        score = x @ x[k]
        assert (low <= score).all() and (score <= high).all()
    least, most = angle_bounds(angles, angles[:100].min(axis=0), angles[:100].max(axis=0))
    low, high = score_bounds(least, most, norms * norms[:100].min(), norms * norms[:100].max())
    score = x @ x[:100].T
    assert (low[:, None] <= score).all() and (score <= high[:, None]).all()


def test_large_components_are_refused(spark):
    rows = frame(spark, [(0, [1e20] * 8, 1), (1, [1e20] * 8, 1)])
    with pytest.raises(Exception, match="beyond 64 bits"):
        clustered(rows, width=8).collect()


# Centroids


def by_hand(rows, k, rounds, width, scale, seed="1"):
    kept = [
        (i, np.array([math.floor(scale * float(np.float32(c))) for c in v], dtype=object), v)
        for i, v, _ in rows
        if i is not None and v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)
    ]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[2]))[:k]
    centres = [c for _, c, _ in first]

    def nearest(v):
        return min((sum((v - c) ** 2), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [sum(groups[n]) // len(groups[n]) if n in groups else c for n, c in enumerate(centres)]
    found = [(i, *nearest(v)) for i, v, _ in kept]
    share = {n: sum(d for _, d, m in found if m == n) for n in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i, n, d, share[n], sum(share.values()), digest[n]) for i, d, n in found)


def found_clusters(df):
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_clusters_equal_plain_rounds(spark):
    """Groups of near copies, equal first centroids, ties, repeated rows, and odd vectors."""
    rng = np.random.default_rng(10)
    rows = [(1000 + k, v, 0) for k, v in enumerate(ODD)]
    centres = rng.standard_normal((5, 8))
    rows += [(k, near(rng, centres[k % 5], rng.uniform(0.8, 1)).tolist(), 0) for k in range(200)]
    rows += [(k % 37 + 500, [0.5] * 8, 0) for k in range(60)] + [(None, [0.5] * 8, 0)]
    assert found_clusters(clustered(frame(spark, rows), 16, 3, 8, 64)) == by_hand(rows, 16, 3, 8, 64)


def test_fewer_vectors_than_centroids(spark):
    rows = [(k, [float(k), 0.0, 1.0], 0) for k in range(3)]
    assert found_clusters(clustered(frame(spark, rows), 16, 3, 3, 64)) == by_hand(rows, 16, 3, 3, 64)


def test_bounds_of_pivots_hold_and_prune():
    rng = np.random.default_rng(11)
    centres = rng.integers(-60, 60, (8, 16))
    x = np.concatenate([c + rng.integers(-6, 7, (200, 16)) for c in centres])
    pivots = Pivots.of(centres)
    to_pivots = np.sqrt(pivots.distances(x).astype(float))
    moved = centres + rng.integers(-2, 3, centres.shape)
    away = np.sqrt(pivots.distances(moved).astype(float))
    pruned = 0
    own = squared(x, moved[np.arange(len(x)) // 200])
    for number, centre in enumerate(moved):
        bound = lower_bounds(to_pivots, away[number], pivots, number)
        assert (bound <= squared(x, centre)).all()
        pruned += (bound > own).sum()
    assert pruned > 0.5 * 7 * len(x)
