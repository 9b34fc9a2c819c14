"""The similarity join against all pairs compared one by one."""

import random
import re
from itertools import combinations

import pytest

from landfall.llm import jaccard_join
from landfall.llm.jaccard_join import near_duplicates

SCHEMA = "doc_id long, text string"


def shingles(text, n):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def brute(rows, n, num, den):
    sets = [shingles(text, n) for _, text in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, sa), (b, sb) in combinations(zip([i for i, _ in rows], sets, strict=True), 2):
        if a is not None and b is not None and sa and sb and den * len(sa & sb) >= num * len(sa | sb):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted(
        ((i, len(s), None if i is None else root(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str
    )


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(seed=3, groups=25):
    """Groups of edited copies, chains of edits, short texts, and passages shared by many."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=40)
    rows, number = [], 0
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice((2, 5, 9, 12, 30, 80, 200)))
        if rng.random() < 0.4:
            base[1:1] = passage
        for _ in range(rng.choice((1, 2, 3, 9))):
            rows.append((number, rng.choice((" ", "\n", "\t ")).join(base).title()))
            number += 1
            base = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 3))):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
    return rows


ODD = [(None, "w1 w2 w3 w4"), (9001, None), (9002, ""), (9003, " \n "), (9004, "one"), (9005, "ONE"), (9006, "one two"),
       (9007, "x y z w v u"), (9007, "a b c d e f"), (9008, "x y z w v u"), (9009, "a b c d e f"), (9010, "é É x")]


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 80, 100), (2, 1, 2), (1, 1, 1)])
@pytest.mark.parametrize("keys", ["segments", "prefix"])
def test_equals_brute_force(spark, n, num, den, keys):
    rows = corpus() + ODD
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(near_duplicates(df, n, num, den, keys=keys)) == brute(rows, n, num, den)


def test_split_clusters_and_lists(spark, monkeypatch):
    """Small blocks, so that large clusters are searched over several tasks in two rounds."""
    monkeypatch.setattr(jaccard_join, "HUBS", 1)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        base = list(base)
        base[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(base)))
    df = spark.createDataFrame(rows, SCHEMA)
    for keys in ("segments", "prefix"):
        assert found(near_duplicates(df, 3, 90, 100, block=4, keys=keys)) == brute(rows, 3, 90, 100)
    texts = df.withColumnRenamed("doc_id", "id")
    whole = jaccard_join.prefix_candidates(texts, 3, 80, 100)
    dealt = jaccard_join.prefix_candidates(texts, 3, 80, 100, block=7)
    from landfall.llm.graph import connected_components

    assert set(connected_components(whole).collect()) == set(connected_components(dealt).collect())


def test_blocks_of_long_texts(spark, monkeypatch):
    """Few long texts are split too, by the number of their shingles."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 200)
    monkeypatch.setattr(jaccard_join, "HUBS", 1)
    rows = corpus(7, 12)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(near_duplicates(df, 3, 80, 100)) == brute(rows, 3, 80, 100)


def test_empty_and_extra_columns(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(1, "a b c d e f", "k", 5), (2, "a b c d e f", "k", 6)], SCHEMA + ", key string, n long")
    assert found(near_duplicates(clash)) == [(1, 2, 1), (2, 2, 1)]


def test_many_copies_of_one_text(spark):
    rows = [(i, "the same words in every one of them") for i in range(3000)] + [(5000, "other words here")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    components = {r.component_id for r in near_duplicates(df, 3, 90, 100).collect()}
    assert components == {0, 5000}


def test_lists_compared_one_run_at_a_time():
    """A task holds the rows of one key and part at a time, not all of its partition."""
    import numpy as np
    import pyarrow as pa

    bits = jaccard_join._bitmap(np.arange(1, 41, dtype=np.uint64) << np.uint64(8))
    pulled = []

    def batches():
        for key in range(3):
            pulled.append(key)
            yield pa.RecordBatch.from_pylist(
                [{"id": 10 * key + i, "key": key, "part": 0, "n": 40, "bits": bits, "label": 10 * key + i} for i in (1, 2)]
            )

    out = jaccard_join._compared(80, 100)(batches())
    first = next(out)
    assert pulled == [0, 1]
    assert first.to_pylist() == [{"a": 1, "b": 2}]
    assert [r for b in out for r in b.to_pylist()] == [{"a": 11, "b": 12}, {"a": 21, "b": 22}]
