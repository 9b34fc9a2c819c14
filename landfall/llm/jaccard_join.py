"""Exact join of documents on the Jaccard similarity of their word shingles.

Documents are linked when ``den * |A and B| >= num * |A or B|`` for their sets
of different n-word shingles. The work goes in four steps.

1. Equal sets are found by a 128-bit digest of the set; one document stands for
   all of them from here on.
2. Candidate keys bring together every pair that can be linked. Linked sets of
   sizes a and b differ in at most ``(a + b)(den - num)/(den + num)`` shingles,
   hence if shingles are dealt by hash into one more segment than that, at least
   one segment is the same in both. Its digest is the key. Where segments would
   be too small to tell documents apart (thresholds below about 0.88), the keys
   are the rarest shingles of each document instead, as many as a linked
   document cannot miss, and documents that share one are compared by a parity
   bitmap of their sets that never underrates their overlap. Near copies mostly have
   the least hashes of their sets in common; those are put together first, so that a
   large group of them is connected by few edges.
3. Documents that share keys, directly or over others, form a cluster. Clusters
   larger than a block are dealt over several tasks.
4. Within a task, T-occurrence search with DivideSkip decides: for each document
   the short inverted lists of its shingles are merged with a heap, the long
   ones are probed by binary search for those documents only that the short ones
   have brought near the required overlap. A pair already connected is skipped.

Links found are a spanning set of the true links: their connected components are
those of all links, though not every pair of a large group is listed.

Shingles are told apart by 64-bit hashes, so links are exact up to collisions of those.
Texts of any length are worked on whole, at a few dozen bytes of memory per byte of text.

NULL and empty texts have no shingles and are linked with nothing. Rows with a
NULL id keep their own row and have no component. Rows that repeat an id count
as one document for links; each keeps its own number of shingles.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.graph import connected_components
from landfall.llm.words import mixed, shingle_sets, slices, tidy
from landfall.session import materialize, settings

# Documents in one search task, the shingles of all of them, and how many documents
# of a split cluster go to all its tasks.
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
HUBS = 16

# A segment must hold so many shingles on average to serve as a key.
SEGMENT_SHINGLES = 6

# Counters of the frequency sketch.
SKETCH_BITS = 19

# Members of a shared key that are compared in one task.
LIST_BLOCK = 2048

# The least hashes of a set that make a signature, and the signatures of a document.
SIGNATURE = 3
SALTS = (0x6A09_E667, 0xBB67_AE85)

# Spark filters texts by a Bloom filter of the documents that a join asks for, whatever their sizes.
MEMBER_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1t",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}

# Relative cost of probing a list and of merging an entry; only speed depends on it.
PROBE_COST = 0.0085


def _edges(num: int, den: int) -> Iterator[int]:
    """Lower ends of size bands: linked sets lie in the same band or in neighbours."""
    low = 1
    while True:
        yield low
        low = low * den // num + 1


def _bands(num: int, den: int, largest: int) -> np.ndarray:
    found = []
    for low in _edges(num, den):
        found.append(low)
        if len(found) > 3 and found[-3] > largest:
            return np.array(found, dtype=np.int64)


def _segments(bands: np.ndarray, band: np.ndarray, num: int, den: int) -> np.ndarray:
    """One more than the most shingles in which a pair of this band and the next can differ."""
    return (bands[band + 1] + bands[band + 2] - 2) * (den - num) // (den + num) + 1


def segment_keys(sets: np.ndarray, at: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all segments of each set, for its own size band and the one below; and their owners."""
    sizes = np.diff(at)
    bands = _bands(num, den, int(sizes.max(initial=1)))
    own = np.searchsorted(bands, sizes, side="right") - 1
    keys, owners = [], []
    for lower in (0, 1):
        band = own - lower
        there = (sizes > 0) & (band >= 0)
        count = np.where(there, _segments(bands, np.maximum(band, 0), num, den), 0)
        first = np.concatenate(([0], np.cumsum(count)))
        digest = np.zeros(first[-1], dtype=np.uint64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        kept = there[owner]
        values, owner = sets[kept], owner[kept]
        segment = ((values >> np.uint64(16)) % count[owner].astype(np.uint64)).astype(np.int64)
        np.add.at(digest, first[owner] + segment, mixed(values ^ np.uint64(0x5BF0_3635_DCE9_A3D1)))
        owner = np.repeat(np.arange(len(sizes)), count)
        place = np.arange(first[-1]) - first[owner]
        keys.append(mixed(digest + mixed((band[owner] * (1 << 32) + place).astype(np.uint64))))
        owners.append(owner)
    return np.concatenate(keys), np.concatenate(owners)


def _documents(batches: Iterator[pa.RecordBatch], n: int):
    """(ids, sets, where each set begins) of pieces of the input."""
    for batch in batches:
        for piece in slices(batch, "text"):
            sets, at = shingle_sets(piece.column("text"), n)
            yield piece.column("id").to_numpy(zero_copy_only=False), sets, at


def _sums(sets: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
    total = np.concatenate(([np.uint64(0)], np.cumsum(mixed(sets ^ np.uint64(salt)))))
    return (total[at[1:]] - total[at[:-1]]).view(np.int64)


def set_sizes(docs: DataFrame, n: int) -> DataFrame:
    """Per row its id, the size of its shingle set, and a 128-bit digest of the set."""

    def measured(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                sets, at = shingle_sets(piece.column("text"), n)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), np.diff(at), _sums(sets, at, 0x1F83_D9AB_FB41_BD6B), _sums(sets, at, 0x9B05)],
                    ["id", "n_shingles", "digest_1", "digest_2"],
                )

    return docs.mapInArrow(tidy(measured), "id long, n_shingles long, digest_1 long, digest_2 long")


def _combined(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """One row per key with its first document, and the others hung on it as edges.

    A key that a third of all documents share thus leaves a map task once.
    """
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    heads = ids[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(keys) else ids
    pairs = np.unique(np.stack([heads, ids], axis=1)[~first & (heads != ids)], axis=0)
    a = np.concatenate((ids[first], pairs[:, 0]))
    b = np.concatenate((ids[first], pairs[:, 1]))
    key = np.concatenate((keys[first], mixed(pairs[:, 1].astype(np.uint64)))).view(np.int64)
    return pa.RecordBatch.from_arrays([key, a, b], ["key", "a", "b"])


def _segment_rows(n: int, num: int, den: int, limit: int = 1 << 21):
    def rows(batches):
        held, size = [], 0
        for ids, sets, at in _documents(batches, n):
            keys, owner = segment_keys(sets, at, num, den)
            held.append((keys, ids[owner].astype(np.int64)))
            size += len(keys)
            if size > limit:
                yield _combined(*map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
        if held:
            yield _combined(*map(np.concatenate, zip(*held, strict=True)))

    return rows


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between neighbours that share a key, and edges found before. All rows of a key are in one partition."""
    held = [[c.to_numpy() for c in batch.columns] for batch in batches]
    if held:
        key, a, b = map(np.concatenate, zip(*held, strict=True))
        done = a != b
        order = np.lexsort((a[~done], key[~done]))
        k, own = key[~done][order], a[~done][order]
        near = (k[1:] == k[:-1]) & (own[1:] != own[:-1])
        pairs = np.stack([np.concatenate((own[:-1][near], a[done])), np.concatenate((own[1:][near], b[done]))], axis=1)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pairs[:, 0].copy(), pairs[:, 1].copy()], ["a", "b"])


def segment_candidates(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Edges that connect all documents with a segment in common."""
    rows = docs.mapInArrow(tidy(_segment_rows(n, num, den)), "key long, a long, b long")
    return rows.repartition("key").mapInArrow(tidy(_chained), "a long, b long")


def frequency_sketch(docs: DataFrame, n: int) -> np.ndarray:
    """How often shingles occur over all documents, by the leading bits of their hash; a few MB at any size.

    Map tasks count, tasks per stretch of counters add up.
    """
    width = 1 << SKETCH_BITS
    parts = 64

    def counted(batches):
        total = np.zeros(width, dtype=np.int64)
        for _, sets, _ in _documents(batches, n):
            total += np.bincount((sets >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=width)
        yield pa.RecordBatch.from_arrays(
            [np.arange(parts), [x.astype(np.int32).tobytes() for x in np.split(total, parts)]], ["part", "counts"]
        )

    def added(key, table):
        total = sum(np.frombuffer(x, dtype=np.int32).astype(np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"part": [key[0].as_py()], "counts": [total.tobytes()]})

    rows = docs.mapInArrow(tidy(counted), "part long, counts binary").groupBy("part").applyInArrow(
        added, "part long, counts binary"
    )
    total = np.zeros((parts, width // parts), dtype=np.int64)
    for row in rows.collect():  # always 64 rows
        total[row.part] = np.frombuffer(row.counts, dtype=np.int64)
    return total.reshape(-1)


def _prefix(sets: np.ndarray, at: np.ndarray, sketch: np.ndarray, num: int, den: int):
    """The rarest shingles of each set: all sets linked with it share at least one."""
    sizes = np.diff(at)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((sets, sketch[(sets >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], owner))
    place = np.arange(len(sets)) - at[:-1][owner]
    kept = order[place < (sizes - (-(-num * sizes // den)) + 1)[owner]]
    return sets[kept], owner[kept]


def _bitmap(values: np.ndarray) -> bytes:
    """For each place whether an odd number of shingles fall on it.

    There is a power of two of places, once to twice the number of shingles, so
    the halves of a bitmap laid over each other are that of half the size.
    """
    bits = 1 << max(7, (len(values) - 1).bit_length())
    return np.packbits(np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits) & 1 == 1).tobytes()


def _prefix_rows(n: int, num: int, den: int, sketch):
    def rows(batches):
        for ids, sets, at in _documents(batches, n):
            values, owner = _prefix(sets, at, sketch.value, num, den)
            yield pa.RecordBatch.from_arrays([values.view(np.int64), ids[owner].astype(np.int64)], ["key", "id"])

    return rows


def _signature(values: np.ndarray, salt: int) -> int:
    """A digest of the smallest hashes of a set, which near copies mostly share."""
    hashes = mixed(values ^ np.uint64(salt))
    least = np.sort(np.partition(hashes, SIGNATURE - 1)[:SIGNATURE] if len(hashes) > SIGNATURE else hashes)
    places = np.arange(len(least), dtype=np.uint64) + np.uint64(salt)
    return int(mixed(least + mixed(places)).sum(dtype=np.uint64).view(np.int64))


def _bitmap_rows(n: int):
    """Per document the size and the bitmap of its set, and its signatures."""

    def rows(batches):
        for ids, sets, at in _documents(batches, n):
            own = [
                (i, hi - lo, _bitmap(sets[lo:hi] >> np.uint64(8)), [_signature(sets[lo:hi], salt) for salt in SALTS])
                for i, lo, hi in zip(ids, at[:-1], at[1:], strict=True)
                if hi > lo
            ]
            ids_, sizes, maps, signed = zip(*own, strict=True) if own else ((), (), (), ())
            columns = [pa.array(ids_, pa.int64()), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(signed, pa.list_(pa.int64()))], ["id", "n", "bits", "signed"]
            )

    return rows


def _alike(maps: DataFrame) -> DataFrame:
    """Edges from each document to the smallest one that shares a signature."""
    signed = maps.select("id", F.explode("signed").alias("signature"))
    heads = signed.groupBy("signature").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("size"))
    met = signed.join(heads.filter("size > 1"), "signature").filter("id != head")
    return met.select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()


def _compatible(
    sizes: np.ndarray, maps: list[bytes], labels: np.ndarray, num: int, den: int
) -> list[tuple[int, int]]:
    """Edges between labels that connect all documents whose sizes and bitmaps allow a link.

    Documents of one label are connected already. Grows one tree after the other: a
    document taken from the tree is compared with all that are in none yet, so a group
    of copies costs one comparison each, and edges only where labels meet. Linked sets
    differ in size by less than a factor of two, so by one step of their bitmaps' sizes
    at most, and the larger one is folded.
    """
    mates: dict[int, list[int]] = {}
    for i, label in enumerate(labels.tolist()):
        mates.setdefault(label, []).append(i)
    width = np.array([len(m) for m in maps])
    classes, place = {}, np.empty(len(maps), dtype=np.int64)
    for w in np.unique(width).tolist():
        members = np.flatnonzero(width == w)
        place[members] = np.arange(len(members))
        own = np.frombuffer(b"".join(maps[i] for i in members), dtype=np.uint64).reshape(len(members), -1)
        half = own.shape[1] // 2
        classes[w] = (members, own, own[:, :half] ^ own[:, half:])
    free, edges = np.ones(len(maps), dtype=bool), []
    for start in range(len(maps)):
        if not free[start]:
            continue
        queue = list(mates[int(labels[start])])
        free[queue] = False
        while queue:
            i = queue.pop()
            _, own, folded = classes[width[i]]
            own, folded = own[place[i]], folded[place[i]]
            for w, one, which in ((width[i] // 2, folded, 1), (width[i], own, 1), (width[i] * 2, own, 2)):
                if w not in classes:
                    continue
                members = classes[w][0]
                left = np.flatnonzero(free[members])
                if not len(left):
                    continue
                others = members[left]
                differ = np.bitwise_count(classes[w][which][left] ^ one).sum(axis=1).astype(np.int64)
                near = differ * (den + num) <= (sizes[others] + sizes[i]) * (den - num)
                near &= np.minimum(sizes[others], sizes[i]) * den >= np.maximum(sizes[others], sizes[i]) * num
                for label in np.unique(labels[others[near]]).tolist():
                    edges.append((int(labels[i]), label))
                    free[mates[label]] = False
                    queue += mates[label]
    return edges


def _compared(num: int, den: int):
    """Edges of each run of rows with one key and part, which come sorted by key, part, label and id.

    One run is held at a time: two blocks of documents at most.
    """
    names = ("label", "n", "bits")

    def compared(run):
        if run["label"] and run["label"][0] != run["label"][-1]:
            sizes, labels = np.array(run["n"]), np.array(run["label"])
            found = {(min(e), max(e)) for e in _compatible(sizes, run["bits"], labels, num, den)}
            if found:
                pairs = np.array(sorted(found), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pairs[:, 0].copy(), pairs[:, 1].copy()], ["a", "b"])

    def rows(batches):
        run, task = {k: [] for k in names}, None
        for batch in batches:
            table = batch.to_pydict()
            for i, key in enumerate(zip(table["key"], table["part"], strict=True)):
                if key != task:
                    yield from compared(run)
                    run, task = {k: [] for k in names}, key
                for k in names:
                    run[k].append(table[k][i])
        yield from compared(run)

    return rows


def prefix_candidates(
    docs: DataFrame, n: int, num: int, den: int, block: int = LIST_BLOCK, standing: DataFrame | None = None
) -> DataFrame:
    """Edges that connect all documents with a rare shingle in common and bitmaps that allow a link.

    With ``standing`` (``id``), documents that stand for others with equal sets, the
    others are left out. Documents that share a signature are connected first and then
    have one label; keys connect labels. A key with more than ``block`` documents is
    dealt over all pairs of its blocks.
    """
    spark = docs.sparkSession
    sketch = spark.sparkContext.broadcast(frequency_sketch(docs, n))
    maps = docs.mapInArrow(tidy(_bitmap_rows(n)), "id long, n long, bits binary, signed array<long>")
    maps = materialize(maps if standing is None else maps.join(standing, "id", "left_semi"))
    alike = materialize(_alike(maps))
    known = connected_components(alike)
    maps = maps.join(known, maps["id"] == known["node"], "left").select(
        "id", "n", "bits", F.coalesce("component", "id").alias("label")
    )
    entries = docs.mapInArrow(tidy(_prefix_rows(n, num, den, sketch)), "key long, id long")
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / block)
    entries = materialize(entries.join(shared, "key").withColumn("blocks", blocks).drop("members"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = entries.withColumn("own", own).withColumn("other", other)
    dealt = dealt.withColumn("part", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other"))
    rows = dealt.select("key", "part", "id").join(maps, "id").repartition("key", "part")
    # In order of labels, so that the keys of a group give the same edges.
    rows = rows.sortWithinPartitions("key", "part", "label", "id")
    return rows.mapInArrow(tidy(_compared(num, den)), "a long, b long").union(alike).distinct()


def _search(ids, queries, labels, sets, num: int, den: int, seen: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links among the documents of one task of which at least one is a query.

    ``labels`` are components known before; links inside one are not looked for.
    """
    order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
    ids, queries, labels, sets = ([x[i] for i in order] for x in (ids, queries, labels, sets))
    sizes = [len(s) for s in sets]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by_value = np.argsort(flat, kind="stable")
    ordered = flat[by_value]
    new = np.ones(len(flat), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    bounds = np.append(np.flatnonzero(new), len(flat))
    number = np.empty(len(flat), dtype=np.int64)
    number[by_value] = np.cumsum(new) - 1
    lengths = np.diff(bounds)
    postings, bounds = owner[by_value].tolist(), bounds.tolist()
    start = np.concatenate(([0], np.cumsum(sizes))).tolist()

    parent = {label: label for label in labels}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i, n in enumerate(sizes):
        lists = number[start[i] : start[i + 1]]
        lists = lists[lengths[lists] > 1]
        needed = -(-num * n // den)
        if len(lists) < needed:
            continue
        lists = lists[np.argsort(lengths[lists], kind="stable")]
        longest = int(lengths[lists[-1]])
        probed = min(needed - 1, int(needed / (PROBE_COST * math.log2(longest) + 1)))
        short, long = lists[: len(lists) - probed].tolist(), lists[len(lists) - probed :].tolist()
        merged = heapq.merge(*(postings[bounds[k] : bisect_left(postings, i, bounds[k], bounds[k + 1])] for k in short))
        for j, run in groupby(merged):
            if not (queries[i] or queries[j]) or sizes[j] * den < num * n or root(labels[i]) == root(labels[j]):
                continue
            overlap = sum(1 for _ in run)
            target = -(-num * (n + sizes[j]) // (num + den))
            for k, below in enumerate(long):
                if overlap + len(long) - k < target or overlap >= target:
                    break
                place = bisect_left(postings, j, bounds[below], bounds[below + 1])
                overlap += place < bounds[below + 1] and postings[place] == j
            if overlap >= target:
                links.append((ids[i], ids[j]))
                parent[root(labels[i])] = root(labels[j])
    return links


def _searched(num: int, den: int):
    def rows(batches):
        held: list[dict] = []

        def done():
            if len(held) > 1:
                sets = [np.frombuffer(h["bits"], dtype=np.uint64) for h in held]
                links = _search(*([h[k] for h in held] for k in ("id", "query", "label")), sets, num, den)
                if links:
                    a, b = zip(*links, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        task = None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["cluster"], row["part"])
                if key != task:
                    yield from done()
                    held, task = [], key
                held.append(row)
        yield from done()

    return rows


def _with_sets(n: int):
    """Replace the text by its shingle set."""

    def rows(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                sets, at = shingle_sets(piece.column("text"), n)
                maps = [sets[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:], strict=True)]
                columns = [piece.column(c) for c in ("cluster", "part", "id", "query", "label")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(maps, pa.binary())], ["cluster", "part", "id", "query", "label", "bits"]
                )

    return rows


def _find(docs: DataFrame, tasks: DataFrame, members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links within tasks, whose rows name a cluster, a part, a document, whether it is a query, and its label.

    ``members`` is a stored table with all their documents. Texts of others are left
    out where they are read, as far as a Bloom filter of the members tells; its size
    is bounded by Spark's settings, and with very many members it lets more texts pass.
    """
    ids = members.filter("parts > 0").select("id")
    # The texts are far larger than the tasks at any size worth planning for, so
    # the join is the same at every size.
    rows = docs.join(ids.hint("merge"), "id", "left_semi").join(tasks.hint("merge"), "id")
    rows = rows.select("cluster", "part", "id", "query", "label", "text")
    fields = "cluster long, part long, id long, query boolean, label long, bits binary"
    rows = rows.mapInArrow(tidy(_with_sets(n)), fields).repartition("cluster", "part")
    links = rows.sortWithinPartitions("cluster", "part").mapInArrow(tidy(_searched(num, den)), "a long, b long")
    with settings(docs.sparkSession, MEMBER_FILTER):
        return materialize(links)


def _split(members: DataFrame, block: int) -> DataFrame:
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    return (
        members.drop("n")
        .join(sizes.filter("members > 1"), "cluster")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")))
    )


def _search_clusters(docs: DataFrame, members: DataFrame, n: int, num: int, den: int, block: int) -> DataFrame:
    """Links of all documents within a cluster. ``members``: id, cluster, and n, the size of its set."""
    split = materialize(_split(members, block))
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    hub = F.pmod(F.xxhash64("id", F.lit(1)), F.col("members")) < HUBS
    tasks = split.withColumn("part", F.explode(F.when(hub, everywhere).otherwise(F.array("own"))))
    first = tasks.select("cluster", "part", "id", F.lit(True).alias("query"), F.col("id").alias("label"))
    links = _find(docs, first, split, n, num, den)
    large = split.filter("parts > 1")
    if large.isEmpty():
        return links
    # In a cluster over several tasks, pairs of different tasks are still to be
    # compared, unless they are connected by now. Usually nearly all are.
    known = connected_components(links)
    large = large.join(known, large["id"] == known["node"], "left").withColumn("label", F.coalesce("component", "id"))
    large = materialize(large.drop("node", "component"))
    parts = large.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("size"))
    main = parts.groupBy("cluster").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
    large = materialize(large.join(main, "cluster").withColumn("query", F.col("label") != F.col("main")))
    asking = large.filter("query").groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).alias("groups"))
    if asking.isEmpty():
        return links
    dealt = materialize(large.join(asking, "cluster"))
    number = F.col("group") * F.col("parts") + F.col("there")
    group = F.pmod(F.xxhash64("id", F.lit(2)), F.col("groups"))
    every_group = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))
    data = dealt.withColumn("group", every_group).withColumn("there", F.col("own")).withColumn("query", F.lit(False))
    queries = dealt.filter("query").withColumn("group", group).withColumn("there", F.explode(everywhere))
    second = data.unionByName(queries).withColumn("part", number)
    # A straggler may meet itself as a row of the data; equal labels are skipped.
    second = second.groupBy("cluster", "part", "id", "label").agg(F.max("query").alias("query"))
    return links.union(_find(docs, second, dealt, n, num, den))


def near_duplicates(
    docs: DataFrame,
    n: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    keys: str | None = None,
) -> DataFrame:
    """Per row of ``docs`` its id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    ``num``/``den`` is the least Jaccard similarity of a link, one half or more.
    ``keys`` forces "segments" or "prefix" as candidate keys; both give the same
    links.
    """
    if not den <= 2 * num <= 2 * den:
        raise ValueError("the similarity of a link must lie between one half and one")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sizes = materialize(set_sizes(docs, n))
    known = sizes.filter("id is not null and n_shingles > 0")
    classes = known.groupBy("n_shingles", "digest_1", "digest_2").agg(F.min("id").alias("b"))
    copies = known.join(classes, ["n_shingles", "digest_1", "digest_2"]).filter("id != b").select(F.col("id").alias("a"), "b")
    texts = docs.filter("id is not null")
    usual = (den + num) / (den - num) / (1 + den / num) if den > num else math.inf  # shingles in a segment
    keys = keys or ("segments" if usual >= SEGMENT_SHINGLES else "prefix")
    if keys == "segments":
        candidates = segment_candidates(texts, n, num, den)
    else:
        candidates = prefix_candidates(texts, n, num, den, standing=classes.select(F.col("b").alias("id")))
    near = connected_components(candidates)
    standing = classes.groupBy(F.col("b").alias("node")).agg(F.max("n_shingles").alias("n"))
    members = near.join(standing, "node").select(F.col("node").alias("id"), F.col("component").alias("cluster"), "n")
    links = _search_clusters(texts, members, n, num, den, block)
    found = connected_components(links.union(copies.select("a", "b")))
    return sizes.join(found, sizes["id"] == found["node"], "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id")
    )


def keep_one_of_each(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are not linked to a row of a smaller id.

    Rows without an id or without words are all kept; of rows that repeat an id
    all are kept or none.
    """
    found = near_duplicates(docs, n, num, den, id_col, text_col)
    gone = found.filter(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct()
    gone = materialize(gone)
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
