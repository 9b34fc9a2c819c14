"""Passages of benchmark items in documents, found with a generalised suffix automaton.

The automaton of all items accepts every run of words of every item and of
nothing else. A document's words are streamed through it while the length of the
longest run that ends at each word is tracked. A run of ``window`` words, or of a
whole shorter item, is an occurrence; its words are hit.

The automata are built on the driver from the benchmark, whose number of words is
checked: a larger one is split into groups of items with an automaton each, which
bounds one broadcast but not their sum. The driver and every worker hold all of
them at once, about a kilobyte a word of the whole benchmark.

NULL and empty texts have no words, neither hit documents nor hit them. Items
that repeat an id are listed once, items without an id hit words but are not
listed. Rows that repeat a document id are treated one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.words import (
    PLAIN_WORDS,
    lower_ascii,
    mixed,
    slices,
    text_bytes,
    tidy,
    word_bounds,
    word_hashes,
)

# Words of items in one automaton, of which each takes about a kilobyte.
MAX_ITEM_WORDS = 200_000

SPANS = "array<struct<lo:long,hi:long>>"


class SuffixAutomaton:
    """All runs of words of a set of items, and which items hold a run of ``window`` words."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.window = window
        self.length, self.link, self.next = [0], [-1], [{}]
        ends = []
        for _, words in items:
            last, path = 0, []
            for word in words:
                last = self._extend(last, word)
                path.append(last)
            ends.append(path)
        self.top = [self._shortest_long(v) for v in range(len(self.length))]
        holders: list[set[int]] = [set() for _ in self.length]
        seen = [-1] * len(self.length)
        whole: dict[int, list[tuple[int, int | None]]] = {}
        for number, ((item, words), path) in enumerate(zip(items, ends, strict=True)):
            if words and len(words) < window:
                whole.setdefault(self._walk(words), []).append((len(words), item))
            for v in path:
                while v > 0 and seen[v] != number and self.length[v] >= window:
                    seen[v] = number
                    if item is not None:
                        holders[v].add(item)
                    v = self.link[v]
        self.holders = [frozenset(h) for h in holders]
        # Whole short items that end wherever a state's longest run ends.
        self.short: list[tuple[tuple[int, int | None], ...]] = [()] * len(self.length)
        for v in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.short[v] = self.short[self.link[v]] + tuple(whole.get(v, ()))

    def _walk(self, words: list[bytes]) -> int:
        v = 0
        for word in words:
            v = self.next[v][word]
        return v

    def _shortest_long(self, v: int) -> int:
        """The state on the suffix path of ``v`` that holds the run of exactly ``window`` words."""
        if self.length[v] < self.window:
            return -1
        while self.length[self.link[v]] >= self.window:
            v = self.link[v]
        return v

    def _add(self, length: int, link: int, moves: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.length) - 1

    def _copy(self, p: int, word: bytes, q: int) -> int:
        """A state for the shorter runs of ``q``, to which ``p`` and its suffixes lead from now on."""
        clone = self._add(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:  # an earlier item has the same run
            return known if self.length[known] == self.length[last] + 1 else self._copy(last, word, known)
        state = self._add(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._copy(p, word, q)
        return state

    def occurrences(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged (first, past last) word numbers of all occurrences, and the ids of the items."""
        nexts, lengths, links = self.next, self.length, self.link
        v = size = 0
        spans: list[list[int]] = []
        found: set[int] = set()
        for i, word in enumerate(words):
            while v and word not in nexts[v]:
                v = links[v]
                size = lengths[v]
            v = nexts[v].get(word, 0)
            size = size + 1 if v else 0
            longest = 0
            if size >= self.window:
                # The run tracked may be shorter than the state's longest.
                longest = self.window
                found |= self.holders[self.top[v]]
            for short, item in self.short[v]:
                if short <= size:
                    longest = max(longest, short)
                    if item is not None:
                        found.add(item)
            if longest:
                lo = i + 1 - longest
                if spans and lo <= spans[-1][1]:
                    spans[-1][0] = min(spans[-1][0], lo)
                    spans[-1][1] = i + 1
                    while len(spans) > 1 and spans[-1][0] <= spans[-2][1]:
                        lo, hi = spans.pop()
                        spans[-1] = [min(lo, spans[-1][0]), hi]
                else:
                    spans.append([lo, i + 1])
        return [(lo, hi) for lo, hi in spans], found


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes[:-1] * np.uint64(3) + hashes[1:])


def plain_words(texts: pa.Array):
    """(lower-cased bytes, text borders, begin, end, text number) of all words."""
    data, at = text_bytes(texts)
    data = lower_ascii(data)
    return data, at, *word_bounds(data, at, PLAIN_WORDS)


class _Matcher:
    """An automaton behind a filter that passes only runs of word pairs known from items."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        data, _, begin, end, owner = plain_words(pa.array([t for _, t in items], pa.string()))
        words = [data[lo:hi].tobytes() for lo, hi in zip(begin, end, strict=True)]
        at = np.searchsorted(owner, np.arange(len(items) + 1))
        sequences = [(item, words[at[k] : at[k + 1]]) for k, (item, _) in enumerate(items)]
        self.shortest = min((min(window, len(s)) for _, s in sequences if s), default=0)
        hashes = word_hashes(data, begin, end)
        single = self.shortest <= 1
        known = hashes if single else _pairs(hashes)[owner[1:] == owner[:-1]] if len(hashes) else hashes
        self.single, self.known = single, np.unique(known)
        self.automaton = SuffixAutomaton(sequences, window)

    def candidates(self, hashes: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
        """Runs of words that may hold an occurrence: all their neighbouring pairs are known."""
        if not len(hashes) or not len(self.known):
            return []
        probe = hashes if self.single else _pairs(hashes)
        place = np.searchsorted(self.known, probe)
        hit = self.known[np.minimum(place, len(self.known) - 1)] == probe
        if not self.single:
            hit &= owner[1:] == owner[:-1]
        edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if self.single:  # words of two texts are never one run
            cut = np.flatnonzero(owner[1:] != owner[:-1]) + 1
            inner = cut[hit[cut - 1] & hit[cut]] if len(cut) else cut
            lo, hi = np.sort(np.concatenate((lo, inner))), np.sort(np.concatenate((hi, inner)))
        else:
            hi = hi + 1
        long = hi - lo >= self.shortest
        return list(zip(lo[long].tolist(), hi[long].tolist(), strict=True))


def _matched(matcher, keep: list[str], cut: bool, max_coverage: float):
    """Rows with the numbers of words and hits, the items, and the hit words so far or the text without them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = matcher.value
        for batch in batches:
            for piece in slices(batch, "_text"):
                texts = piece.column("_text")
                data, at, begin, end, owner = plain_words(texts)
                first = np.searchsorted(owner, np.arange(len(texts) + 1))
                spans = [[(s["lo"], s["hi"]) for s in row or ()] for row in piece.column("_spans").to_pylist()]
                items = [set(row or ()) for row in piece.column("_items").to_pylist()]
                for lo, hi in found.candidates(word_hashes(data, begin, end), owner):
                    text = int(owner[lo])
                    words = [data[begin[k] : end[k]].tobytes() for k in range(lo, hi)]
                    places, ids = found.automaton.occurrences(words)
                    base = lo - int(first[text])
                    spans[text] += [(base + a, base + b) for a, b in places]
                    items[text] |= ids
                spans = [_union(row) for row in spans]
                hits = [sum(hi - lo for lo, hi in row) for row in spans]
                out = [piece.column(piece.schema.get_field_index(c)) for c in keep]
                out += [pa.array(np.diff(first)), pa.array(hits, pa.int64()), pa.array(map(sorted, items), pa.list_(pa.int64()))]
                names = [*keep, "_n_words", "_n_hit", "_items"]
                if cut:
                    cleaned = []
                    for text, (row, hit) in enumerate(zip(spans, hits, strict=True)):
                        cleaned.append(texts[text].as_py())
                        if hit > max_coverage * (first[text + 1] - first[text]):
                            cleaned[-1] = None
                        elif hit:
                            words = slice(first[text], first[text + 1])
                            cleaned[-1] = _without(cleaned[-1], row, begin[words] - at[text], end[words] - at[text])
                    out.append(pa.array(cleaned, pa.string()))
                    names.append("_text")
                else:
                    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
                    out += [texts, pa.array([[{"lo": lo, "hi": hi} for lo, hi in row] for row in spans], kind)]
                    names += ["_text", "_spans"]
                yield pa.RecordBatch.from_arrays(out, names)

    return rows


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _without(text: str, spans: list[tuple[int, int]], begin: np.ndarray, end: np.ndarray) -> str:
    data, parts, done = text.encode("utf-8"), [], 0
    for lo, hi in spans:
        parts.append(data[done : begin[lo]])
        done = int(end[hi - 1])
    return b"".join([*parts, data[done:]]).decode("utf-8")


def _matchers(items: DataFrame, window: int, max_words: int) -> list:
    """Matchers of groups of items, of at most ``max_words`` bytes-bounded words each."""
    items = items.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull())
    words = items.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    groups = max(1, -(-int(words) // max_words))
    spark = items.sparkSession
    dealt = items.withColumn("_group", F.pmod(F.xxhash64("id", "text"), F.lit(groups)))
    for group in range(groups):
        some = [(r.id, r.text) for r in dealt.filter(F.col("_group") == group).collect()]  # bounded by max_words
        yield spark.sparkContext.broadcast(_Matcher(some, window))


def _pass_through(docs: DataFrame, items: DataFrame, window: int, cut: bool, max_coverage: float, max_words: int):
    fields = [f for f in docs.schema.fields if f.name != "text"]  # the text goes along once, as _text
    keep = [f"_c{k}" for k in range(len(fields))]  # extra columns may have any name
    kinds = "".join(f"{k} {f.dataType.simpleString()}, " for k, f in zip(keep, fields, strict=True))
    rows = docs.select(
        *[F.col(f"`{f.name}`").alias(k) for k, f in zip(keep, fields, strict=True)],
        F.col("text").cast("string").alias("_text"),
        F.lit(None).cast(SPANS).alias("_spans"),
        F.lit(None).cast("array<long>").alias("_items"),
    )
    matchers = list(_matchers(items, window, max_words))
    for k, matcher in enumerate(matchers):
        last = cut and k == len(matchers) - 1
        made = f"{kinds}_n_words long, _n_hit long, _items array<long>, _text string" + ("" if last else f", _spans {SPANS}")
        rows = rows.select(*keep, "_text", "_spans", "_items").mapInArrow(tidy(_matched(matcher, keep, last, max_coverage)), made)
    return rows, list(zip(keep, fields, strict=True))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", max_words: int = MAX_ITEM_WORDS
) -> DataFrame:
    """Per document ``n_words``, ``n_hit``, ``item_ids`` and ``spans`` (numbers of the first and past the last hit word)."""
    rows, _ = _pass_through(docs.select(id_col, "text"), items, window, False, 1.0, max_words)
    return rows.select(
        F.col("_c0").alias(id_col),
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.col("_items").alias("item_ids"),
        F.col("_spans").alias("spans"),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    max_coverage: float = 0.5,
    max_words: int = MAX_ITEM_WORDS,
) -> DataFrame:
    """Documents without the passages found in them, in the columns of ``docs``.

    A document of whose words more than ``max_coverage`` are hit is dropped;
    from others the hit passages are cut, from the first to the last word of
    each. Documents without a hit stay as they are. ``n_chars`` follows the text.
    """
    rows, kept = _pass_through(docs, items, window, True, max_coverage, max_words)
    rows = rows.filter("_n_hit = 0 or _text is not null")
    made = {field.name: F.col(key) for key, field in kept}
    if "n_chars" in made:
        kind = docs.schema["n_chars"].dataType
        made["n_chars"] = F.when(F.col("_n_hit") > 0, F.length("_text")).otherwise(made["n_chars"]).cast(kind)
    made["text"] = F.col("_text")
    return rows.select(*[made[c].alias(c) for c in docs.columns])
