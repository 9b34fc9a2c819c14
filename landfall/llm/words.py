"""Words and shingles of whole Arrow columns, as numpy arrays.

The functions work on the UTF-8 bytes of many texts at once, so no Python loop
runs over words. All separators used here are ASCII, hence byte positions never
cut a character.
"""

from __future__ import annotations

import ctypes
import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 19

# The session's limit of bytes in a batch for Python, and what it is lowered to.
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def tidy(rows: Callable) -> Callable:
    """A task's function that takes small batches, and hands freed memory back when the task is over.

    Texts make batches of the usual number of rows large, in the JVM and again in
    Python, so the session's limit of their bytes is lowered. Python workers are used
    again for later stages; what their allocators hold on to would add up.
    """
    conf = SparkSession.active().conf
    size = re.fullmatch(r"(\d+)([bkmg]?)b?", conf.get(BATCH_LIMIT, "1g").lower())
    if size is None or int(size[1]) * UNITS[size[2]] > BATCH_BYTES:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))

    @functools.wraps(rows)
    def run(batches):
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux
            if trim is not None:
                trim(0)

    return run


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def byte_class(spec: Iterator[int] | range | list[int]) -> np.ndarray:
    """A table telling which byte values belong to words."""
    table = np.zeros(256, dtype=bool)
    table[list(spec)] = True
    return table


# Words are everything but blanks and the control characters 9 to 13.
SPACED_WORDS = byte_class([b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D])
# Words are ASCII letters and digits, and all characters beyond ASCII.
PLAIN_WORDS = byte_class([b for b in range(256) if b >= 0x80 or chr(b).isalnum()])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``limit`` bytes of text, or one row."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield batch.slice(start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in a row, and the n + 1 places where texts begin and end. NULL is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(at), dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every word."""
    inside = kind[data]
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    edges = at[(at > 0) & (at < len(data))]
    before = np.concatenate(([False], inside[:-1]))
    before[edges] = False
    after = np.concatenate((inside[1:], [False]))
    after[edges - 1] = False
    begin = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return begin, end, np.searchsorted(at, begin, side="right") - 1


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word that depends on its bytes alone."""
    powers = np.full(len(data) + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers[:-1], out=total[1:])
    inverse = np.full(len(data) + 1, _BASE_INVERSE, dtype=np.uint64)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    return mixed((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The different n-word shingles of each text as sorted hashes, and where each text's set begins.

    A text of fewer words has its whole sequence as the only shingle, one
    without words has none. A-Z are lower-cased first.
    """
    data, at = text_bytes(texts)
    data = lower_ascii(data)
    begin, end, text = word_bounds(data, at, SPACED_WORDS)
    hashes = word_hashes(data, begin, end)
    count = np.bincount(text, minlength=len(texts)).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(count)[:-1])).astype(np.int64)
    shingles, owner = [], []
    whole = np.maximum(len(hashes) - n + 1, 0)
    rolled = np.zeros(whole, dtype=np.uint64)
    for k in range(n):
        rolled += hashes[k : k + whole] * np.uint64((_BASE ** (k + 1)) & _MASK)
    same = text[:whole] == text[n - 1 :] if whole else np.zeros(0, dtype=bool)
    shingles.append(mixed(rolled[same]))
    owner.append(text[:whole][same])
    for words in range(1, n):  # short texts
        which = np.flatnonzero(count == words)
        short = np.full(len(which), words, dtype=np.uint64)
        for k in range(words):
            short += hashes[first[which] + k] * np.uint64((_BASE ** (k + 1)) & _MASK)
        shingles.append(mixed(short))
        owner.append(which)
    shingles, owner = np.concatenate(shingles), np.concatenate(owner)
    order = np.argsort(shingles)
    few = len(texts) <= 1 << 16  # 16-bit keys are sorted by radix
    order = order[np.argsort(owner[order].astype(np.uint16 if few else np.int64), kind="stable")]
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), dtype=bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    shingles, owner = shingles[new], owner[new]
    return shingles, np.searchsorted(owner, np.arange(len(texts) + 1))
