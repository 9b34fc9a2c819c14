"""Token ids of a corpus as ORC files, and their reading.

Documents are sorted by id over the cluster, encoded with the ``tokenizers``
library, ended by an end id and written in that order. ORC stores the ids with
its integer run-length encoding, keeps statistics per stripe and per row group,
and a Bloom filter on the document id, so a reader of few documents skips nearly
all stripes, and stripes can be read in parallel.

A file's rows carry their sort slice and the number of ids before them in the
slice; the slices' sums, one row each, turn these into places in the corpus.

NULL is encoded as the empty text, which has the end id alone. Rows that repeat
a document id stand next to each other in order of their texts' hashes; rows
without an id come first.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.words import slices, tidy

# Pieces in each of two generations of a worker's memory, of some 200 bytes each.
REMEMBERED_UNITS = 450_000

# Marks of pieces that came before, one byte each.
SEEN = 1 << 22

# Pieces that the library encodes in one call.
LEARNED_AT_ONCE = 10_000

# Bytes of text encoded at once, or one row.
PIECE_BYTES = 1 << 20

# Rows per entry of the row index, and bytes of a stripe.
ROW_INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20

FIELDS = "doc_id long, slice int, before long, ids array<int>"

# Text between these is encoded alike wherever it stands.
_IRREGULAR = regex.compile(r" (?:\s|$)")


class _Library:
    """The library's encoder with a bounded memory of pieces between blanks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses all cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        # Each character of an entry stands for one byte.
        self.lengths = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.lengths[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.by_pieces = not any(" " in s or "<" not in s for s in special.values())
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seen = bytearray(SEEN)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learned(self, units: list[str]) -> list[bytes]:
        """Encode many pieces in one call; a piece's ids are those that spell its bytes and the blank before it."""
        out: list[bytes] = []
        for k in range(0, len(units), LEARNED_AT_ONCE):
            some = units[k : k + LEARNED_AT_ONCE]
            # A piece with a special token's sign is encoded on its own.
            plain = ["" if "<" in u else u for u in some]
            encoded = self.tokenizer.encode_batch_fast([" " + " ".join(u for u in plain if u)], add_special_tokens=False)[0]
            ids = np.array(encoded.ids, dtype="<u4")
            spelled = np.cumsum(self.lengths[ids])
            sizes = pc.binary_length(pa.array(plain, pa.large_string())).to_numpy()
            wanted = np.cumsum(np.where(sizes > 0, sizes + 1, 0))
            cuts = np.where(wanted > 0, np.searchsorted(spelled, wanted) + 1, 0)
            if (sizes > 0).any() and (len(ids) != cuts[-1] or (spelled[cuts[wanted > 0] - 1] != wanted[wanted > 0]).any()):
                raise ValueError("the tokenizer joins bytes of neighbouring words")
            packed, start = ids.tobytes(), 0
            for unit, whole, end in zip(some, plain, (4 * cuts).tolist(), strict=True):
                out.append(packed[start:end] if whole else self.whole(f" {unit}"))
                start = end
        return out

    def _prepare(self, units: list[str]) -> list[bytes]:
        """Packed ids of different units, from memory or encoded anew.

        A unit is remembered when it comes for the second time (or shares a hash with one
        that came before): most different units come once. When the younger generation
        is full it becomes the older one, so units that keep coming are never encoded
        again and rare ones are forgotten.
        """
        if len(self.known) > REMEMBERED_UNITS:
            self.older, self.known, self.seen = self.known, {}, bytearray(SEEN)
        known, older, seen = self.known, self.older, self.seen
        found = list(map(known.get, units))
        places = []
        for i, ids in enumerate(found):
            if ids is None:
                ids = older.get(units[i])
                if ids is None:
                    places.append(i)
                else:
                    found[i] = known[units[i]] = ids
        missing = [units[i] for i in places]
        for i, unit, ids in zip(places, missing, self._learned(missing), strict=True):
            found[i] = ids
            mark = hash(unit) & (SEEN - 1)
            if seen[mark]:
                known[unit] = ids
            else:
                seen[mark] = 1
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids per text."""
        ids, at = self.encode_column(pa.array(texts, pa.large_string()))
        return [ids[lo:hi].tobytes() for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin and end.

        A blank before a visible character always begins a new word, so texts are cut
        at blanks and each different piece of a batch is encoded once.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        plain = texts.to_pylist()
        if self.by_pieces:
            odd = np.array([_IRREGULAR.search(t) is not None for t in plain], dtype=bool)
        else:
            odd = np.ones(len(plain), dtype=bool)
        pieces = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), pattern=" ")
        at = pieces.offsets.to_numpy().astype(np.int64)
        coded = pieces.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at -= at[0]
        index = coded.indices.to_numpy().astype(np.int64)
        packed = self._prepare(coded.dictionary.to_pylist())
        # The first piece has no blank before it; a text that is odd is one piece.
        heads = [t if strange else t.split(" ", 1)[0] for t, strange in zip(plain, odd.tolist(), strict=True)]
        index[at[:-1]] = len(packed) + np.arange(len(plain))
        packed += [self.whole(head) if head else b"" for head in heads]
        pool = np.frombuffer(b"".join(packed), dtype="<i4")
        sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
        starts = np.cumsum(sizes) - sizes
        lengths = sizes[index]
        ends = np.cumsum(lengths)
        ids = pool[np.repeat(starts[index] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate(([0], ends))[at]


@lru_cache(maxsize=4)
def _library(path: str) -> _Library:
    return _Library(path)


def token_rows(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Rows of the files in ascending order of document ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, before = _library(path), 0
        number = TaskContext.get().partitionId()
        for batch in batches:
            for piece in slices(batch, "text", PIECE_BYTES):
                ids, at = library.encode_column(piece.column("text"))
                ids = np.insert(ids, at[1:], end_id)
                at = at + np.arange(len(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        np.full(len(at) - 1, number, dtype=np.int32),
                        before + at[:-1],
                        pa.ListArray.from_arrays(at.astype(np.int32), ids),
                    ],
                    ["doc_id", "slice", "before", "ids"],
                )
                before += int(at[-1])

    return docs.select("doc_id", F.col("text").cast("string")).orderBy("doc_id", F.xxhash64("text")).mapInArrow(tidy(rows), FIELDS)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Encode ``doc_id`` and ``text`` of all rows and write them to ORC files below ``path``."""
    (
        token_rows(docs, tokenizer_path, end_id)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", str(ROW_INDEX_STRIDE))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """All rows, with ``start``, the number of ids of all documents before.

    A filter on ``doc_id`` reaches the files' statistics and Bloom filters.
    """
    rows = spark.read.schema(FIELDS).orc(path)
    sums = rows.groupBy("slice").agg(F.sum(F.size("ids").cast("long")).alias("_ids"))
    # One row per sort slice, so this window is as small as the partition count.
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("slice", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base"))
    return rows.join(F.broadcast(bases), "slice").select(
        "doc_id", (F.col("_base") + F.col("before")).alias("start"), "ids"
    )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document its place, its number of ids and their CRC-32, read back from the files."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            sums = [zlib.crc32(values[lo:hi]) for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns = [batch.column("doc_id"), batch.column("start"), np.diff(at).astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    found = read_token_files(spark, path).select("doc_id", "start", "ids")
    return found.mapInArrow(tidy(rows), "doc_id long, start long, n_tokens long, ids_crc32 long")
