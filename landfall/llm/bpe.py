"""Byte-pair encoding and decoding with a priority queue over a linked list.

The vocabulary and merge ranks come from a byte-level tokenizer file of the
``tokenizers`` library, whose ids the encoder reproduces; the library itself is
not used. Texts are cut into words by the file's rule, and each different word
is merged once per Python worker as long as the bounded memory of words holds it.

NULL is encoded as the empty text, the empty text as no ids. Rows keep their
order within a partition; repeated rows are encoded alike.
"""

from __future__ import annotations

import heapq
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.words import slices, tidy

# Words, and pieces between blanks, in each of two generations of a worker's memory: some 180 bytes each.
REMEMBERED_WORDS = 120_000

# The word rule of byte-level tokenizers. White space is spelled
# out, as the regular expressions of Python and of the library differ on it.
SPACE = r"\t-\r \x85\xa0  -     　"
WORD_RULE = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

# Words of at most this many bytes are merged by scanning their pairs, longer ones through a queue.
SHORT_WORD = 32

# The rank of a pair that is never merged.
_NEVER = 1 << 62

# A blank before one of these does not begin a word of its own.
_IRREGULAR = regex.compile(rf" (?:[{SPACE}]|$)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Memory:
    """A bounded map of texts to ids in two generations.

    When the younger one is full it becomes the older one. What keeps coming is taken
    over from there, what does not is forgotten.
    """

    def __init__(self, size: int = REMEMBERED_WORDS):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def put(self, text: str, ids: bytes) -> None:
        if len(text) < 64:
            if len(self.young) >= self.size:
                self.old, self.young = self.young, {}
            self.young[text] = ids

    def recall(self, text: str) -> bytes | None:
        """Ids from the older generation, for a text that the younger one lacks."""
        ids = self.old.get(text)
        if ids is not None:
            self.put(text, ids)
        return ids


class BytePairs:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocabulary = data["model"]["vocab"]
        letters = byte_letters()
        self.spelled = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.spelled |= {i: content.encode() for content, i in self.special.items()}
        self.of_byte = [0] * 256
        for token, i in vocabulary.items():
            if len(token) == 1:
                self.of_byte[letters[token]] = i
        self.merged, self.ranks = [], {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merged.append(vocabulary[left + right])
            self.ranks.setdefault(vocabulary[left] << 32 | vocabulary[right], rank)
        # Ranks of the pairs of single bytes, by the first byte and then the second.
        self.byte_ranks = [[self.ranks.get(a << 32 | b, _NEVER) for b in self.of_byte] for a in self.of_byte]
        self.words = regex.compile(WORD_RULE)
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.known_words, self.known_units = Memory(), Memory()

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank is joined first, the leftmost of equals."""
        if len(word) <= SHORT_WORD:
            return self._merge_short(word)
        symbols = [self.of_byte[b] for b in word]
        n, ranks, merged = len(symbols), self.ranks, self.merged
        queue = []
        for i in range(n - 1):
            rank = ranks.get(symbols[i] << 32 | symbols[i + 1])
            if rank is not None:
                queue.append(rank << 32 | i)
        if not queue:
            return symbols
        heapq.heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            entry = heapq.heappop(queue)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            # An entry is stale once either symbol has gone into another one.
            if symbols[i] < 0 or j >= n or ranks.get(symbols[i] << 32 | symbols[j]) != rank:
                continue
            symbols[i] = joined = merged[rank]
            symbols[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get(joined << 32 | symbols[k])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = ranks.get(symbols[h] << 32 | joined)
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def _merge_short(self, word: bytes) -> list[int]:
        """As ``merge``, rescanning the ranks of neighbouring pairs, which is quicker for short words."""
        of_byte, ranks, merged, byte_ranks = self.of_byte, self.ranks, self.merged, self.byte_ranks
        symbols = list(map(of_byte.__getitem__, word))
        pairs = [byte_ranks[a][b] for a, b in zip(word, word[1:])]
        while pairs:
            rank = min(pairs)
            if rank == _NEVER:
                break
            i = pairs.index(rank)
            joined = merged[rank]
            symbols[i : i + 2] = (joined,)
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(symbols[i - 1] << 32 | joined, _NEVER)
            if i < len(pairs):
                pairs[i] = ranks.get(joined << 32 | symbols[i + 1], _NEVER)
        return symbols

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        out = []
        for word in self.words.findall(text):
            ids = self.known_words.young.get(word)
            if ids is None:
                ids = self.known_words.recall(word)
            if ids is None:
                ids = self._packed(self.merge(word.encode("utf-8")))
                self.known_words.put(word, ids)
            out.append(ids)
        return b"".join(out)

    def _unit(self, text: str) -> bytes:
        """Ids of a text, in which the strings of special tokens stand for them."""
        if self.specials is None or "<" not in text and not self.specials.search(text):
            return self._plain(text)
        out, done = [], 0
        for found in self.specials.finditer(text):
            out += [self._plain(text[done : found.start()]), self._packed([self.special[found[0]]])]
            done = found.end()
        return b"".join([*out, self._plain(text[done:])])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        Every blank before a visible character begins a word, so the pieces
        between blanks are encoded one by one, each different piece once.
        """
        if _IRREGULAR.search(text) or any(" " in s for s in self.special):
            return self._unit(text)
        known, out = self.known_units, []
        first, *pieces = text.split(" ")
        out.append(self._unit(first))
        for piece in pieces:
            ids = known.young.get(piece)
            if ids is None:
                ids = known.recall(piece)
            if ids is None:
                ids = self._unit(" " + piece)
                known.put(piece, ids)
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The strings of the vocabulary one after the other; an unknown id gives nothing."""
        spelled = self.spelled
        found = memoryview(ids).cast("I") if ids else ()
        try:
            joined = b"".join([spelled[i] for i in found])
        except KeyError:
            joined = b"".join([spelled.get(i, b"") for i in found])
        return joined.decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def byte_pairs(path: str) -> BytePairs:
    """The encoder of a file, made once per worker."""
    return BytePairs(path)


def _replaced(df: DataFrame, column: str, made: str, kind: str, function) -> DataFrame:
    """Replace ``column`` by a new one that ``function`` makes of the rows of a batch."""
    fields = [f for f in df.schema.fields if f.name not in (column, made)]
    names = [f.name for f in fields]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, column):
                others = [piece.column(piece.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*others, function(piece.column(column))], [*names, made])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{made}` {kind}"])
    return df.select(*[F.col(f"`{c}`") for c in (*names, column)]).mapInArrow(tidy(rows), schema)


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Replace the text by its ids, packed as little-endian unsigned 32-bit integers."""

    def ids(texts):
        pairs = byte_pairs(path)
        return pa.array([pairs.encode(t or "") for t in texts.to_pylist()], pa.binary())

    return _replaced(docs, text_col, ids_col, "binary", ids)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Replace packed ids by the text they spell."""

    def texts(ids):
        pairs = byte_pairs(path)
        return pa.array([pairs.decode(i or b"") for i in ids.to_pylist()], pa.string())

    return _replaced(tokens, ids_col, text_col, "string", texts)


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per row the number of ids and the SHA-256 of the ids and of the text decoded from them."""
    packed = encode(docs.select(id_col, F.col("text").cast("string")), path)
    packed = packed.select(
        id_col,
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        "ids",
    )
    return decode(packed, path).select(
        id_col, "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256")
    )
