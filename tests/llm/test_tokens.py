"""Encoding against the tokenizers library, and the token files' round trip."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landfall.llm import token_files
from landfall.llm.bpe import BytePairs, round_trip_digests
from landfall.llm.token_files import read_digests, read_token_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(6)
    pieces = ["the", "The", " ", "  ", "\n", "\t", "don't", "'LL", "it's", "123", "4567", "été", "日本語", "😀", "!!", "...", "<|endoftext|>",
              "<|endoftext", " x", " ", " ", "\x1c", "\x85", "ß", "İ", "word", "zq", "é", "\r\n", "<", "Ⅷ", "½"]
    out = ["".join(rng.choices(pieces, k=rng.randrange(60))) for _ in range(1500)]
    out += [chr(c) + chr(c) + " " + chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000]
    return [*out, "", " ", "  ", " a", "a ", "ab" * 30_000, " " * 5000 + "x", "x" * 20_000]


@pytest.mark.parametrize("remembered", [120_000, 50])
def test_ids_equal_the_library(library, remembered):
    pairs = BytePairs(PATH)
    pairs.known_words.size = pairs.known_units.size = remembered
    for text in texts():
        ids = np.frombuffer(pairs.encode(text), dtype="<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:80]
        assert pairs.decode(pairs.encode(text)) == library.decode(ids, skip_special_tokens=False) == text


def test_short_and_long_words_merge_alike(library, monkeypatch):
    """Short words are merged by scanning their pairs, long ones through a queue: both as the library."""
    from landfall.llm import bpe

    rng = random.Random(8)
    letters = ["a", "aa", "e", "th", "é", "日", "ab", "ß"]  # one word of the library each
    words = [" " + "".join(rng.choices(letters, k=rng.randrange(1, 40))) for _ in range(2000)]
    words += ["a" * n for n in range(1, 70)] + [" " + "ab" * n for n in range(1, 40)]
    pairs = BytePairs(PATH)
    for word in words:
        raw = word.encode("utf-8")
        expected = library.encode(word, add_special_tokens=False).ids
        if len(raw) <= bpe.SHORT_WORD:
            assert pairs._merge_short(raw) == expected, word
        monkeypatch.setattr(bpe, "SHORT_WORD", -1)
        assert pairs.merge(raw) == expected, word
        monkeypatch.undo()


def test_piecewise_library_calls_equal_whole_ones(library, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED_UNITS", 500)
    some = token_files._Library(PATH)
    every = texts()
    for k in range(0, len(every), 50):
        for text, packed in zip(every[k : k + 50], some.encode(every[k : k + 50]), strict=True):
            assert np.frombuffer(packed, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


ROWS = [(5, "b"), (3, None), (3, ""), (None, "no id"), (9, "the end " * 500), (7, "same"), (7, "same"), (-2, "<|endoftext|>")]


def test_round_trip(spark, library):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], SCHEMA + ", ids string").repartition(3)
    found = sorted(map(tuple, round_trip_digests(df, PATH).collect()), key=str)
    sought = []
    for i, text in ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        sought.append((i, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(sought, key=str)
    assert round_trip_digests(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_token_files(spark, library, tmp_path):
    rng = random.Random(2)
    rows = ROWS + [(100 + i, " ".join(rng.choices(["a", "bb", "ccc"], k=rng.randrange(300)))) for i in range(400)]
    rng.shuffle(rows)
    path = str(tmp_path / "tokens")
    write_token_files(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", slice int").repartition(5), path, PATH)
    start, sought = 0, []
    from pyspark.sql import functions as F

    # Rows that repeat an id go by the hash of their text.
    hashed = spark.createDataFrame(rows, SCHEMA).orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    for i, text in map(tuple, hashed.collect()):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        sought.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, read_digests(spark, path).collect()), key=str) == sorted(sought, key=str)
    from conftest import plan_text

    one = read_token_files(spark, path).filter("doc_id = 105")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,105)" in plan_text(one) or "EqualTo(doc_id,105)" in plan_text(one)
    assert one.count() == 1
    import pyarrow.orc as orc

    files = sorted((tmp_path / "tokens").glob("*.orc"))
    assert sum(orc.ORCFile(str(f)).nrows for f in files) == len(rows)


def test_no_documents(spark, tmp_path):
    path = str(tmp_path / "none")
    write_token_files(spark.createDataFrame([], SCHEMA), path, PATH)
    assert read_digests(spark, path).collect() == []
