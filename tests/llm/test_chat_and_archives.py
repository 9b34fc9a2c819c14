"""Reply trees and chat texts, and WARC archives, against plain Python."""

import gzip
import hashlib
import random
import re

import pytest

from landfall.llm import chat, warc
from landfall.llm.chat import chat_digests, formatted, reply_paths

ROWS = "conv_id long, turn long, role string, text string"


def turns():
    rng = random.Random(12)
    bits = ["</s>", "[INST]", "[/INST]", "&lt;", "&amp;lt;", "&", "<role=x>", "]", ">", "\n", "é😀", "word ", "<<SYS>>", "&lsqb;", " ", "$1\\"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(("system", "user", "assistant", "tool", "", None, "a<b>&[c]"))
            rows.append((conv, turn, role, "".join(rng.choices(bits, k=rng.randrange(12)))))
    rows += [(100, 0, "user", None), (101, None, "assistant", "x"), (None, 1, "user", "y"), (None, 0, "assistant", "z")]
    rows += [(102, 1, "user", "same"), (102, 1, "user", "same"), (102, 0, "assistant", "first"), (103, 0, "assistant", "long " * 50_000)]
    return rows + [(104, k, ("user", "assistant")[k % 2], f"turn {k}") for k in range(150)]


def test_round_trip(spark):
    rows = turns()
    df = spark.createDataFrame([(*r, 1) for r in rows], ROWS + ", conv int").repartition(4)
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    sought = []
    for conv, some in convs.items():
        some.sort()
        said = "".join(f"{role}\n{text}\n" for *_, role, _, text in some)
        learned = "".join(text for *_, role, _, text in some if role == "assistant")
        sought.append((conv, len(some), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    assert sorted((tuple(r)[:5] for r in chat_digests(df).collect()), key=str) == sorted(sought, key=str)


def test_control_strings_stand_only_around_turns(spark):
    rows = turns()
    for r in formatted(chat.chained_turns(spark.createDataFrame(rows, ROWS))).collect():
        inner = re.sub(chat.TURN.replace("*+", "*"), "", r.formatted)
        assert inner == ""
        assert all(r.formatted[s.lo - 3 : s.lo] == "<s>" and r.formatted[s.hi : s.hi + 4] == "</s>" for s in r.loss)


def trees(seed=2):
    rng = random.Random(seed)
    rows = []
    for conv in ("a", "b", "c"):
        for m in range(rng.randrange(20, 60)):
            parent = None if m == 0 or rng.random() < 0.03 else rng.randrange(max(0, m - 6), m)
            rows.append((conv, m, parent, "user" if m % 2 else "assistant", f"t{m}", float(rng.randrange(9))))
    rows += [("d", 0, 99, "user", "orphan", 1.0)]
    rows += [("e", 0, 1, "user", "circle", 1.0), ("e", 1, 0, "user", "circle", 1.0)]
    return rows


@pytest.mark.parametrize("branches", [1, 3])
def test_paths_equal_a_walk(spark, branches):
    rows = trees()
    df = spark.createDataFrame(rows, "conv string, message long, parent long, role string, text string, score double")
    found = {}
    for r in reply_paths(df, branches).collect():
        found.setdefault((r.conv, r.leaf), []).append((r.back, r.message))
    found = {k: [m for _, m in sorted(v)] for k, v in found.items()}
    sought = {}
    for conv in "abcd":
        own = {m: (parent, score) for c, m, parent, _, _, score in rows if c == conv}
        leaves = []
        for leaf in own.keys() - {p for p, _ in own.values()}:
            path = [leaf]
            while own[path[-1]][0] in own:
                path.append(own[path[-1]][0])
            leaves.append((-sum(own[m][1] for m in path) / len(path), leaf, path))
        for _, leaf, path in sorted(leaves)[:branches]:
            sought[conv, leaf] = path
    assert found == sought


def test_no_conversations(spark):
    assert chat_digests(spark.createDataFrame([], ROWS)).collect() == []


# Archives

PAGES = "page_id long, url string, html string"


def pages():
    rng = random.Random(3)
    bits = ["\r\n", "\r", "\n", "WARC/1.1\r\n", "<p>", "é", "😀", "text ", "\r\n\r\n", "Content-Length: 5\r\n", "\x00"]
    rows = [(i, f"http://x/{i}\r\nX: y", "".join(rng.choices(bits, k=rng.randrange(60)))) for i in range(200)]
    same = "shared \r\n payload " * 20
    rows += [(1000 + i, "u", same) for i in range(30)] + [(900, None, same), (900, None, same)]
    rows += [(300, "u", None), (301, "u", ""), (302, "u", "short"), (303, "u", "short"), (None, "u", same), (None, "u", "alone " * 50)]
    return rows + [(400, "u", "\r" * 500), (401, "u", "\r\n" * 500), (402, "u", "é" * 3000), (403, "u", "x\r"), (404, "u", "x\r\n")]


def expected(rows):
    first = {}
    for number, _, html in rows:
        if number is not None:
            first[html or ""] = min(number, first.get(html or "", number))
    out = []
    for number, _, html in rows:
        data = (html or "").encode()
        to = first.get(html or "") if len(data) >= 100 else None
        to = None if to == number else to
        out.append((number, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [1 << 20, 64, 7])
def test_archives(spark, tmp_path, chunk):
    rows = pages()
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame([(*r, 1) for r in rows], PAGES + ", digest int").repartition(3), path, chunk)
    assert sorted(map(tuple, warc.read_archives(spark, path).collect()), key=str) == expected(rows)


def test_files_are_plain_warc(spark, tmp_path):
    """A reader that knows only record lengths finds every payload."""
    rows = pages()
    path = tmp_path / "warc"
    warc.write_archives(spark.createDataFrame(rows, PAGES), str(path), 64)
    found = []
    for file in path.glob("*.gz"):
        data, at = gzip.decompress(file.read_bytes()), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
            assert data[at : at + 10] == b"WARC/1.1\r\n"
            size = int(head["Content-Length"])
            payload = data[end + 4 : end + 4 + size]
            at = end + 4 + size + 4
            assert data[at - 4 : at] == b"\r\n\r\n"
            if head["WARC-Type"] == "continuation":
                found[-1] += payload
            elif head["WARC-Type"] == "response":
                found.append(payload)
    assert sorted(found) == sorted((r[2] or "").encode() for r in rows if responses(rows, r))


def responses(rows, row):
    data = (row[2] or "").encode()
    ids = [r[0] for r in rows if r[2] == row[2] and r[0] is not None]
    return len(data) < 100 or not ids or row[0] == min(ids)


def test_chunk_table(spark):
    rows = [(1, "u", "é" * 100), (2, "u", "")]
    chunks = warc.record_chunks(warc.page_roles(spark.createDataFrame(rows, PAGES)), 33).orderBy("page_id", "chunk").collect()
    own = [c for c in chunks if c.page_id == 1]
    assert b"".join(bytes(c.bytes) for c in own).decode() == "é" * 100 and all(len(c.bytes) <= 33 for c in own)
    whole = b""
    for c in own:
        whole += bytes(c.bytes)
        assert c.running == hashlib.sha256(whole).hexdigest()
    assert [c.last for c in own] == [False] * (len(own) - 1) + [True]


def test_damage_is_noticed(spark, tmp_path):
    path = tmp_path / "warc"
    warc.write_archives(spark.createDataFrame([(1, "u", "some payload " * 20)], PAGES), str(path))
    file = next(f for f in sorted(path.glob("*.gz")) if b"some payload" in gzip.decompress(f.read_bytes()))
    data = gzip.decompress(file.read_bytes()).replace(b"some payload", b"s0me payload", 1)
    file.write_bytes(gzip.compress(data))
    (path / f".{file.name}.crc").unlink()
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archives(spark, str(path)).collect()


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path).collect() == []
