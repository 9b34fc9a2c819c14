"""One label file with several sections, read in splits of any size."""

import random

import pytest
from conftest import plan_text

from landfall.sources import read_label_sections

TEXT = """libname library 'anywhere' ;
proc format library=library ;

/* YEAR - 4 digits; value nothing */
/* A comment over
   value inside 'x' = 'not an entry' ;
   two lines */
  value people
   1 = 'One; with a semicolon'   /* note */
   2 = 'Two /* no comment */'
   'A B'\t=\t'it''s'   ;
  outside = 'left out'
value $Ports
   'ALC'\t=\t'ALCAN, AK   '
   'ORD' = 'O'HARE, IL'

   'HOM' = 'HOMER, AK' /* begins here
   'NOT' = 'AN ENTRY'
   ends here */ 'NEW' = 'NEWPORT, VT'
;
value short 1 = 'Air' 2 = 'Sea' ;
value open
   9 = 'Not reported'
value last
   7 = 'Seven'
run ;
   8 = 'outside'
"""


def plain(text):
    """The same, character by character."""
    found, section, comment = [], None, False
    for line in text.splitlines():
        out, i, quote, closed = "", 0, None, False
        while i < len(line):
            two = line[i : i + 2]
            if comment:
                if two == "*/":
                    comment, i = False, i + 1
            elif quote is None and two == "/*":
                comment, i = True, i + 1
            else:
                c = line[i]
                if quote is None and c in "'\"" and c in line[i + 1 :]:
                    quote = c
                elif c == quote:
                    quote = None
                elif c == ";" and quote is None:
                    closed = True
                    break
                out += c
            i += 1
        words = out.split(None, 2)
        if words[:1] == ["value"]:
            section = words[1].lstrip("$").lower()
            out = words[2] if len(words) > 2 else ""
        if section is not None and out.strip():
            found.append((section, out.strip()))
        if closed:
            section = None
    return found


def found(df):
    return [(r.section, r.value.strip()) for r in df.collect()]


@pytest.mark.parametrize("size", [40, 100, 1 << 20])
def test_sections_across_splits(spark, tmp_path, size):
    assert plain(TEXT)[:2] == [("people", "1 = 'One; with a semicolon'"), ("people", "2 = 'Two /* no comment */'")]
    path = tmp_path / "labels.sas"
    path.write_text(TEXT, newline="\r\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        df = read_label_sections(spark, str(path))
        assert sorted(found(df)) == sorted(plain(TEXT))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_long_sections_in_many_splits(spark, tmp_path):
    """Sections longer than a split, and splits with many sections."""
    rng = random.Random(4)
    lines = []
    for k in range(60):
        lines.append(f"value ${'abc'[k % 3]}{k}")
        lines += [f"  '{k}-{i}' = 'label; {i}'" for i in range(rng.choice((0, 1, 2, 200)))]
        lines.append(rng.choice((";", "", "/* a", ";")))
        if lines[-1] == "/* a":
            lines += ["value no"] * rng.choice((1, 150)) + ["*/"]
    text = "\n".join(lines) + "\n"
    (tmp_path / "labels.txt").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        assert sorted(found(read_label_sections(spark, str(tmp_path)))) == sorted(plain(text))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_several_files(spark, tmp_path):
    """Files stand alone, or continue each other in the order of their names."""
    lines = TEXT.splitlines(keepends=True)
    for k in range(0, len(lines), 3):
        (tmp_path / f"part-{k:03}").write_text("".join(lines[k : k + 3]))
    whole = read_label_sections(spark, str(tmp_path), across_files=True)
    assert sorted(found(whole)) == sorted(plain(TEXT))
    alone = read_label_sections(spark, str(tmp_path))
    assert sorted(found(alone)) == sorted(e for k in range(0, len(lines), 3) for e in plain("".join(lines[k : k + 3])))
    assert "Python" not in plan_text(whole)


def test_no_sections(spark, tmp_path):
    (tmp_path / "labels").write_text("no section here\n;\n")
    assert found(read_label_sections(spark, str(tmp_path))) == []
    (tmp_path / "labels").write_text("")
    assert found(read_label_sections(spark, str(tmp_path))) == []
