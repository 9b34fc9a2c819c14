from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions import (
    contains_token,
    expand_abbreviations,
    label_of,
    part_from_end,
    percent_of,
    repair_latin1,
    split_compound,
    title_case,
    to_ascii,
    unquote,
)
from landfall.sources import MODE_LABELS

S = T.StringType()
GARBLED = "CorazÃ³n de JesÃºs Airport"


def test_repair(one):
    texts = [GARBLED, "plain", None, "Łódź", "é", "SÃ", "", "Ã©\nÃ¨"]
    assert one(repair_latin1, texts, S) == [
        "Corazón de Jesús Airport", "plain", None, "Łódź", "é", "SÃ", "", "é\nè",
    ]


def test_repair_lossy(one):
    texts = [GARBLED, "plain", None, "Łódź", "é", "SÃ", "Ã©Ã", "â\x82x", "ÿþ"]
    decoded = [t if not t or t == "Łódź" else t.encode("latin-1").decode("utf-8", "replace") for t in texts]
    assert one(lambda c: repair_latin1(c, lossy=True), texts, S) == decoded
    assert one(lambda c: repair_latin1(c, lossy=True, null_as_empty=True), [None, "a"], S) == ["", "a"]


# Letters whose bytes in UTF-8 and Latin-1 make and break each other.
LATIN1 = st.text(st.sampled_from("aé\u00a0\u00bf\u0080\u009f\u00c0\u00c2\u00c3\u00df\u00e0\u00e2\u00ed\u00f0\u00f4\u00f5\u00ff"), max_size=8)
MIXED = st.one_of(LATIN1, st.text(st.sampled_from("aé\u00c3\u00a9Ł東"), max_size=6))


def strict_repair(text):
    try:
        return text.encode("latin-1").decode("utf-8")
    except UnicodeError:
        return text


@settings(max_examples=5, deadline=None)
@given(st.lists(MIXED, min_size=150, max_size=300))
def test_repair_equals_reading_the_bytes(one, texts):
    garbled = [t.encode("utf-8").decode("latin-1") for t in texts]
    assert one(repair_latin1, texts, S) == [strict_repair(t) for t in texts]
    assert one(repair_latin1, garbled, S) == texts


@settings(max_examples=5, deadline=None)
@given(st.lists(LATIN1, min_size=150, max_size=300))
def test_lossy_repair_equals_reading_the_bytes(one, texts):
    expected = [t.encode("latin-1").decode("utf-8", "replace") for t in texts]
    assert one(lambda c: repair_latin1(c, lossy=True), texts, S) == expected


def test_to_ascii(one):
    texts = ["Corazón de Jesús Airport", "Łódź", "Straße", "Ærøskøbing", "Þórshöfn", "São Tomé – “x”…", "Việt", None, "東京"]
    assert one(to_ascii, texts, S) == [
        "Corazon de Jesus Airport", "Lodz", "Strasse", "AEroskobing", "Thorshofn", 'Sao Tome - "x"...', "Viet", None, "東京",
    ]
    assert one(lambda c: to_ascii(c, null_as_empty=True), [None], S) == [""]


def test_title_case_equals_capitalized_words(one):
    names = ["NEW YORK", "winston-salem", "O'HARE field", "McALLEN", "Saint AUGUSTINE", "a  b", "", "É LAN", "3RIVERS x"]
    assert one(title_case, names, S) == [" ".join(w.capitalize() for w in n.split(" ")) for n in names]


def test_unquote(one):
    assert one(unquote, ["'ALC'", " 'ALCAN, AK   '   ", "x", "''", None, "\t'a b'\r", "'INT''L FALLS '"], S) == [
        "ALC", "ALCAN, AK", "x", "", None, "a b", "INT'L FALLS",
    ]


def test_part_from_end(one):
    pieces = [["a", " b ", "c"], ["c"], []]
    assert one(lambda c: part_from_end(c, 2), pieces, T.ArrayType(S)) == ["b", None, None]


def test_contains_token_is_false_for_null(one):
    assert one(lambda c: contains_token(c, "St "), ["St Paul", "West", "East St", None], S) == [
        True, False, False, False,
    ]


def test_split_compound_keeps_the_whole_remainder(one):
    codes = ["US-KS", "BM-U-A", "US", None]
    assert one(lambda c: split_compound(c)[0], codes, S) == ["US", "BM", "US", None]
    assert one(lambda c: split_compound(c)[1], codes, S) == ["KS", "U-A", "", None]


def test_expand_abbreviations_in_order(one):
    rules = [(r"#?\bINTL\b", "International"), (r"#?\bAR?PR?T\b", "Airport"), (r"\bHAMIIN\b", "HAMLIN")]
    labels = ["BOISE #INTL ARPRT", "LABUHA #ARPT", "HAMIIN, ME", "INTLX", None]
    assert one(lambda c: expand_abbreviations(c, rules), labels, S) == [
        "BOISE International Airport", "LABUHA Airport", "HAMLIN, ME", "INTLX", None,
    ]


def test_label_of_fixed_codes(one):
    assert one(lambda c: label_of(c, MODE_LABELS), [1.0, 2.0, 3.0, 9.0, 4.0, None], T.DoubleType()) == [
        "Air", "Sea", "Land", "Not Reported", None, None,
    ]


def test_percent_of(spark):
    rows = spark.sql("values (1, 4), (3, 0), (null, 5), (5, null), (2000000000, 2000000000)").toDF("a", "b")
    got = [r[0] for r in rows.select(percent_of("a", F.col("b"))).collect()]
    assert got == [25.0, None, None, None, 100.0]
