"""Text repair, transliteration and label pieces."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from landfall.functions.columns import as_column

# What counts as blank at the ends of a field.
BLANKS = " \t\r\n\f\x0b"

# Letters with marks: Latin-1 Supplement to Latin Extended-B, and Latin Extended Additional.
MARKED_LETTERS = [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]

# Letters and signs that do not decompose into a base letter.
WITHOUT_BASE = {
    "Æ": "AE",
    "Ð": "D",
    "Ø": "O",
    "Þ": "Th",
    "ß": "ss",
    "æ": "ae",
    "ð": "d",
    "ø": "o",
    "þ": "th",
    "Đ": "D",
    "đ": "d",
    "Ħ": "H",
    "ħ": "h",
    "ı": "i",
    "Ł": "L",
    "ł": "l",
    "Ŋ": "NG",
    "ŋ": "ng",
    "Œ": "OE",
    "œ": "oe",
    "Ŧ": "T",
    "ŧ": "t",
    "‐": "-",
    "–": "-",
    "—": "--",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "…": "...",
    "\u00a0": " ",
}

COMBINING_MARKS = "".join(map(chr, range(0x0300, 0x0370)))

OUTSIDE_LATIN1 = r"[^\x00-\xff]"
# A character outside Latin-1, or one that would start a UTF-8 sequence and is
# not followed by a continuation. In text that was right, the first letter with
# a mark is already one.
NOT_GARBLED = r"[^\x00-\xbf](?:(?<=[^\x00-\xff])|(?![\x80-\xbf]))"


def _ascii_spelling() -> dict[str, str]:
    """Every covered character with its ASCII spelling."""
    spelling = {}
    for code in MARKED_LETTERS:
        parts = unicodedata.normalize("NFKD", chr(code))
        base = "".join(c for c in parts if not unicodedata.combining(c))
        if base.isascii() and base:
            spelling[chr(code)] = base
    return spelling | WITHOUT_BASE


_SPELLING = _ascii_spelling()
_ONE_TO_ONE = {k: v for k, v in _SPELLING.items() if len(v) == 1}
_ONE_TO_MANY = {k: v for k, v in _SPELLING.items() if len(v) > 1}


def _has_only_ascii(text: Column) -> Column:
    """True if each character takes one byte; much cheaper than a rewrite."""
    return F.char_length(text) == F.octet_length(text)


def _spell_out(text: Column) -> Column:
    spelled = text
    for letter, spelling in _ONE_TO_MANY.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(spelling))
    return F.when(_has_only_ascii(text), text).otherwise(spelled)


def strip_blanks(col) -> Column:
    return F.btrim(as_column(col), F.lit(BLANKS))


def unquote(col) -> Column:
    """Drop blanks, then single quotes, then the blanks inside the quotes.

    A quote doubled within the quotes stands for one.
    """
    inner = strip_blanks(F.btrim(strip_blanks(col), F.lit("'")))
    return F.replace(inner, F.lit("''"), F.lit("'"))


def title_case(col) -> Column:
    """First letter of each word upper case, the rest lower case."""
    return F.initcap(as_column(col))


def part_from_end(parts, n: int) -> Column:
    """The n-th last element, without blanks; NULL if there are fewer."""
    return strip_blanks(F.try_element_at(as_column(parts), F.lit(-n)))


def contains_token(col, token: str) -> Column:
    """Whether the text holds ``token``; false for NULL."""
    return F.coalesce(as_column(col).contains(token), F.lit(False))


def split_compound(col, sep: str = "-") -> tuple[Column, Column]:
    """A compound code such as ``US-KS`` as its head and the whole remainder."""
    text = as_column(col)
    head = F.split_part(text, F.lit(sep), F.lit(1))
    rest = F.substr(text, F.char_length(head) + len(sep) + 1)
    return head, rest


def repair_latin1(col, lossy: bool = False, null_as_empty: bool = False) -> Column:
    """Undo UTF-8 text that was once read as Latin-1 (``Ã³`` for ``ó``).

    By default only text whose bytes really form UTF-8 is changed, hence text
    that was right stays right. ``lossy`` decodes whatever fits in Latin-1 and
    marks each bad byte sequence with U+FFFD.
    """
    text = as_column(col)
    raw = F.encode(text, "ISO-8859-1").cast("string")
    if lossy:
        unfit, repaired = text.rlike(OUTSIDE_LATIN1), F.make_valid_utf8(raw)
    else:
        unfit, repaired = text.rlike(NOT_GARBLED), F.coalesce(F.try_validate_utf8(raw), text)
    result = F.when(_has_only_ascii(text) | unfit, text).otherwise(repaired)
    return F.coalesce(result, F.lit("")) if null_as_empty else result


def to_ascii(col, null_as_empty: bool = False) -> Column:
    """Latin letters with marks and typographic signs as plain ASCII.

    Marks that are characters of their own (U+0300 to U+036F) are dropped.
    Characters of other scripts stay as they are.
    """
    text = as_column(col)
    # Translation drops characters that have no counterpart.
    letters = F.translate(text, "".join(_ONE_TO_ONE) + COMBINING_MARKS, "".join(_ONE_TO_ONE.values()))
    # Few texts still hold a letter that needs more than one character. The
    # one-element array lets both branches share the translated text.
    plain = F.get(F.transform(F.array(letters), _spell_out), 0)
    result = F.when(_has_only_ascii(text), text).otherwise(plain)
    return F.coalesce(result, F.lit("")) if null_as_empty else result


def expand_abbreviations(col, rules: Sequence[tuple[str, str]]) -> Column:
    """Apply (regular expression, replacement) rules in order."""
    text = as_column(col)
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text
