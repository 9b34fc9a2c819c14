"""Spans of pattern matches in texts, with built-in functions only.

A span is a struct of ``kind``, ``start`` and ``end`` in code points, the end
exclusive, and the matched ``found`` text. Patterns are written so that no
quantifier needs more than one pass or a deep stack, however long a text is, and
no step takes time with the square of the matches in one text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:bigint,end:bigint,found:string>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"

# Values of a block of a running sum, and code points of a piece of text.
BLOCK = 512
PIECE = 256


def none() -> Column:
    return F.expr(NO_SPANS)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Per position the combination of all values up to it: running sums, for example.

    ``values`` are non-negative longs and ``combine`` is associative with 0 as its
    neutral element. Growing an array copies it, so arrays grow within blocks only:
    the blocks' totals are combined first, then each block starts from its own. Blocks
    of blocks would copy still less, but Spark prepares nested functions anew in every
    task, which costs more.
    """
    nothing = F.expr("cast(array() as array<bigint>)")
    zero = F.lit(0).cast("long")

    def within(block, base):
        def step(done, value):
            at = combine(done["at"], value)
            return F.struct(at.alias("at"), F.concat(done["out"], F.array(at)).alias("out"))

        return F.aggregate(block, F.struct(base.alias("at"), nothing.alias("out")), step, lambda done: done["out"])

    def blockwise(all_values):
        first = F.sequence(F.lit(1), F.greatest(F.size(all_values), F.lit(1)), F.lit(BLOCK))
        block = lambda i: F.slice(all_values, i, F.lit(BLOCK))
        totals = F.transform(first, lambda i: F.aggregate(block(i), zero, lambda total, value: combine(total, value)))
        bases = F.slice(F.concat(F.array(zero), within(totals, zero)), F.lit(1), F.size(first))
        return F.flatten(F.zip_with(first, bases, lambda i, base: within(block(i), base)))

    return let(values, blockwise)


def spans_of(text: Column, kind: str, pattern: str, where: Column | None = None) -> Column:
    """All leftmost, non-overlapping matches of a pattern as an array of spans in their order.

    The pieces between matches and the matches are laid end to end, which gives
    each match's place. ``where`` is a cheap test that any match requires.
    """

    def placed(matches):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        sizes = F.zip_with(gaps, matches, lambda gap, found: (F.char_length(gap) + F.char_length(found)).cast("long"))
        ends = running(sizes, lambda a, b: a + b)
        return F.zip_with(
            matches,
            ends,
            lambda found, end: F.struct(
                F.lit(kind).alias("kind"), (end - F.char_length(found)).alias("start"), end.alias("end"), found.alias("found")
            ),
        )

    found = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda matches: F.when(F.size(matches) > 0, placed(matches)).otherwise(none()),
    )
    return found if where is None else F.when(where, found).otherwise(none())


def pieces_of(text: Column) -> Column:
    """The text cut every ``PIECE`` code points.

    Finding a place in a text takes a walk from its beginning; in an array of
    pieces it does not. :func:`cut` reads from them.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}+"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to before ``end`` of a text given by its pieces, or to its end."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((end - 1) / PIECE).cast("int")
    some = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
    inside = F.substr(some, (start - first * PIECE + 1).cast("int"), (end - start).cast("int"))
    return F.when(end > start, inside).otherwise("")


def ordered(spans: Column, kinds: Sequence[str]) -> Column:
    """Spans by start, then in the order of ``kinds``, then by end."""
    place = F.create_map(*[x for k, kind in enumerate(kinds) for x in (F.lit(kind), F.lit(k))])
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("a"), place[s["kind"]].alias("b"), s["end"].alias("c"), s.alias("s"))
    )
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def free_of(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others, by their ends.

    All others that begin before a span's end are met before it in one sorted
    array; it overlaps one of them if the largest end so far lies past its start.
    """

    def kept(events):
        reach = running(F.transform(events, lambda e: F.when(e["other"] == 1, e["span"]["end"]).otherwise(0)), F.greatest)
        judged = F.zip_with(
            events, reach, lambda e, r: F.struct(((e["other"] == 0) & (r <= e["span"]["start"])).alias("free"), e["span"].alias("span"))
        )
        return F.transform(F.filter(judged, lambda j: j["free"]), lambda j: j["span"])

    def event(at: str, other: int):
        return lambda s: F.struct(s[at].alias("at"), F.lit(other).alias("other"), s.alias("span"))

    events = F.array_sort(F.concat(F.transform(spans, event("end", 0)), F.transform(others, event("start", 1))))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), let(events, kept)).otherwise(spans)


def row_key(id_col: str, text: Column) -> Column:
    """A key of equal rows: id and digest of the text. Rows without an id have one too."""
    return F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.sha2(text.cast("binary"), 256))
