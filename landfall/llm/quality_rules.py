"""Quality rules whose limits follow from the data of each language and source.

Fixed rules drop what is broken anywhere. Beyond them each measure of a document
is held against limits of its language and source: the quartiles of the measure
in that group, widened by a multiple of the distance between them. The quartiles
come from sketches that count documents per logarithmic step of a measure, exact up
to one per cent of its value. Counts add up in any order, so a group of any size
costs some hundred counters a task, and the same data always give the same limits.
The limits of a group are blended with those of its language, and these with the
limits of all documents, from the same counts. The weights follow the numbers of
documents at every size, so no limit jumps as data grow.

Most documents repeat nothing and hold no symbols, so the quartiles of such a measure
are equal. The distance then is the least step of the measure in a document of the
group's median size: one symbol in its characters, one line of its lines, or two
windows of its words. Limits thus are wide where documents are short and close where
they are long. A group reaches beyond the limits of its language, and a language
beyond those of all documents, only as far as the half of its documents on the other
side of the median says alone, so a source with much junk cannot lift its limits past it.

NULL and empty texts have no words and fail. NULL languages and sources form
groups of their own. Repeated rows count as often as they occur. Without a document
that passes the fixed rules there are no limits; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.session import materialize

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words

# Documents of a group whose own limits weigh as much as those above it, widening in
# quartile distances, and the ratio of a sketch's steps.
LEAST_GROUP = 100
WIDENING = 4.0
STEP = 1.02

# Measures judged by the adaptive limits: expression, sides, least distance of the
# quartiles where sizes are unknown, and its least step as a part of which size. Words
# can be too short as well as too long; no symbols, and nothing repeated, is as it should be.
MEASURES = {
    "symbol_share": ("n_symbols / greatest(n_chars, 1)", ("high",), 0.0025, (1, "n_chars")),
    "word_length": ("word_chars / greatest(n_words, 1)", ("low", "high"), 0.1, None),
    "line_repeat": ("n_dup_lines / greatest(n_lines, 1)", ("high",), 0.06, (1, "n_lines")),
    "word_repeat": ("n_repeat_words / greatest(n_words, 1)", ("high",), 0.02, (2 * WINDOW, "n_words")),
}
QUARTILES = {"low": 0.25, "middle": 0.5, "high": 0.75}

BLANK = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]"


def _let(value: Column, body) -> Column:
    """Compute a value once and use it several times in an expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the array, the first occurrence included.

    Windows are compared as texts. Those that recur stand next to each other once
    sorted; the words they cover are summed over the gaps between their starts.
    """
    last = F.size(words) - window
    texts = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice(words, i + 1, window), " ")
    )

    def starts(keyed):
        def recurs(k, j):  # j counts from 0, elements from 1
            before = F.when(j > 0, F.get(keyed, j - 1)["t"] == k["t"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(F.get(keyed, j + 1)["t"] == k["t"], F.lit(False))

        return F.array_sort(F.transform(F.filter(keyed, recurs), lambda k: k["i"]))

    def covered(again):
        return F.aggregate(
            again,
            F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
            lambda a, i: F.struct((i + window).alias("upto"), (a["n"] + i + window - F.greatest(i, a["upto"])).alias("n")),
            lambda a: a["n"],
        )

    def count(found):
        keyed = F.array_sort(F.transform(found, lambda t, i: F.struct(t.alias("t"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(covered(_let(keyed, starts)))

    return F.when(last < 1, 0).otherwise(_let(texts, count)).cast("long")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``lang``, ``source`` and the counts of its whole text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, f"{BLANK}+", -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(WORD))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        text.alias("text"), words.alias("words"), lines.alias("lines"),
    )
    return rows.select(
        "id",
        "lang",
        "source",
        F.char_length("text").cast("long").alias("n_chars"),
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )


def _reach(name: str, sized: bool) -> Column:
    """Limits of a measure from its quartiles: by both, and by the half of the documents on the other side alone."""
    _, _, floor, part = MEASURES[name]
    floor = F.lit(floor)
    if part and sized:
        step, size = part
        floor = step / F.greatest(F.col(f"{size}_middle"), F.lit(1.0))
    low, middle, high = (F.col(f"{name}_{q}") for q in QUARTILES)
    spread = F.greatest(high - low, floor)
    return F.struct(
        (low - WIDENING * spread).alias("low"),
        (high + WIDENING * spread).alias("high"),
        # As far from the median as the limit of a group that is alike on both sides.
        (middle - (WIDENING + 0.5) * F.greatest(2 * (high - middle), floor)).alias("low_alone"),
        (middle + (WIDENING + 0.5) * F.greatest(2 * (middle - low), floor)).alias("high_alone"),
    )


def sketched(rows: DataFrame, names: list[str]) -> DataFrame:
    """Per language, source and measure the number of documents at each step of its value; 0 has a step of its own."""

    def step(name: str) -> Column:
        return F.when(F.col(name) > 0, F.floor(F.log(F.col(name)) / F.log(F.lit(STEP))))

    entries = F.array(*[F.struct(F.lit(name).alias("measure"), step(name).alias("step")) for name in names])
    each = rows.select("lang", "source", F.inline(entries))
    return each.groupBy("lang", "source", "measure", "step").agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, names: list[str], *by: str) -> DataFrame:
    """``docs`` and the quartiles of every measure per group. A measure has some hundred steps, whatever the group."""
    steps = sketch.groupBy(*by, "measure", "step").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*by, "measure")
    steps = steps.withColumns(
        {"upto": F.sum("n").over(whole.orderBy(F.asc_nulls_first("step"))), "docs": F.sum("n").over(whole)}
    )
    value = F.when(F.col("step").isNull(), 0.0).otherwise(F.pow(F.lit(STEP), F.col("step") + 0.5))
    found = [
        F.min(F.when((F.col("measure") == name) & (F.col("upto") >= share * F.col("docs")), value)).alias(f"{name}_{q}")
        for name in names
        for q, share in QUARTILES.items()
    ]
    return steps.groupBy(*by).agg(F.max("docs").alias("docs"), *found)


def _within(own: Column, above: Column, weight: Column) -> Column:
    """Limits of a group, given those of the larger group above it and the weight of its own."""
    low = F.greatest(own["low"], F.least(above["low"], own["low_alone"]))
    high = F.least(own["high"], F.greatest(above["high"], own["high_alone"]))
    return F.struct(
        *[(above[side] + weight * (limit - above[side])).alias(side) for side, limit in (("low", low), ("high", high))]
    )


def group_limits(rows: DataFrame) -> DataFrame:
    """Limits per measure for every language and source (``lang``, ``source``).

    One pass counts the steps of each language and source; those of a language are
    summed, and those of all. Columns with the sizes of documents are used where there.
    """
    names = list(MEASURES)
    sizes = {part[1] for *_, part in MEASURES.values() if part}
    sized = sizes <= set(rows.columns)
    counted = names + (sorted(sizes) if sized else [])
    sketch = materialize(sketched(rows, counted))

    def reaches(tag: str, *by: str) -> DataFrame:
        return quartiles(sketch, counted, *by).select(
            *[F.col(c).alias(f"{c}_{tag}") for c in by],
            F.struct(*[_reach(name, sized).alias(name) for name in names]).alias(f"limits_{tag}"),
            F.col("docs").alias(f"docs_{tag}"),
        )

    def settled(tag: str, above: Column) -> Column:
        # By squares of the counts: half at LEAST_GROUP documents, nine tenths at three times as many.
        docs = F.col(f"docs_{tag}").cast("double")
        weight = docs * docs / (docs * docs + float(LEAST_GROUP) ** 2)
        return F.struct(*[_within(F.col(f"limits_{tag}")[name], above[name], weight).alias(name) for name in names])

    overall = reaches("all").first()["limits_all"]  # one row, of NULLs if there are no documents
    of_all = F.struct(
        *[F.struct(*[F.lit(overall[name][side]).cast("double").alias(side) for side in ("low", "high")]).alias(name) for name in names]
    )
    of_lang = reaches("lang", "lang").withColumn("limits_lang", settled("lang", of_all))
    joined = reaches("own", "lang", "source").join(of_lang, F.col("lang_own").eqNullSafe(F.col("lang_lang")))
    return joined.select(
        F.col("lang_own").alias("lang"), F.col("source_own").alias("source"), settled("own", F.col("limits_lang")).alias("limits")
    )


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, counts, ``base_failed``, and ``kept``."""
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = measured(docs, id_col, text_col).withColumns({name: F.expr(m[0]) for name, m in MEASURES.items()})
    # The counts of a document take some hundred bytes; the texts are read once.
    rows = materialize(rows.withColumn("base_failed", base))
    limits = materialize(group_limits(rows.filter("not base_failed")))
    same = rows["lang"].eqNullSafe(limits["lang"]) & rows["source"].eqNullSafe(limits["source"])
    sides = {
        "low": lambda name: F.col(name) >= F.col("limits")[name]["low"],
        "high": lambda name: F.col(name) <= F.col("limits")[name]["high"],
    }
    within = [F.coalesce(sides[side](name), F.lit(True)) for name, m in MEASURES.items() for side in m[1]]
    verdict = within[0]
    for test in within[1:]:
        verdict = verdict & test
    return rows.join(limits, same, "left").select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & verdict).alias("kept"),
    )
