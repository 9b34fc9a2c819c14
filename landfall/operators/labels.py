"""Parsing of code dictionaries, where each line reads ``'code' = 'label'``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions.text import part_from_end, unquote

EQUALS = r"\s*=\s*"

# Wordings of dictionary entries that stand for no place.
COLLAPSED_INTO = r"(?i)^collapsed\s*(?:\(|into\s+)([^),]+)"
NO_CODE = r"(?i)^(?:no\s+(?:port|country)\s+code\b|collapsed\b)"


# A longer chain of successors is an error.
LONGEST_CHAIN = 100_000


def split_dictionary(lines: DataFrame, fields: Sequence[str], sep: str = EQUALS) -> DataFrame:
    """Cut each line of ``value`` at ``sep`` into unquoted fields, first to last.

    Column ``problem`` tells why a line is no entry, and is NULL otherwise.
    """
    pieces = F.split("value", sep, len(fields))
    columns = [unquote(F.get(F.col("_pieces"), i)).alias(f) for i, f in enumerate(fields)]
    problem = F.when(F.size("_pieces") < len(fields), "no separator")
    return lines.withColumn("_pieces", pieces).select("value", *columns, problem.alias("problem"))


def flag_withdrawn(entries: DataFrame, label: str) -> DataFrame:
    """Report labels that say the code is collapsed or was never given."""
    known = F.col("problem")
    return entries.withColumn(
        "problem", F.when(known.isNull() & F.col(label).rlike(NO_CODE), "withdrawn").otherwise(known)
    )


def place_parts(entries: DataFrame, label: str, tail: Sequence[str], facility: str) -> DataFrame:
    """Read a comma-separated place from its end.

    ``tail`` names the last parts in reading order. Exactly one part more is
    the ``facility``, which otherwise is empty text. A label with still more
    parts is kept but reported in ``problem``; one with fewer is no place, nor
    is one that says the code has been withdrawn.
    """
    depth = len(tail)
    parts = F.col("_parts")
    columns = {name: part_from_end(parts, depth - i) for i, name in enumerate(tail)}
    columns[facility] = F.when(F.size(parts) == depth + 1, part_from_end(parts, depth + 1)).otherwise("")
    problem = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.size(parts) < depth, "too few parts")
        .when(F.size(parts) > depth + 1, "too many parts")
    )
    return (
        flag_withdrawn(entries, label)
        .withColumn("_parts", F.split(label, ","))
        .withColumns({**columns, "problem": problem})
        .drop("_parts")
    )


def accepted(entries: DataFrame) -> DataFrame:
    """Usable entries; a label with too many parts is usable."""
    return entries.filter("problem is null or problem = 'too many parts'").drop("problem")


def rejected(entries: DataFrame) -> DataFrame:
    """Entries to look at, with the reason."""
    return entries.filter("problem is not null")


def follow_successors(pairs: DataFrame, code: str = "code", target: str = "target") -> DataFrame:
    """The last successor of each code, over any number of steps.

    ``pairs`` names for each code the one that replaces it. The result has one row
    per code: ``code``, ``target`` and ``circular``, true where the steps come back
    to a code of their own and never end; ``target`` then is the first successor. Of
    several successors of a code the smallest counts.

    One recursive query walks back from the codes whose successor has none itself, so
    it meets each code once, and a circle never. It runs with the query that uses it:
    nothing runs while the plan is made. Each step is a job of its own, which suits
    the short chains of dictionaries.
    """
    start = pairs.groupBy(F.col(code).alias("code")).agg(F.min(target).alias("target")).filter("code is not null")
    ended = pairs.sparkSession.sql(
        f"""
        with recursive ended(code, target) max recursion level {LONGEST_CHAIN} as (
            select s.code, s.target from {{start}} s left anti join {{start}} t on s.target = t.code
            union all
            select s.code, e.target from {{start}} s join ended e on s.target = e.code
        ) select code as _code, target as _last from ended
        """,
        start=start,
    )
    found = start.join(ended, start["code"] == ended["_code"], "left")
    return found.select(
        F.col("code").alias(code),
        F.when(F.col("_code").isNull(), F.col("target")).otherwise(F.col("_last")).alias(target),
        F.col("_code").isNull().alias("circular"),
    )


def successor(label: str) -> Column:
    """The code named by a label such as ``Collapsed (XXX)`` or ``Collapsed into XXX``, else NULL."""
    return F.nullif(F.regexp_extract(label, COLLAPSED_INTO, 1), F.lit(""))


def redirect_codes(entries: DataFrame, code: str, label: str) -> DataFrame:
    """Give a code whose label reads ``Collapsed (XXX)`` the label of code XXX.

    ``Collapsed into XXX, ...`` means the same, and XXX may be collapsed itself,
    any number of times. Adds ``target``, the code whose label is used, and drops
    codes that are withdrawn without a successor. A target that is unknown, or a
    chain that never ends, leaves the label NULL; ``circular`` tells the latter.
    """
    next_code = successor(label)
    collapsed = entries.filter(next_code.isNotNull()).select(F.col(code).alias("_from"), next_code.alias("_to"))
    last = follow_successors(collapsed, "_from", "_to")
    valid = entries.filter(~F.col(label).rlike(NO_CODE)).select(
        F.col(code).alias("_code"), F.col(label).alias("_label")
    )
    kept = entries.filter(next_code.isNotNull() | ~F.col(label).rlike(NO_CODE))
    moved = kept.join(last, kept[code] == last["_from"], "left").withColumns(
        {"target": F.coalesce("_to", code), "circular": F.coalesce("circular", F.lit(False))}
    )
    return (
        moved.join(valid, F.col("target") == valid["_code"], "left")
        .withColumn(label, F.col("_label"))
        .drop("_code", "_label", "_from", "_to")
    )
