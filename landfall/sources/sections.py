"""Sections of one large file of code dictionaries.

The delivered file holds all dictionaries one after the other: a line such as
``value $name`` opens one, entries follow, and a semicolon closes it. Which section
a line belongs to depends on lines that may lie in other splits of the file. Each
split finds the sections that open within it, one row per split tells how it ends,
and the splits' ends are handed on in the order of the file. No task reads more
than its splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The wording that opens a section.
OPENS = r"(?i)^\s*value\s+\$?\s*([A-Za-z_][A-Za-z0-9_]*)\s*(.*)$"

# A quoted text, in which semicolons and comments mean nothing.
_QUOTED = r"'[^']*'|\"[^\"]*\""

# Quoted texts are kept; a comment goes, up to the end of the line if it ends later.
_COMMENTS = rf"({_QUOTED})|/\*.*?(?:\*/|$)"
_BEFORE_END = rf"^((?:[^;'\"]|{_QUOTED}|['\"])*+);"

CLOSED = ""


def _last_mark(df: DataFrame, mark: str, name: str, *order: str) -> DataFrame:
    """The last ``mark`` that is not NULL, within the split up to and including the line."""
    upto = Window.partitionBy("_file", "_start").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(mark, ignorenulls=True).over(upto))


def _carried(df: DataFrame, mark: str, name: str, across_files: bool) -> DataFrame:
    """Add the state that earlier splits hand on to each split.

    The window at the end has one row per split of the input.
    """
    ends = df.groupBy("_file", "_start").agg(F.max_by(mark, F.when(F.col(mark).isNotNull(), F.col("_at"))).alias("_end"))
    splits = Window.orderBy("_file", "_start") if across_files else Window.partitionBy("_file").orderBy("_start")
    earlier = splits.rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(
        F.col("_file").alias("_f"), F.col("_start").alias("_s"), F.last("_end", ignorenulls=True).over(earlier).alias(name)
    )
    same = (df["_file"] == handed["_f"]) & (df["_start"] == handed["_s"])
    return df.join(handed, same, "left").drop("_f", "_s")


def read_label_sections(spark: SparkSession, path: str, across_files: bool = False) -> DataFrame:
    """Entries of all sections of a label file: ``section`` (in lower case) and ``value``, the line.

    Comments, the lines that open a section, the semicolon that closes it, lines
    outside sections and empty lines are left out. An entry may stand on the line
    that opens or closes its section. Where a section opens before the last one is
    closed, it ends there. Of several files each stands alone; ``across_files``
    takes them as pieces of one, in the order of their names.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        # Increases along each split.
        F.monotonically_increasing_id().alias("_at"),
    )
    # A comment may begin on one line and end on another.
    plain = F.regexp_replace("value", _QUOTED, "")
    ends = F.instr(plain, "*/") > 0
    comment = F.when(plain.rlike(r"/\*(?!.*\*/)"), True).when(ends, False)
    lines = _last_mark(lines.withColumn("_mark", comment), "_mark", "_inside", "_at")
    lines = _carried(lines, "_mark", "_handed", across_files)
    before = Window.partitionBy("_file", "_start").orderBy("_at")
    inside = F.coalesce(F.lag("_inside").over(before), F.col("_handed"), F.lit(False))
    rest = F.when(ends, F.regexp_replace("value", r"^.*?\*/", "")).otherwise("")
    text = F.regexp_replace(F.when(inside, rest).otherwise(F.col("value")), _COMMENTS, "$1")
    lines = lines.withColumn("_text", text).drop("value", "_mark", "_inside", "_handed")

    # Entries on the line that opens a section follow its name; a semicolon closes what is open.
    name = F.nullif(F.lower(F.regexp_extract("_text", OPENS, 1)), F.lit(""))
    lines = lines.withColumn("_name", name).withColumn(
        "_text", F.when(F.col("_name").isNotNull(), F.regexp_extract("_text", OPENS, 2)).otherwise(F.col("_text"))
    )
    closes = F.instr(F.regexp_replace("_text", _QUOTED, ""), ";") > 0
    lines = lines.withColumns(
        {
            "_text": F.when(closes, F.regexp_extract("_text", _BEFORE_END, 1)).otherwise(F.col("_text")),
            "_mark": F.when(closes, CLOSED).otherwise(F.col("_name")),
        }
    )
    lines = _last_mark(lines, "_mark", "_state", "_at")
    lines = _carried(lines, "_mark", "_handed", across_files)
    section = F.coalesce("_name", F.lag("_state").over(before), F.col("_handed"))
    entries = lines.withColumn("section", section).filter(F.col("section") != CLOSED)
    return entries.select("section", F.col("_text").alias("value")).filter(F.trim("value") != "")
