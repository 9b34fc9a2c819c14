"""Misspelt names, repaired from a dictionary of known ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deletions(text: Column, most: int) -> Column:
    """Hashes of all texts that remain if up to ``most`` characters are deleted, each once.

    Two texts within an edit distance of ``most`` have one in common: delete what the
    edits change, on both sides. A text of n characters has about ``n ** most`` / ``most``! of them.
    """
    variants = F.array(text)
    for _ in range(most):
        shorter = F.transform(
            variants,
            lambda t: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))),
                lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))),
            ),
        )
        variants = F.array_union(variants, F.flatten(shorter))
    return F.array_distinct(F.transform(variants, lambda t: F.xxhash64(t)))


def repair_names(
    df: DataFrame,
    name: str,
    known: DataFrame,
    known_name: str | None = None,
    within: Sequence[str] = (),
    most: int = 2,
) -> DataFrame:
    """The names in ``df`` that ``known`` lacks, with the nearest known ones.

    One row per different name: the ``within`` columns (such as the state, equal on
    both sides), the name, ``repaired``, ``distance`` and ``candidates``. A candidate is a
    known name at the least edit distance, up to ``most`` edits. ``repaired`` is the only
    candidate; of several none is chosen, so ties and names without a candidate keep
    NULL there. NULL names are left out; case counts.

    Names meet on what remains after deletions, not all with all. Each name takes part
    once, however many rows bear it, so no row of ``df`` is copied.
    """
    within = list(within)
    known_name = known_name or name
    names = df.select(*within, F.col(name).alias("_name")).filter("_name is not null").distinct()
    listed = known.select(*within, F.col(known_name).alias("_known")).filter("_known is not null").distinct()
    same = names["_name"].eqNullSafe(listed["_known"])
    for column in within:
        same = same & names[column].eqNullSafe(listed[column])
    unknown = names.join(listed, same, "left_anti")

    # The names are few bytes but have many keys each: spread them over all shuffle
    # partitions before keys are made, so that no single task makes and sorts them all.
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def keyed(table: DataFrame, text: str, prefix: str) -> DataFrame:
        columns = [F.col(c).alias(f"{prefix}{i}") for i, c in enumerate(within)]
        table = table.repartition(spread, text)
        return table.select(*columns, text, F.explode(deletions(F.col(text), most)).alias(f"{prefix}key"))

    left, right = keyed(unknown, "_name", "_a"), keyed(listed, "_known", "_b")
    met = left["_akey"] == right["_bkey"]
    for i in range(len(within)):
        met = met & left[f"_a{i}"].eqNullSafe(right[f"_b{i}"])
    places = [f"_a{i}" for i in range(len(within))]
    pairs = left.join(right, met).select(*places, "_name", "_known").distinct()
    pairs = pairs.withColumn("_distance", F.levenshtein("_name", "_known", most)).filter("_distance >= 0")
    # The candidates of a distance; the least distance of a name wins.
    groups = pairs.groupBy(*places, "_name", "_distance").agg(F.array_sort(F.collect_list("_known")).alias("_found"))
    nearest = groups.groupBy(*places, "_name").agg(
        F.min("_distance").alias("distance"), F.min_by("_found", "_distance").alias("candidates")
    )
    nearest = nearest.withColumnRenamed("_name", "_left")
    same = unknown["_name"] == nearest["_left"]
    for i, column in enumerate(within):
        same = same & unknown[column].eqNullSafe(nearest[f"_a{i}"])
    none = F.array().cast("array<string>")
    return unknown.join(nearest, same, "left").select(
        *within,
        F.col("_name").alias(name),
        F.when(F.size("candidates") == 1, F.get("candidates", F.lit(0))).alias("repaired"),
        "distance",
        F.coalesce("candidates", none).alias("candidates"),
    )


def with_repairs(df: DataFrame, name: str, repairs: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """``df`` with repaired names in place of misspelt ones; all rows stay."""
    chosen = repairs.filter("repaired is not null").select(
        *[F.col(c).alias(f"_r{i}") for i, c in enumerate(within)], F.col(name).alias("_wrong"), F.col("repaired").alias("_right")
    )
    same = df[name] == chosen["_wrong"]
    for i, column in enumerate(within):
        same = same & df[column].eqNullSafe(chosen[f"_r{i}"])
    joined = df.join(chosen, same, "left").withColumn(name, F.coalesce("_right", name))
    return joined.drop("_wrong", "_right", *[f"_r{i}" for i in range(len(within))])
