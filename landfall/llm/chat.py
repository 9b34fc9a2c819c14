"""Chat messages as reply trees, formatted path by path.

Messages name the message they reply to. Paths from root to leaf are enumerated
with iterative self-joins that double the distance each round, so a tree of depth
d takes about log2(d) joins; only ids and scores take part in them. The leaves of
a conversation are ranked by the score of their path, and each chosen path becomes
one text.

Marks stand around every turn and contain ``<`` or ``[``. In texts and roles
these characters, and the ``&`` that spells them, are replaced by entities, so
control strings inside a text never act as marks and every text can be read back.

NULL texts and roles are empty, a NULL turn comes first, rows without a
conversation id form one conversation. Rows that repeat a turn follow each other
by role and text. Messages whose parent is missing are roots; messages that reply
to each other in a circle belong to no tree and are left out. A conversation is
one text, so the largest text that can be made is that of one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.session import materialize

OPEN = {"system": "<<SYS>>", "user": "[INST]", "assistant": "<s>"}
CLOSE = {"system": "<</SYS>>", "user": "[/INST]", "assistant": "</s>"}
TURN = r"(<<SYS>>|\[INST\]|<s>|<role=[^>]*+>)([^<\[]*+)(?:<</SYS>>|\[/INST\]|</s>|</role>)\n"

ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lsqb;"))


def escaped(text: Column) -> Column:
    for char, entity in ENTITIES:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def unescaped(text: Column) -> Column:
    for char, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _key(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def chained_turns(rows: DataFrame) -> DataFrame:
    """Messages of ``conv_id, turn, role, text``, each of which replies to the turn before."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.select(_key("conv_id").alias("conv"), "turn", "role", "text")
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    return rows.select(
        "conv",
        "message",
        F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.lit(0.0).alias("score"),
    )


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Rows ``conv, leaf, message, back`` of the best paths: ``back`` counts the steps up from the leaf.

    ``messages`` has ``conv, message, parent, score``; a path's score is the mean
    of its messages', ties go to the smaller leaf. ``branches`` paths per
    conversation are kept.
    """
    base = materialize(messages.select("conv", "message", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    known = base.select("conv", F.col("message").alias("parent"))
    jump = materialize(
        base.join(known, ["conv", "parent"], "left_semi").select(
            "conv", "message", F.col("parent").alias("up"), F.col("score").alias("gain")
        )
    )
    jumps, total = [], base.count()
    while 1 << len(jumps) <= total and not jump.isEmpty():  # longer jumps are circles
        jumps.append(jump)
        second = jump.select("conv", F.col("message").alias("up"), F.col("up").alias("_up"), F.col("gain").alias("_gain"))
        jump = materialize(
            jump.join(second, ["conv", "up"]).select(
                "conv", "message", F.col("_up").alias("up"), (F.col("gain") + F.col("_gain")).alias("gain")
            )
        )
    replied = base.select("conv", F.col("parent").alias("message"))
    leaves = base.join(replied, ["conv", "message"], "left_anti")
    at = leaves.select(
        "conv", F.col("message").alias("leaf"), F.col("message").alias("at"), F.lit(0).cast("long").alias("depth"), F.lit(0.0).alias("total")
    )
    for k in reversed(range(len(jumps))):
        step = jumps[k].select("conv", F.col("message").alias("at"), "up", "gain")
        at = at.join(step, ["conv", "at"], "left").select(
            "conv",
            "leaf",
            F.coalesce("up", "at").alias("at"),
            (F.col("depth") + F.when(F.col("up").isNotNull(), 1 << k).otherwise(0)).alias("depth"),
            (F.col("total") + F.coalesce("gain", F.lit(0.0))).alias("total"),
        )
    root = base.select("conv", F.col("message").alias("at"), "score")
    scored = at.join(root, ["conv", "at"]).withColumn("mean", (F.col("total") + F.col("score")) / (F.col("depth") + 1))
    best = Window.partitionBy("conv").orderBy(F.desc("mean"), "leaf")
    chosen = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches)
    paths = chosen.select("conv", "leaf", F.col("leaf").alias("message"), F.lit(0).cast("long").alias("back"))
    for k in reversed(range(len(jumps))):
        paths = materialize(paths)
        above = paths.join(jumps[k].select("conv", "message", "up"), ["conv", "message"])
        paths = paths.union(above.select("conv", "leaf", F.col("up").alias("message"), F.col("back") + (1 << k)))
    return paths


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: ``conv``, ``leaf``, the text ``formatted`` and ``loss``, the spans to learn from.

    Loss spans (first and past the last code point) hold what assistants say.
    """
    paths = reply_paths(messages, branches)
    turns = paths.join(messages.select("conv", "message", "role", "text"), ["conv", "message"])
    role = F.col("role")
    opened = F.when(role == "system", OPEN["system"]).when(role == "user", OPEN["user"]).when(role == "assistant", OPEN["assistant"])
    closed = F.when(role == "system", CLOSE["system"]).when(role == "user", CLOSE["user"]).when(role == "assistant", CLOSE["assistant"])
    turns = turns.select(
        "conv",
        "leaf",
        F.struct(
            (-F.col("back")).alias("place"),
            F.coalesce(opened, F.concat(F.lit("<role="), escaped(role), F.lit(">"))).alias("open"),
            escaped(F.col("text")).alias("text"),
            F.concat(F.coalesce(closed, F.lit("</role>")), F.lit("\n")).alias("close"),
            (role == "assistant").alias("learned"),
        ).alias("turn"),
    )
    texts = turns.groupBy("conv", "leaf").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    spans = F.expr("cast(array() as array<struct<lo:bigint,hi:bigint>>)")

    def step(done, turn):
        lo = done["at"] + F.char_length(turn["open"])
        hi = lo + F.char_length(turn["text"])
        span = F.array(F.struct(lo.alias("lo"), hi.alias("hi")))
        return F.struct(
            (hi + F.char_length(turn["close"])).alias("at"),
            F.when(turn["learned"], F.concat(done["out"], span)).otherwise(done["out"]).alias("out"),
        )

    zero = F.struct(F.lit(0).cast("long").alias("at"), spans.alias("out"))
    return texts.select(
        "conv",
        "leaf",
        F.array_join(F.transform("turns", lambda t: F.concat(t["open"], t["text"], t["close"])), "").alias("formatted"),
        F.aggregate("turns", zero, step, lambda done: done["out"]).alias("loss"),
    )


def parsed(text: Column) -> Column:
    """The turns of a formatted text, as structs of ``role`` and ``text``."""
    opened = F.regexp_extract_all(text, F.lit(TURN), F.lit(1))
    said = F.regexp_extract_all(text, F.lit(TURN), F.lit(2))
    role = F.create_map(*[x for name, mark in OPEN.items() for x in (F.lit(mark), F.lit(name))])

    def turn(mark, words):
        other = unescaped(F.substr(mark, F.lit(7), F.length(mark) - 7))
        return F.struct(F.coalesce(F.try_element_at(role, mark), other).alias("role"), unescaped(words).alias("text"))

    return F.zip_with(opened, said, turn)


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Per conversation what its formatted text and its loss mask hold, read back from them."""
    out = formatted(chained_turns(conversations)).select("conv", "formatted", "loss", parsed(F.col("formatted")).alias("turns"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.transform(
        "loss", lambda s: unescaped(F.substr("formatted", (s["lo"] + 1).cast("int"), (s["hi"] - s["lo"]).cast("int")))
    )
    out = out.withColumn("learned", F.array_join(learned, ""))
    return out.select(
        F.when(F.col("conv") != "", F.col("conv").cast("long")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
