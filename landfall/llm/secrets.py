"""Secrets in texts, and weak candidates confirmed by the parts that belong to them.

Strong patterns (an assignment to a secret's name, an access key, a long hex
string) are reported wherever they occur. A credential often comes in parts that
prove little alone: an account name, a random-looking string, an endpoint. Such
weak candidates are reported only if a complementary part lies within the same
scope, that is within ``scope`` code points: a secret needs an identifier or an
endpoint, an identifier or an endpoint needs a secret. Strong spans count as
parts too, an access key as an identifier, the others as secrets.

Parts are joined on the stretches of text their neighbourhoods touch. As parts
have a least length, a stretch holds few of them, whatever the document. Only places
are joined: a long part stands in many stretches, its text stays with its row.

NULL and empty texts hold nothing. Repeated rows each get their spans. An empty table
gives no rows. Only the id and the text are read, so other columns may have any name.
Time is in proportion to the matches in a text, however many one text holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm import spans as S
from landfall.session import materialize

SCOPE = 200

BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("link_id", "link_secret", "link_endpoint")

# The patterns of strong findings, with quantifiers that never go back.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

# Weak candidates. They begin only where a run begins and take all of it, so any length needs one pass.
WEAK_ID = (
    r"(?i)(?<![a-z0-9_])(?:user(?:name)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?|tenant(?:_?id)?)"
    r"""["']?+\x20?+[:=]\x20?+["']?+[A-Za-z0-9@._-]{3,}+"""
)
WEAK_SECRET = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+"
WEAK_ENDPOINT = (
    r"(?i)(?<![a-z0-9])(?:https?|ftps?|ssh|amqps?|redis|postgres(?:ql)?|mysql|mongodb|jdbc:[a-z0-9]++)"
    r"://[A-Za-z0-9.-]{3,}+(?::[0-9]++)?+"
)


def base_spans(text: Column) -> Column:
    """Strong findings of all kinds, in order."""
    lower = F.lower(text)
    named = lower.contains("pass") | lower.contains("secret") | lower.contains("token") | lower.contains("api")
    assigned = F.filter(
        S.spans_of(text, "assign", ASSIGN, named & text.rlike("[:=]")),
        lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= 8,
    )
    access = F.filter(
        S.spans_of(text, "access", ACCESS, text.contains("AKIA")), lambda s: F.length(s["found"]) >= 16
    )
    long_hex = S.spans_of(text, "hex", HEX, text.rlike("[0-9a-f]{32}"))
    return S.ordered(F.concat(assigned, access, long_hex), BASE_KINDS)


def weak_spans(text: Column) -> Column:
    """Weak candidates of all kinds."""
    ids = S.spans_of(text, "link_id", WEAK_ID, text.rlike("[:=]"))
    # Only a text with a digit and a run of 20 characters can hold a random string.
    mixed = text.rlike("[0-9]") & text.rlike("(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20}")
    secrets = S.spans_of(text, "link_secret", WEAK_SECRET, mixed)
    endpoints = S.spans_of(text, "link_endpoint", WEAK_ENDPOINT, text.contains("://"))
    return F.concat(ids, secrets, endpoints)


def find_secrets(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, ``base`` (strong spans) and ``linked`` (confirmed weak spans)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("id"), base_spans(text).alias("base"), weak_spans(text).alias("weak"), S.row_key(id_col, text).alias("key")
    )
    # Spans alone are kept, so the texts are read once.
    found = found.withColumn("weak", S.free_of(F.col("weak"), F.col("base")))
    parts = F.size("weak") > 0
    found = materialize(found.withColumn("key", F.when(parts, F.col("key"))))
    linked = confirmed(found.filter("key is not null"), scope)
    spans = S.ordered(F.transform("linked", lambda i: F.get("weak", i)), (*BASE_KINDS, *WEAK_KINDS))
    return found.join(linked, "key", "left").select(
        F.col("id").alias(id_col), "base", F.coalesce(spans, S.none()).alias("linked")
    )


def confirmed(found: DataFrame, scope: int) -> DataFrame:
    """Per ``key`` the positions, in ``weak``, of the weak spans with a complementary part in scope."""
    part = found.select("key", F.size("base").alias("n"), F.posexplode(F.concat("base", "weak")).alias("i", "s"))
    part = part.select("key", "s.kind", "s.start", "s.end", (F.col("i") - F.col("n")).alias("i")).distinct()
    part = part.select(
        "key", "start", "end", "i", F.col("kind").isin("assign", "hex", "link_secret").alias("secret"),
        F.floor(F.col("start") / scope).alias("low"), F.floor((F.col("end") - 1) / scope).alias("high"),
    )
    # A weak part asks in the stretches it touches and their neighbours; every
    # part stands in all stretches it touches.
    asks = part.filter("i >= 0").withColumn("stretch", F.explode(F.sequence(F.col("low") - 1, F.col("high") + 1)))
    stands = part.withColumn("stretch", F.explode(F.sequence("low", "high")))
    stands = stands.select(*[F.col(c).alias(f"_{c}") for c in ("key", "stretch", "secret", "start", "end")])
    near = (F.col("_start") < F.col("end") + scope) & (F.col("start") < F.col("_end") + scope)
    kept = asks.join(
        stands,
        (F.col("key") == F.col("_key")) & (F.col("stretch") == F.col("_stretch")) & (F.col("secret") != F.col("_secret")) & near,
        "left_semi",
    )
    return kept.groupBy("key").agg(F.collect_set("i").alias("linked"))


def secret_digests(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the strong spans, and all spans as text."""
    found = find_secrets(docs, id_col=id_col)
    return found.select(
        id_col,
        *[S.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(S.spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        S.spelled(S.ordered(F.concat("base", "linked"), (*BASE_KINDS, *WEAK_KINDS))).alias("spans"),
    )
