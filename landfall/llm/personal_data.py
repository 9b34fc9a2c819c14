"""Personal data in texts by weak supervision.

Strict patterns find base spans, which are always reported. Looser patterns find
candidates: written-out mail addresses, national phone numbers, social security
and bank account numbers, titled names. Three labelers vote on every span: one
checks its format, one looks parts of it up in gazetteers, one reads the words
around it. Expectation maximisation over the counts of vote patterns estimates how
reliable each labeler is and how likely each pattern marks personal data; these
probabilities train a classifier over features of the span, which decides on the
candidates.

Votes and features take few values, so their counts are a table of bounded size
whatever the corpus; only that table reaches the driver.

NULL and empty texts hold nothing. Repeated rows each get their spans and count as
often as they occur. Without any span there is no model and nothing is added.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm import spans as S
from landfall.session import materialize

BASE_KINDS = ("email", "ip", "card", "phone")
WEAK_KINDS = ("weak_email", "weak_phone", "ssn", "iban", "person")
KINDS = BASE_KINDS + WEAK_KINDS

# The strict patterns, with quantifiers that never go back. A match
# may only begin where a run begins or the match before has ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

WEAK_EMAIL = (
    r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++(?:\x20?[\[({]at[\])}]\x20?|\x20at\x20)[a-z0-9-]{2,}+"
    r"(?:(?:\x20?[\[({]dot[\])}]\x20?|\x20dot\x20)[a-z0-9-]{2,}+)++"
)
WEAK_PHONE = r"(?<![0-9.+-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9.-])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
PERSON = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.\x20[A-Z][a-z]++(?:\x20[A-Z][a-z]++)*+"

# Gazetteers; callers may pass larger ones to the functions below.
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "info", "biz", "us", "ca")
FIRST_NAMES = ("anna", "carlos", "david", "emma", "george", "hans", "james", "jean", "john", "juan", "laura", "linda",
               "maria", "marie", "mary", "michael", "paul", "peter", "robert", "sarah", "thomas")
COUNTRIES = ("AT", "BE", "CH", "DE", "DK", "ES", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")

# Words that speak for and against personal data next to a span.
FOR = r"(?i)\b(?:e-?mail|mail|contact|call|phone|tel|mobile|fax|card|visa|credit|paid|ssn|social|iban|account|dear|name|login|reach)\b"
AGAINST = r"(?i)\b(?:version|isbn|issn|order|invoice|serial|part|model|page|figure|section|example|sample)\b"
CONTEXT = 30

ROUNDS = 60
THRESHOLD = 0.5


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: from the right, every second digit counts double."""
    place = F.sequence(F.lit(1), F.length(digits))
    value = F.aggregate(
        place,
        F.lit(0),
        lambda total, i: total
        + F.when((F.length(digits) - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
            (F.substring(digits, i, F.lit(1)).cast("int") * 2) % 10 + F.floor(F.substring(digits, i, F.lit(1)).cast("int") / 5).cast("int")
        ),
    )
    return value % 10 == 0


def base_spans(text: Column) -> Column:
    """Strict findings of all kinds, in order."""
    digit = text.rlike("[0-9]")
    email = S.spans_of(text, "email", EMAIL, text.contains("@"))
    ip = F.filter(
        S.spans_of(text, "ip", IP, digit & text.rlike(r"[0-9]\.[0-9]")),
        lambda s: F.forall(F.split(s["found"], r"\."), lambda part: part.try_cast("double") <= 255),
    )
    card = F.filter(
        S.spans_of(text, "card", CARD, digit & text.rlike(r"(?:[0-9][\x20-]?){11}[0-9]")),
        lambda s: F.when(F.length(_digits(s["found"])).between(12, 19), _luhn(_digits(s["found"]))).otherwise(False),
    )
    phone = F.filter(
        S.spans_of(text, "phone", PHONE, digit & text.contains("+")),
        lambda s: F.length(_digits(s["found"])).between(9, 15),
    )
    return S.ordered(F.concat(email, ip, card, phone), BASE_KINDS)


def candidate_spans(text: Column) -> Column:
    """Findings of the looser patterns."""
    number = text.rlike(r"[0-9]{3}[.\x20)-]\x20?[0-9]")
    return F.concat(
        S.spans_of(text, "weak_email", WEAK_EMAIL, text.rlike(r"(?i)[\[({]at[\])}]|\x20dot\x20|[\[({]dot[\])}]")),
        S.spans_of(text, "weak_phone", WEAK_PHONE, number),
        S.spans_of(text, "ssn", SSN, text.rlike("[0-9]-[0-9]{2}-[0-9]")),
        S.spans_of(text, "iban", IBAN, text.rlike("[A-Z]{2}[0-9]{2}")),
        S.spans_of(text, "person", PERSON, text.rlike(r"(?:Mr|Mrs|Ms|Dr|Prof)\.\x20[A-Z]")),
    )


def _vote(yes: Column, no: Column) -> Column:
    """1 for, 0 against, -1 for none."""
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _any_of(kind: Column, *kinds: str) -> Column:
    return kind.isin(*kinds)


def described(spans: Column, pieces: Column) -> Column:
    """Spans of a text in pieces with the votes of the three labelers and their features, all small integers."""

    def around(s):
        before = S.cut(pieces, F.greatest(s["start"] - CONTEXT, F.lit(0)), s["start"])
        return F.struct(s.alias("s"), before.alias("before"), S.cut(pieces, s["end"], s["end"] + CONTEXT).alias("after"))

    def one(near):
        s, before, after = near["s"], near["before"], near["after"]
        kind, found, digits = s["kind"], s["found"], _digits(s["found"])
        area = digits.substr(1, 3)
        right = (
            _any_of(kind, *BASE_KINDS)
            | ((kind == "weak_phone") & area.rlike("^[2-9]"))
            | ((kind == "ssn") & ~area.rlike("^(?:000|666|9..)$"))
            | ((kind == "weak_email") & found.rlike(r"(?i)[\[({]"))
            | ((kind == "iban") & F.length(F.regexp_replace(found, " ", "")).between(15, 34))
        )
        listed = (
            (_any_of(kind, "email", "weak_email") & F.lower(F.regexp_extract(found, "([A-Za-z]+)$", 1)).isin(*TOP_DOMAINS))
            | ((kind == "card") & digits.rlike("^(?:4|5[1-5]|3[47]|6011|65|2[2-7])"))
            | ((kind == "iban") & found.substr(1, 2).isin(*COUNTRIES))
            | ((kind == "person") & F.lower(F.regexp_extract(found, r"\.\x20([A-Za-z]+)", 1)).isin(*FIRST_NAMES))
        )
        looked_up = _any_of(kind, "email", "weak_email", "card", "iban", "person")
        return F.struct(
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["found"].alias("found"),
            _vote(right, kind != "person").alias("format"),
            _vote(listed, looked_up).alias("gazetteer"),
            _vote(before.rlike(FOR) | after.rlike(FOR), before.rlike(AGAINST)).alias("context"),
            F.least(F.floor(F.length(found) / 6), F.lit(5)).cast("int").alias("size"),
            F.floor(4 * F.length(digits) / F.greatest(F.length(found), F.lit(1))).cast("int").alias("digits"),
            F.when(before.rlike(r"(?:^|[\s(\"'])$"), 1).otherwise(0).alias("opens"),
            F.when(after.rlike(r"^(?:$|[\s.,;:!?)\"'])"), 1).otherwise(0).alias("closes"),
        )

    return F.transform(F.transform(spans, around), one)


VOTES = ("format", "gazetteer", "context")
FEATURES = ("kind", "context", "size", "digits", "opens", "closes")


@dataclass
class SpanModel:
    """Reliabilities of the labelers and the classifier's weights."""

    hit: dict[str, float]  # P(vote for | personal), votes cast
    false: dict[str, float]  # P(vote for | not personal)
    weights: dict[tuple[str, object], float]
    constant: float

    def probability(self, span: Column) -> Column:
        total = F.lit(self.constant)
        for feature in FEATURES:
            pairs = [(v, w) for (f, v), w in self.weights.items() if f == feature]
            value = F.lit(0.0)
            for v, w in pairs:
                value = F.when(span[feature] == F.lit(v), F.lit(w)).otherwise(value)
            total = total + value
        return 1 / (1 + F.exp(-total))


def _posterior(rows, prior, hit, false):
    """Probability of personal data for each row of votes."""
    out = []
    for row in rows:
        yes, no = math.log(prior[row["kind"]]), math.log(1 - prior[row["kind"]])
        for v in VOTES:
            if row[v] >= 0:
                yes += math.log(hit[v] if row[v] else 1 - hit[v])
                no += math.log(false[v] if row[v] else 1 - false[v])
        out.append(1 / (1 + math.exp(max(-700.0, min(700.0, no - yes)))))
    return out


def estimate(rows: list[dict]) -> tuple[dict, dict, list[float]]:
    """Expectation maximisation over counted vote patterns: reliabilities, and each row's probability.

    Starts from the share of votes for a span. Every estimate is smoothed by a few
    imagined votes of a fair labeler, so none becomes certain.
    """
    guess = []
    for row in rows:
        cast = [row[v] for v in VOTES if row[v] >= 0]
        guess.append((0.5 + sum(cast)) / (1 + len(cast)))
    hit = false = {}
    for _ in range(ROUNDS):
        prior = {}
        for kind in {row["kind"] for row in rows}:
            own = [(row["count"], p) for row, p in zip(rows, guess, strict=True) if row["kind"] == kind]
            prior[kind] = (1 + sum(n * p for n, p in own)) / (2 + sum(n for n, _ in own))
        hit, false = {}, {}
        for v in VOTES:
            cast = [(row["count"], row[v], p) for row, p in zip(rows, guess, strict=True) if row[v] >= 0]
            hit[v] = (4 + sum(n * p for n, vote, p in cast if vote)) / (5 + sum(n * p for n, _, p in cast))
            false[v] = (1 + sum(n * (1 - p) for n, vote, p in cast if vote)) / (5 + sum(n * (1 - p) for n, _, p in cast))
        guess = _posterior(rows, prior, hit, false)
    return hit, false, guess


def _logistic(rows: list[dict], target: list[float], ridge: float = 1.0) -> tuple[dict, float]:
    """Weights of a logistic regression on indicator features, by Newton steps over counted rows."""
    names = sorted({(f, row[f]) for row in rows for f in FEATURES}, key=str)
    place = {name: k for k, name in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 1))
    x[:, -1] = 1
    for i, row in enumerate(rows):
        for f in FEATURES:
            x[i, place[f, row[f]]] = 1
    n, y = np.array([row["count"] for row in rows], dtype=float), np.array(target)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - ridge * w
        curve = (x * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
    return {name: float(w[k]) for name, k in place.items()}, float(w[-1])


def train(found: DataFrame) -> SpanModel | None:
    """A model of all spans in the arrays ``base`` and ``weak``, or None if there is no span."""
    counted = found.select(F.explode(F.concat("base", "weak")).alias("s"))
    keys = [F.col(f"s.{c}").alias(c) for c in dict.fromkeys(VOTES + FEATURES)]
    rows = [r.asDict() for r in counted.groupBy(*keys).count().collect()]  # few values each, so few rows
    if not rows:
        return None
    rows.sort(key=str)
    hit, false, guess = estimate(rows)
    weights, constant = _logistic(rows, guess)
    return SpanModel(hit, false, weights, constant)


def with_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the arrays ``base`` and ``weak`` of described spans. Candidates on a base span are left out."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumns({"base": base_spans(text), "weak": candidate_spans(text)})
    rows = rows.withColumn("weak", S.free_of(F.col("weak"), F.col("base")))
    # Texts without spans, which are most, are not cut.
    rows = rows.withColumn("_pieces", F.when(F.size("base") + F.size("weak") > 0, S.pieces_of(text)))
    both = {name: described(F.col(name), F.col("_pieces")) for name in ("base", "weak")}
    return rows.withColumns(both).drop("_pieces")


def accepted(model: SpanModel | None) -> Column:
    """The candidates that the classifier takes for personal data."""
    if model is None:
        return F.expr("slice(weak, 1, 0)")
    return F.filter("weak", lambda s: model.probability(s) >= THRESHOLD)


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, the strict spans ``base``, and the candidates ``added`` by the classifier."""
    found = with_spans(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text")
    found = materialize(found.select("_id", "base", "weak"))  # spans alone, so the texts are read once
    return found.select(F.col("_id").alias(id_col), "base", accepted(train(found)).alias("added"))


def personal_digests(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of the strict spans, and all spans as text."""
    found = personal_spans(docs, id_col)
    return found.select(
        id_col,
        *[S.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(S.spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        S.spelled(S.ordered(F.concat("base", "added"), KINDS)).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``<KIND>``; overlapping spans become one.

    ``spans`` are in order. Each brings what stands between the spans before and it;
    what follows the last comes with no span.
    """

    def piece(pieces, length):
        def one(s, upto):
            mark = F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
            own = F.when(s["start"] >= upto, F.concat(S.cut(pieces, upto, s["start"]), mark)).otherwise("")
            return F.when(s.isNull(), S.cut(pieces, upto, length)).otherwise(own)

        return one

    reach = F.concat(F.array(F.lit(0).cast("long")), S.running(F.transform(spans, lambda s: s["end"]), F.greatest))
    length = F.char_length(text).cast("long")
    return S.let(S.pieces_of(text), lambda pieces: F.array_join(F.zip_with(spans, reach, piece(pieces, length)), ""))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced by its kind. ``n_chars`` follows the text."""
    columns = docs.columns
    own = f"_c{columns.index(text_col)}"
    named = docs.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(columns)])
    rows = materialize(with_spans(named, own))  # so the patterns run once
    rows = rows.withColumn("_all", F.concat("base", accepted(train(rows))))
    text = F.col(own).cast("string")
    rows = rows.withColumn("_new", F.when(F.size("_all") > 0, masked(text, S.ordered(F.col("_all"), KINDS))))
    out = []
    for k, c in enumerate(columns):
        value = F.col(f"_c{k}")
        if c == text_col:
            value = F.coalesce("_new", value)
        elif c == "n_chars":
            value = F.when(F.col("_new").isNotNull(), F.char_length("_new")).otherwise(value).cast(docs.schema[c].dataType)
        out.append(value.alias(c))
    return rows.select(*out)
