"""Personal data by weak supervision; column expressions only.

*Rules.* Four kinds of spans (``email``, ``ip``, ``card``, ``phone``) are found by pattern, leftmost
and without overlap within a kind, and kept where they pass the kind's check. They always stay.

*Candidates.* What a kind's looser pattern finds outside of all rule spans: addresses written
with "at" and "dot", long addresses with colons, numbers that fail the check digit, numbers
without a country code.

*Labelers.* Rule spans and candidates are judged by labelers that vote for, against or not at
all: the rule itself, the form (regex), the check digit or range, a gazetteer (top-level names,
issuers, country codes, reserved networks), words around the span (context), the characters it
touches, and other personal data in the document.

*Aggregation.* Expectation-maximisation over the counts of vote patterns, which are bounded,
estimates per kind how often each labeler votes which way for true and for false spans, and so
the probability of every pattern.

*Span classifier.* A logistic regression over form and surroundings is fitted on all spans,
grouped by their features and weighted by those probabilities; it decides about candidates.

A text stays in its row: positions are running sums over the lengths of what a pattern matches
and what is left between, in blocks, so they are linear in the text. Patterns start only where a
run begins and do not go back into it, so they are linear as well.

Cases: a NULL or empty text has no spans; repeated rows give repeated results; texts may have
any length; an empty table, or one without spans, gives rows without added spans. Only the
named columns are read, so other names cannot clash. Spans of different kinds may overlap if
the rules find both; where the same place is found by two loose patterns, the kind listed first
has it.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.session import materialise

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.5
ROUNDS = 40
BLOCK = 64
CONTEXT = 40
FILLER = "\u0001"

LOCAL = "[A-Za-z0-9._%+-]"
LABEL = "[A-Za-z0-9-]"
#: The rules. Each may begin where the match before ended, else only where its run begins.
RULES = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
AT = r"(?: ?[\[({<](?i:at)[\])}>] ?| (?i:at) )"
DOT = r"(?: ?[\[({<](?i:dot)[\])}>] ?| (?i:dot) )"
LOOSE = {
    "email": rf"(?<!{LOCAL}){LOCAL}++(?:{AT}|@){LABEL}++(?:(?:{DOT}|\.){LABEL}++)*+{DOT}[A-Za-z]{{2,}}+",
    "ip": r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}+(?:::?[0-9A-Fa-f]{1,4}+){3,7}+(?![0-9A-Za-z:])",
    "card": RULES["card"],
    "phone": r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z-])",
}
#: Cheap conditions without which a pattern cannot match.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
LOOSE_HINTS = {"email": r"(?i)dot", "ip": r"[0-9A-Fa-f]:", "card": HINTS["card"], "phone": r"[0-9][ .-][0-9]"}

#: Gazetteers and cue words.
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu", "us", "ca", "ch", "at", "nl")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6[045])"
COUNTRIES = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED = r"^(?:0+|127|255|22[4-9]|23[0-9])\."
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write to|reach|kontakt|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|client|from|login|adresse|dirección)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|cell|fax|dial|telefon|téléphone|teléfono)\b",
}
NOT_CUES = r"(?i)\b(?:version|release|isbn|issn|doi|order|serial|token|secret|sha|hash|commit|build|figure|table|section)\b"

VOTES = ("rule", "form", "check", "gazetteer", "context", "touching", "company")
FEATURES = ("email", "ip", "card", "phone", "digits", "size", "signs", "form", "check", "gazetteer", "cue", "not_cue", "left", "right", "company")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once, also where the body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column) -> Column:
    """Sums of an array up to and with each entry, in blocks."""
    zero = F.lit(0).cast("bigint")
    none = F.array().cast("array<bigint>")
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), zero)
    sums = lambda a: F.aggregate(a, none, lambda got, x: F.concat(got, F.array(last(got) + x)))
    total = lambda a: F.aggregate(a, zero, lambda got, x: got + x)

    def blocks(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        return F.transform(starts, lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))

    def joined_up(parts: Column) -> Column:
        before = F.concat(F.array(zero), sums(F.transform(parts, total)))
        return F.flatten(F.zip_with(
            parts, F.slice(before, F.lit(1), F.size(parts)), lambda b, o: F.transform(sums(b), lambda x: x + o)))

    return F.when(F.size(values) > 0, let(values, lambda v: let(blocks(v), joined_up))).otherwise(none)


def matched(rows: DataFrame, text: str, pattern: str, hint: Column, name: str) -> DataFrame:
    """Adds ``<name>_m``, the matches, ``<name>_g``, what lies between, and ``<name>_e``, where they end."""
    none = F.array().cast("array<string>")
    m, g, e = (f"{name}_{c}" for c in "mge")
    rows = rows.withColumn(m, F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    rows = rows.withColumn(g, F.when(F.size(m) > 0, F.split(text, pattern, -1)).otherwise(none))
    sizes = F.transform(m, lambda x, i: (F.length(x) + F.length(F.get(g, i))).cast("bigint"))
    return rows.withColumn(e, running(sizes))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def small_part(part: Column) -> Column:
    """Whether a run of digits is at most 255."""
    value = F.regexp_replace(part, "^0+", "")
    return (F.length(value) < 3) | ((F.length(value) == 3) & (value <= "255"))


def luhn(number: Column) -> Column:
    """Whether up to 19 digits have a right check digit."""
    plain = F.reverse(F.lpad(number, 19, "0"))
    twice = F.translate(plain, "0123456789", "0246813579")
    total = F.lit(0)
    for i in range(19):
        total = total + F.ascii(F.substring(twice if i % 2 else plain, i + 1, 1)) - 48
    return total % 10 == 0


def counted(number: Column, least: int, most: int) -> Column:
    return (F.length(number) >= least) & (F.length(number) <= most)


def four_parts(text: Column) -> Column:
    return F.forall(F.split(text, r"\."), small_part)


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": four_parts,
    "card": lambda m: counted(digits(m), 12, 19) & luhn(F.substring(digits(m), 1, 19)),
    "phone": lambda m: counted(digits(m), 9, 15),
}
PLAUSIBLE: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.lit(True),
    "card": lambda m: counted(digits(m), 12, 19),
    "phone": lambda m: counted(digits(m), 9, 15),
}


def spans_of(name: str, number: int, passes: Callable[[Column], Column], rule: bool) -> Column:
    """The matches that pass as ``(start, k, end, match, before, after, rule)``."""
    m, g, e = (F.col(f"{name}_{c}") for c in "mge")
    every = F.transform(m, lambda x, i: F.struct(
        (F.get(e, i) - F.length(x)).alias("start"), F.lit(number).alias("k"), F.get(e, i).alias("end"), x.alias("match"),
        F.right(F.get(g, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(g, i + 1), F.lit(CONTEXT)).alias("after"),
        F.lit(rule).alias("rule")))
    return F.filter(every, lambda s: passes(s["match"]))


def masked(name: str, text: str, passes: Callable[[Column], Column]) -> Column:
    """The text with the matches that pass replaced, character by character."""
    m, g = F.col(f"{name}_m"), F.col(f"{name}_g")
    parts = F.transform(g, lambda between, i: F.concat(between, F.coalesce(
        F.when(passes(F.get(m, i)), F.repeat(F.lit(FILLER), F.length(F.get(m, i)))).otherwise(F.get(m, i)), F.lit(""))))
    return F.when(F.size(m) > 0, F.array_join(parts, "")).otherwise(F.col(text))


def candidates(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``(doc, spans, kinds)``: rule spans and candidates of every document, in order of start and
    kind, and the kinds of the rule spans."""
    rows = docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    hint = lambda column, kind, hints: F.col(column).contains("@") if hints[kind] == "@" else F.col(column).rlike(hints[kind])
    for kind in KINDS:
        rows = matched(rows, "t", RULES[kind], hint("t", kind, HINTS), kind)
    # Where rules of two kinds share a place, the second is sought again in what the first has left.
    rows = rows.withColumn("left", masked("email", "t", CHECKS["email"]))
    for kind in KINDS[1:]:
        rows = matched(rows, "left", RULES[kind], hint("left", kind, HINTS), "again")
        rows = rows.withColumn("left", masked("again", "left", CHECKS[kind]))
    for kind in KINDS:
        rows = matched(rows, "left", LOOSE[kind], hint("left", kind, LOOSE_HINTS), f"loose_{kind}")
        rows = rows.withColumn("left", masked(f"loose_{kind}", "left", PLAUSIBLE[kind]))
    found = [spans_of(kind, i, CHECKS[kind], True) for i, kind in enumerate(KINDS)]
    found += [spans_of(f"loose_{kind}", i, PLAUSIBLE[kind], False) for i, kind in enumerate(KINDS)]
    rows = rows.select("doc", F.array_sort(F.concat(*found)).alias("spans"))
    kinds = F.array_distinct(F.transform(F.filter("spans", lambda s: s["rule"]), lambda s: s["k"]))
    return rows.withColumn("kinds", kinds)


def per_kind(k: Column, options: dict[str, Column]) -> Column:
    out = None
    for i, kind in enumerate(KINDS):
        out = F.when(k == i, options[kind]) if out is None else out.when(k == i, options[kind])
    return out


def vote(yes: Column, no: Column | None = None) -> Column:
    return F.when(yes, 1).when(F.lit(False) if no is None else no, -1).otherwise(0)


def judged(spans: Column, kinds: Column) -> Column:
    """Votes and features of every span of a document, instead of its surroundings."""

    def one(s: Column) -> Column:
        m, k = s["match"], s["k"]
        number = digits(m)
        near = F.concat_ws(" ", s["before"], s["after"])
        form = per_kind(k, {
            "email": vote(m.rlike(r"[.][A-Za-z]{2,24}$"), m.rlike(r"[0-9-]$")),
            "ip": vote(m.rlike(r"^(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})$"), m.rlike(r"^[0-9:]+$") | m.rlike(r"(?:^|\.)0[0-9]")),
            "card": vote(m.rlike(r"^[0-9]{13,16}$|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$"), m.rlike(r"[ -]")),
            "phone": vote(m.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]+\)?[0-9 .-]+$|^\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}$|^[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}$"),
                          m.rlike(r"^(?:19|20)[0-9]{2}[ .-]"))})
        check = per_kind(k, {
            "email": vote(F.lit(False), m.rlike(r"\.\.|^\.|--")),
            "ip": vote(~m.contains(":") & four_parts(F.when(m.contains(":"), "0.0").otherwise(m)), m.rlike(r"^[0-9]{1,2}(?::[0-9]{2})+$")),
            "card": F.when(luhn(F.substring(number, 1, 19)), 1).otherwise(-1),
            "phone": vote(counted(number, 10, 13))})
        gazetteer = per_kind(k, {
            "email": vote(F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1)).isin(*TOP_LEVEL)),
            "ip": vote(F.lit(False), m.rlike(RESERVED)),
            "card": vote(number.rlike(ISSUERS), ~number.rlike(ISSUERS)),
            "phone": vote(m.startswith("+") & number.rlike(COUNTRIES))})
        cue = per_kind(k, {kind: near.rlike(CUES[kind]) for kind in KINDS})
        not_cue = near.rlike(NOT_CUES)
        left, right = s["before"].rlike(r"[\p{L}\p{N}_=]$"), s["after"].rlike(r"^[\p{L}\p{N}_]")
        company = F.size(kinds) > F.array_contains(kinds, k).cast("int")
        flag = lambda c: c.cast("int")
        return F.struct(
            s["start"].alias("start"), k.alias("k"), s["end"].alias("end"), s["rule"].alias("rule"),
            F.struct(
                flag(s["rule"]).alias("rule"), form.alias("form"), check.alias("check"), gazetteer.alias("gazetteer"),
                vote(cue & ~not_cue, not_cue).alias("context"), vote(~left & ~right, left | right).alias("touching"),
                flag(company).alias("company")).alias("votes"),
            F.struct(
                *[flag(k == i).alias(kind) for i, kind in enumerate(KINDS)],
                F.least(F.length(number), F.lit(20)).alias("digits"), F.least(F.length(m), F.lit(40)).alias("size"),
                F.least(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), F.lit(8)).alias("signs"),
                form.alias("form"), check.alias("check"), gazetteer.alias("gazetteer"), flag(cue).alias("cue"),
                flag(not_cue).alias("not_cue"), flag(left).alias("left"), flag(right).alias("right"),
                flag(company).alias("company")).alias("features"))

    return F.transform(spans, one)


Pattern = tuple[int, tuple[int, ...]]


def reliabilities(counts: dict[Pattern, int], rounds: int = ROUNDS) -> dict[Pattern, float]:
    """The probability that a span with a vote pattern is true, by expectation-maximisation.

    ``counts`` is by kind and votes. Per kind each labeler has a distribution of votes for true and
    one for false spans; the start is the share of votes for a span. Each distribution has a few
    votes of its own, more of them on the side where a labeler should be.
    """
    posterior = {(k, v): (1 + sum(x > 0 for x in v)) / (2 + sum(x != 0 for x in v)) for k, v in counts}
    for _ in range(rounds):
        told: dict = defaultdict(float)
        total: dict = defaultdict(float)
        for (k, votes), n in counts.items():
            for y, share in ((1, posterior[k, votes]), (0, 1 - posterior[k, votes])):
                total[k, y] += n * share
                for i, v in enumerate(votes):
                    told[k, y, i, v] += n * share
        for k, votes in counts:
            odds = math.log((total[k, 1] + 1) / (total[k, 0] + 1))
            for i, v in enumerate(votes):
                agrees = {1: 2.0 if v > 0 else 1.0, 0: 2.0 if v < 0 else 1.0}
                odds += math.log((told[k, 1, i, v] + agrees[1]) / (total[k, 1] + 4))
                odds -= math.log((told[k, 0, i, v] + agrees[0]) / (total[k, 0] + 4))
            posterior[k, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return posterior


def classifier(spans: DataFrame) -> tuple[float, list[float]] | None:
    """Intercept and weights of the span classifier; None where there are no spans to learn from."""
    by_votes = spans.groupBy("k", *[F.col(f"votes.{v}").alias(v) for v in VOTES]).count().collect()
    if not by_votes:
        return None
    posterior = reliabilities({(r["k"], tuple(r[v] for v in VOTES)): r["count"] for r in by_votes})
    shares = spans.sparkSession.createDataFrame(
        [(k, *votes, p) for (k, votes), p in posterior.items()],
        ", ".join(["k int", *[f"{v} int" for v in VOTES], "share double"]))
    seen = spans.groupBy("k", "votes", "features").agg(F.count("*").cast("double").alias("n"))
    met = seen.select("k", *[F.col(f"votes.{v}").alias(v) for v in VOTES], "features", "n").join(
        F.broadcast(shares), ["k", *VOTES])
    both = met.select("features", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("share")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("share"))).alias("weight")))).alias("y"))
    rows = both.select(*[F.col(f"features.{f}").cast("double").alias(f) for f in FEATURES], "y.label", "y.weight")
    rows = materialise(rows.groupBy(*FEATURES, "label").agg(F.sum("weight").alias("weight")), "span-labels")
    model = LogisticRegression(weightCol="weight", maxIter=50, regParam=1e-4).fit(
        VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("features", "label", "weight"))
    return float(model.intercept), [float(w) for w in model.coefficients]


def find(docs: DataFrame, doc: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc, base, spans)``: arrays of ``(start, k, end)``; ``base`` are those of the rules.

    ``k`` is the place of the kind in ``KINDS``, positions are code points, ends are exclusive.
    """
    spans = materialise(
        candidates(docs, doc, text).select("doc", judged(F.col("spans"), F.col("kinds")).alias("spans")), "personal-spans")
    model = classifier(spans.select(F.explode("spans").alias("s")).select("s.k", "s.votes", "s.features"))

    def kept(s: Column) -> Column:
        if model is None:
            return s["rule"]
        margin = F.lit(model[0])
        for f, w in zip(FEATURES, model[1]):
            margin = margin + F.lit(w) * s["features"][f]
        return s["rule"] | (1 / (1 + F.exp(-margin)) >= threshold)

    place = lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end"))
    return spans.select(
        F.col("doc").alias(doc), F.transform(F.filter("spans", lambda s: s["rule"]), place).alias("base"),
        F.transform(F.filter("spans", kept), place).alias("spans"))


def joined(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    named = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(named, s["k"]), s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the rules' spans, all spans as a string, and how many were added."""
    doc = found.columns[0]
    count = lambda i: F.size(F.filter("base", lambda s: s["k"] == i)).cast("bigint")
    return found.select(
        doc, *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"))
