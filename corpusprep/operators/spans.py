"""Protected spans: masking, the span table, restoring, leaks.

A document's spans stay in its row as one array per kind, so masking and
restoring move no data between tasks; ``span_table`` gives the long form.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx


@dataclass(frozen=True)
class SpanKind:
    """A kind of span. Its placeholders read ``<prefix>0000X``, numbered per document.

    ``hint`` is a literal every span of the kind contains; texts without it skip
    the pattern.
    """

    name: str
    prefix: str
    pattern: str
    block: bool = False
    hint: str | None = None

    @property
    def pad(self) -> str:
        return "\n\n" if self.block else " "

    @property
    def token(self) -> str:
        return rf"{self.prefix}\d{{4,}}X"


# Placeholder prefixes and delimiters of formulas and images.
FORMULAS = (
    SpanKind("block", "MATHBLK", r"(?s)\$\$.*?\$\$|\\\[.*?\\\]", True),
    SpanKind("inline", "MATHINL", r"(?s)(?<!\$)\$(?!\$).+?(?<!\$)\$(?!\$)|\\\(.*?\\\)"),
    SpanKind("image", "IMGTOKEN", r"!\[[^\]]*\]\([^)]+\)", True),
)


#: What a source has in the form of a placeholder is hidden under a prefix of its own, without padding.
FOREIGN = "KEPTTK"


def foreign_pattern(kinds: Sequence[SpanKind]) -> str:
    return "(?:" + "|".join([*(k.prefix for k in kinds), FOREIGN]) + r")\d{4,}X"


def token_pattern(kinds: Sequence[SpanKind]) -> str:
    return "(?:" + "|".join(k.prefix for k in kinds) + r")\d{4,}X"


def placeholder(kind: SpanKind, index: Column) -> Column:
    return F.format_string(f"{kind.prefix}%04dX", index)


def weave(text: str, pattern: str, shown: Column) -> Column:
    """The text with its matches replaced by the entries of ``shown``, in order."""
    gaps = F.split(F.col(text), pattern, -1)
    pairs = F.zip_with(gaps, shown, lambda gap, s: F.concat(gap, F.coalesce(s, F.lit(""))))
    return F.array_join(pairs, "")


def _padded_tokens(kind: SpanKind, originals: str) -> Column:
    pad = F.lit(kind.pad)
    return F.transform(originals, lambda _m, i: F.concat(pad, placeholder(kind, i), pad))


def mask_spans(
    docs: DataFrame, kinds: Sequence[SpanKind], text: str = "text", masked: str = "masked",
    spans: str = "spans",
) -> DataFrame:
    """Add the masked text and a struct with one array of originals per kind.

    Kinds run in order, each on the text the one before has masked, so a later
    span may enclose an earlier placeholder. Before them, strings of the source that
    have the form of a placeholder are hidden, so every placeholder left is ours; their
    originals are in the field ``foreign``.
    """
    own = foreign_pattern(kinds)
    suspect = may_leak(text, kinds) | F.col(text).contains(FOREIGN)
    out = docs.withColumn("__foreign", F.when(suspect, tx.find_all(text, own)).otherwise(
        F.array().cast("array<string>")))
    hidden = weave(text, own, F.transform("__foreign", lambda _m, i: F.format_string(f"{FOREIGN}%04dX", i)))
    out = out.withColumn(masked, F.when(F.size("__foreign") > 0, hidden).otherwise(F.col(text)))
    for k in kinds:
        found = tx.find_all(masked, k.pattern)
        if k.hint:
            found = F.when(F.contains(F.col(masked), F.lit(k.hint)), found).otherwise(
                F.array().cast("array<string>"))
        out = out.withColumn(f"__{k.name}", found)
        woven = weave(masked, k.pattern, _padded_tokens(k, f"__{k.name}"))
        out = out.withColumn(
            masked, F.when(F.size(f"__{k.name}") > 0, woven).otherwise(F.col(masked)))
    struct = F.struct(
        *[F.col(f"__{k.name}").alias(k.name) for k in kinds], F.col("__foreign").alias("foreign"))
    given = [c for c in docs.columns if c not in (masked, spans)]
    return tx.evaluated(out, given, {masked: F.col(masked), spans: struct})


def span_table(masked: DataFrame, kinds: Sequence[SpanKind], keys: Sequence[str],
               spans: str = "spans") -> DataFrame:
    """Long form: ``(*keys, kind, idx, placeholder, original)``."""
    def entries(k: SpanKind) -> Column:
        return F.transform(F.col(spans)[k.name], lambda s, i: F.struct(
            F.lit(k.name).alias("kind"), i.alias("idx"),
            placeholder(k, i).alias("placeholder"), s.alias("original")))

    return masked.select(*keys, F.inline(F.flatten(F.array(*map(entries, kinds)))))


def _original(token: Column, kinds: Sequence[SpanKind], spans: str) -> Column:
    """The original a token stands for: its number is its place in the kind's array."""
    at = F.regexp_extract(token, r"(\d+)X", 1).cast("int")
    found = None
    for k in kinds:
        hit = F.concat(F.lit(k.pad), F.get(F.col(spans)[k.name], at), F.lit(k.pad))
        found = (F if found is None else found).when(token.contains(k.prefix), hit)
    return found


def _put_back(kind: SpanKind, originals: Column) -> Callable[[Column, Column], Column]:
    pad = F.lit(kind.pad)

    def put(hit: Column, i: Column) -> Column:
        match = hit["match"]
        at = F.regexp_extract(match, r"(\d+)X", 1).cast("int")
        body = F.concat(F.get(originals, at), pad)
        # Two neighbours share one padding.
        touching = (i > 0) & (hit["gap"] == "")
        return F.coalesce(F.when(touching, body).otherwise(F.concat(pad, body)), match)

    return put


def unmask(docs: DataFrame, kinds: Sequence[SpanKind], text: str = "masked",
           out: str = "restored", spans: str = "spans") -> DataFrame:
    """Put the originals back; tokens without one stay.

    Blanks around a placeholder give way to its padding. Then as many rounds as
    there are kinds restore placeholders that an original had swallowed, and runs
    of newlines collapse.
    """
    res = docs.withColumn(out, F.col(text))
    for k in kinds:
        pattern = rf"(?U)\s*{k.token}\s*"
        # Padding is settled on the gaps: an empty gap joins two neighbours.
        gaps = F.split(out, pattern, -1)
        found = F.zip_with(tx.find_all(out, pattern), gaps, lambda m, gap: F.struct(m.alias("match"), gap.alias("gap")))
        back = F.transform(found, _put_back(k, F.col(spans)[k.name]))
        woven = F.zip_with(gaps, back, lambda gap, s: F.concat(gap, F.coalesce(s, F.lit(""))))
        res = res.withColumn(out, F.when(
            F.size(F.col(spans)[k.name]) > 0, F.array_join(woven, "")).otherwise(F.col(out)))
    whole = foreign_back(nested(res, kinds, out, spans), out, spans)
    given = [c for c in docs.columns if c != out]
    return tx.evaluated(whole, given, {out: tx.collapse_newlines(out)})


def foreign_back(docs: DataFrame, text: str, spans: str = "spans") -> DataFrame:
    """Put back what the source had in the form of a placeholder."""
    pattern = rf"{FOREIGN}\d{{4,}}X"
    shown = F.transform(tx.find_all(text, pattern), lambda t: F.coalesce(
        F.get(F.col(spans)["foreign"], F.regexp_extract(t, r"(\d+)X", 1).try_cast("int")), t))
    return docs.withColumn(text, F.when(
        F.size(F.col(spans)["foreign"]) > 0, weave(text, pattern, shown)).otherwise(F.col(text)))


def nested(docs: DataFrame, kinds: Sequence[SpanKind], text: str, spans: str = "spans",
           rounds: int | None = None) -> DataFrame:
    """Restore tokens left in ``text``, as often as originals bring up new ones.

    A kind swallows only kinds masked before it, so a round per kind is enough.
    """
    pattern = token_pattern(kinds)
    res = docs.withColumn("__open", may_leak(text, kinds))
    for _ in range(len(kinds) if rounds is None else rounds):
        shown = F.transform(
            tx.find_all(text, pattern), lambda t: F.coalesce(_original(t, kinds, spans), t))
        again = F.when(F.col("__open"), weave(text, pattern, shown)).otherwise(F.col(text))
        res = res.withColumn(text, again)
    return res.drop("__open")


def may_leak(text: Column | str, kinds: Sequence[SpanKind]) -> Column:
    """A cheap test by literal search that holds for every text with a token."""
    out = F.lit(False)
    for k in kinds:
        out = out | tx.col(text).contains(k.prefix)
    return out


def leaks(text: Column | str, kinds: Sequence[SpanKind]) -> Column:
    """Distinct tokens still in a text, sorted."""
    return F.array_sort(F.array_distinct(tx.find_all(text, token_pattern(kinds))))


def leak_scan(docs: DataFrame, kinds: Sequence[SpanKind], texts: Sequence[str]) -> DataFrame:
    """Tokens left per text column and kind: ``(stage, kind, n_tokens, n_docs)``, one pass.

    Kinds without any are listed with 0.
    """
    def tokens(text: str, k: SpanKind) -> Column:
        return F.when(F.col(text).contains(k.prefix), tx.count_matches(text, k.token)).otherwise(0)

    cases = [(t, k) for t in texts for k in kinds]
    counts = docs.select(*[tokens(t, k).alias(f"c{i}") for i, (t, k) in enumerate(cases)])
    sums = counts.agg(*[
        c for i in range(len(cases)) for c in (
            F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"n{i}"),
            F.count_if(F.col(f"c{i}") > 0).alias(f"d{i}"))
    ])
    rows = F.array(*[F.struct(
        F.lit(t).alias("stage"), F.lit(k.name).alias("kind"),
        F.col(f"n{i}").alias("n_tokens"), F.col(f"d{i}").alias("n_docs"))
        for i, (t, k) in enumerate(cases)])
    return sums.select(F.inline(rows))


def restore_unresolved(
    docs: DataFrame, sources: DataFrame, kinds: Sequence[SpanKind], keys: Sequence[str],
    text: str = "text", source_text: str = "text",
) -> DataFrame:
    """Heal leaked tokens from a fresh masking of the source texts.

    Adds ``healed``, ``n_restored`` (occurrences) and ``missing`` (tokens the
    source does not know). Both sides have one row per document.
    """
    keys = list(keys)
    known = mask_spans(
        sources.select(*keys, F.col(source_text).alias("__source")), kinds, "__source", "__m", "__spans"
    ).select(*keys, "__spans")
    both = docs.join(known, keys, "left")
    pattern = token_pattern(kinds)
    found = tx.find_all(text, pattern)
    both = both.withColumns({
        "missing": F.filter(leaks(text, kinds), lambda t: _original(t, kinds, "__spans").isNull()),
        "n_restored": F.size(F.filter(found, lambda t: _original(t, kinds, "__spans").isNotNull())),
    })
    shown = F.transform(found, lambda t: F.coalesce(_original(t, kinds, "__spans"), t))
    healed = foreign_back(both.withColumn("healed", weave(text, pattern, shown)), "healed", "__spans")
    return healed.drop("__spans")
