"""Rule-driven rewriting of texts, with hit audits."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators.spans import SpanKind, weave

FOLD_LIMIT = 15


@dataclass(frozen=True)
class Rule:
    """``kind`` is ``regex`` (Java pattern, ``$1`` groups) or ``literal``."""

    rule_id: str
    pattern: str
    replacement: str = ""
    kind: str = "regex"

    @property
    def java(self) -> str:
        return self.pattern if self.kind == "regex" else tx.quote(self.pattern)


def rewrite(docs: DataFrame, rules: Sequence[Rule], text: str = "text", out: str | None = None) -> DataFrame:
    """Apply the rules in order.

    Long lists are cut into groups that are computed one after the other: one deep
    expression over dozens of patterns would outgrow the code generator, and the
    optimizer would merge plain projections again.
    """
    out = out or text
    res = docs.withColumn(out, F.col(text))
    others = [c for c in res.columns if c != out]
    for i in range(0, len(rules), FOLD_LIMIT):
        c = F.col(out)
        for r in rules[i:i + FOLD_LIMIT]:
            if r.kind == "literal":
                c = F.replace(c, F.lit(r.pattern), F.lit(r.replacement))
            else:
                c = F.regexp_replace(c, r.pattern, r.replacement)
        last = i + FOLD_LIMIT >= len(rules)
        res = res.withColumn(out, c) if last else tx.evaluated(res, others, {out: c})
    return res.select(*docs.columns, *([out] if out not in docs.columns else []))


def clean_fences(text: Column | str, fence: str = "$$") -> Column:
    """Drop fences without a partner in their line, and lines that are nothing but such a fence.

    The fences of a line are paired from left to right; an odd last one goes with the blanks before it.
    """
    blanks = F.lit(" \t")

    def mend(line: Column) -> Column:
        return tx.let(F.split(line, tx.quote(fence), -1), lambda parts: paired(line, parts))

    def paired(line: Column, parts: Column) -> Column:
        n = F.size(parts)
        front = F.rtrim(F.array_join(F.slice(parts, F.lit(1), n - 1), fence), blanks)
        back = F.element_at(parts, -1)
        lone = F.when(F.length(front) > 0, F.concat(front, back)).otherwise(F.ltrim(back, blanks))
        # Pieces between an even number of fences are odd in number.
        return F.when(n % 2 == 1, line).when(F.length(tx.strip(lone)) > 0, lone)

    kept = F.filter(F.transform(tx.lines(text), mend), lambda line: line.isNotNull())
    return F.array_join(kept, "\n")


def closed_over(words: Mapping[str, str]) -> dict[str, str]:
    """Fold later word rules into earlier replacements, so one pass over a text is enough."""
    items = list(words.items())
    out = {}
    for i, (source, put) in enumerate(items):
        for later, then in items[i + 1:]:
            put = re.sub(rf"\b{re.escape(later)}\b", lambda _m, t=then: t, put, flags=re.IGNORECASE)
        out[source.lower()] = put
    return out


def _words_replaced(
    docs: DataFrame, text: str, words: Mapping[str, str], left: str = r"\b", right: str = r"\b"
) -> DataFrame:
    """Replace whole words of ``text`` in one pass, keeping the case of what was found."""
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    pattern = rf"{tx.first_of(words)}(?iU){left}(?:{tx.any_of(words)}){right}"
    found = docs.withColumn("__found", tx.find_all(text, pattern))
    put = F.transform("__found", lambda m: tx.let(
        F.element_at(table, F.lower(m)), lambda r: tx.preserve_case(m, r)))
    woven = F.when(F.size("__found") > 0, weave(text, pattern, put)).otherwise(F.col(text))
    return found.withColumn(text, woven).drop("__found")


def glossary_rewrite(
    docs: DataFrame, words: Mapping[str, str], phrases: Mapping[str, str] | None = None,
    text: str = "text", out: str | None = None,
) -> DataFrame:
    """Phrases longest first, then words; whole-word and case-insensitive.

    Run it on masked text: placeholders are whole words of their own, so nothing
    inside a protected span is touched.
    """
    out = out or text
    res = docs.withColumn(out, F.col(text))
    by_length: dict[int, dict[str, str]] = {}
    for source, put in (phrases or {}).items():
        by_length.setdefault(len(source), {})[source.lower()] = put
    for length in sorted(by_length, reverse=True):
        res = _words_replaced(res, out, by_length[length], r"(?<!\w)", r"(?!\w)")
    if words:
        res = _words_replaced(res, out, closed_over(words))
    return tx.evaluated(res, [c for c in docs.columns if c != out], {out: F.col(out)})


def guarded(full: Column, conservative: Column, leak: str) -> Column:
    """The full rewrite, unless it leaks placeholders."""
    return F.when(full.rlike(leak), conservative).otherwise(full)


def wrap_lines(text: Column | str, triggers: Callable[[Column], Column], fence: str = "$$") -> Column:
    """Fence whole lines; ``triggers`` is a function of the line."""
    return F.array_join(
        F.transform(tx.lines(text), lambda ln: F.when(
            triggers(ln), F.concat(F.lit(f"{fence}\n"), tx.strip(ln), F.lit(f"\n{fence}"))
        ).otherwise(ln)), "\n")


def wrap_unfenced(
    docs: DataFrame, kinds: Sequence[SpanKind], trigger: str, prose: str,
    environments: Iterable[str] = (), typos: Mapping[str, str] | None = None,
    spare: str = r"^[\s|\-]+$", text: str = "text", out: str = "wrapped", fence: str = "$$",
) -> DataFrame:
    """Fence bare environments and formula lines that stand outside protected spans.

    Typos are mended first. A line is wrapped when it has a trigger, no prose,
    is not a table rule, and holds no placeholder.
    """
    res = docs.withColumn(out, F.col(text))
    for wrong, right in (typos or {}).items():
        res = res.withColumn(out, F.replace(out, F.lit(wrong), F.lit(right)))
    # Hidden spans come back as they were: no padding, one token per span.
    hidden = hide(res, kinds, out)
    names = "|".join(tx.quote(e) for e in environments)
    if names:
        put = f"\n\n{_escaped(fence)}\n$1\n{_escaped(fence)}\n\n"
        hidden = hidden.withColumn(
            out, F.regexp_replace(out, rf"(?s)(\\begin\{{({names})\}}.*?\\end\{{\2\}})", put))
    token = HIDDEN

    def wanted(ln: Column) -> Column:
        return (
            (F.length(tx.strip(ln)) > 0) & ~ln.rlike(prose) & ln.rlike(trigger)
            & ~ln.rlike(spare) & ~ln.rlike(token)
        )

    return show(hidden.withColumn(out, wrap_lines(out, wanted, fence)), out)


def _escaped(s: str) -> str:
    return s.replace("$", r"\$")


HIDDEN = "\ue000\\d+\ue001"


def hide(docs: DataFrame, kinds: Sequence[SpanKind], text: str) -> DataFrame:
    """Replace spans by bare tokens, keeping the originals in ``__hidden``.

    Tokens stand between private-use characters. What looks like a token in the
    text is hidden itself, so every token left is one of ours.
    """
    pattern = "|".join([HIDDEN, *(f"(?:{k.pattern})" for k in kinds)])
    found = docs.withColumn("__hidden", tx.find_all(text, pattern))
    tokens = F.transform("__hidden", lambda _m, i: F.format_string("\ue000%d\ue001", i))
    return found.withColumn(text, weave(text, pattern, tokens))


def show(docs: DataFrame, text: str) -> DataFrame:
    """Undo ``hide``."""
    pattern = HIDDEN
    back = F.transform(tx.find_all(text, pattern), lambda t: F.coalesce(F.get(
        "__hidden", F.regexp_extract(t, r"(\d+)", 1).cast("int")), t))
    return docs.withColumn(text, weave(text, pattern, back)).drop("__hidden")


def rule_hits(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """Matches per rule over the corpus, ``(rule_id, n_hits, n_docs)``, unused rules with 0.

    One scan, one row per task: the counts are plain sums side by side.
    """
    counted = docs.agg(*[
        c for i, r in enumerate(rules) for c in (
            F.coalesce(F.sum(tx.count_matches(text, r.java)), F.lit(0)).alias(f"h{i}"),
            F.count_if(tx.count_matches(text, r.java) > 0).alias(f"d{i}"),
        )
    ])
    rows = F.array(*[F.struct(
        F.lit(r.rule_id).alias("rule_id"), F.col(f"h{i}").alias("n_hits"),
        F.col(f"d{i}").alias("n_docs")) for i, r in enumerate(rules)])
    return counted.select(F.inline(rows))
