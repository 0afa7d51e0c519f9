"""Edit tables: ordered literal, section and pattern edits that come as rows.

A table has the columns of ``model.EDITS``. ``ord`` gives the order; ``kind`` is

* ``literal``: every occurrence of ``pattern`` becomes ``replacement``;
* ``section``: from the first ``pattern`` up to the first ``stop`` after it, the text becomes
  ``replacement``, without blanks at its end, and an empty line;
* ``regex``: a Java pattern and its replacement.

The result is that of applying the rules one after the other, each to what the one before has
left. Only few of many rules concern a text, so an Aho-Corasick automaton over all literal and
section patterns finds these in one pass, and only they are applied; what an edit has put in is
scanned again with its surroundings, as it may call for later rules. The same pass counts hits.

Rules are read in order and shared in runs of bounded size, so a table may be as long as it likes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.functions.batches import pieces

RUN_BYTES = 16 << 20
HITS = "array<struct<ord:int,n:int>>"


@dataclass(frozen=True)
class Edit:
    ord: int
    kind: str
    pattern: str
    replacement: str
    stop: str | None = None

    def apply(self, text: str) -> tuple[str, list[tuple[int, int]]]:
        """The edited text, and where in it the new pieces are; none if the rule does not apply."""
        if self.kind == "section":
            begin = text.find(self.pattern)
            end = text.find(self.stop, begin) if begin >= 0 and self.stop else -1
            if end <= begin:
                return text, []
            put = self.replacement.rstrip() + "\n\n"
            return text[:begin] + put + text[end:], [(begin, begin + len(put))]
        parts = text.split(self.pattern)
        places, at = [], 0
        for part in parts[:-1]:
            at += len(part)
            places.append((at, at + len(self.replacement)))
            at += len(self.replacement)
        return (self.replacement.join(parts), places) if places else (text, [])


class EditRun:
    """Literal and section edits in order, applied to the texts that hold their patterns."""

    def __init__(self, edits: list[Edit]):
        self.edits = edits
        self._automaton = None

    def _prepare(self) -> None:
        if self._automaton is None:
            by_pattern: dict[str, list[int]] = {}
            for i, e in enumerate(self.edits):
                by_pattern.setdefault(e.pattern, []).append(i)
            self._automaton = ahocorasick.Automaton()
            for pattern, rules in by_pattern.items():
                self._automaton.add_word(pattern, tuple(rules))
            self._automaton.make_automaton()
            self._longest = max(map(len, by_pattern))

    def __getstate__(self):
        return {"edits": self.edits, "_automaton": None}

    def _called(self, text: str) -> set[int]:
        """Rules whose pattern the text holds."""
        return {i for found in {rules for _, rules in self._automaton.iter(text)} for i in found}

    def apply(self, text: str) -> tuple[str, list[tuple[int, int]]]:
        """The edited text and ``(ord, hits)`` of the rules that applied."""
        self._prepare()
        todo = sorted(self._called(text))
        waiting = set(todo)
        hits = []
        while todo:
            i = heapq.heappop(todo)
            text, places = self.edits[i].apply(text)
            if not places:
                continue
            hits.append((self.edits[i].ord, len(places)))
            reach = self._longest - 1
            if sum(b - a + 2 * reach for a, b in places) > len(text):
                places = [(0, len(text))]
            for a, b in places:
                for j in self._called(text[max(0, a - reach):b + reach]):
                    if j > i and j not in waiting:
                        waiting.add(j)
                        heapq.heappush(todo, j)
        return text, hits


def runs_of(rules: DataFrame, limit: int) -> Iterator[list[Edit]]:
    """The rules in order, in runs of one way of working and of bounded size."""
    run: list[Edit] = []
    size = 0
    rows = rules.select("ord", "kind", "pattern", "replacement", "stop").orderBy("ord").toLocalIterator()
    for r in rows:
        if not r["pattern"]:
            continue
        if r["kind"] not in ("literal", "section", "regex"):
            raise ValueError(f"unknown kind of edit: {r['kind']}")
        edit = Edit(r["ord"], r["kind"], r["pattern"], r["replacement"] or "", r["stop"])
        if run and (size > limit or (run[-1].kind == "regex") != (edit.kind == "regex")):
            yield run
            run, size = [], 0
        run.append(edit)
        size += sum(len(s or "") for s in (edit.pattern, edit.replacement, edit.stop)) + 64
    if run:
        yield run


def _by_automaton(docs: DataFrame, edits: list[Edit], text: Column) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(EditRun(edits))
    kind = pa.struct([("text", pa.string()), ("hits", pa.list_(pa.struct([("ord", pa.int32()), ("n", pa.int32())])))])

    @F.arrow_udf(f"struct<text:string,hits:{HITS}>")
    def edit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = shared.value
        for batch in batches:
            for piece in pieces(batch):
                done = [None if t is None else run.apply(t) for t in piece.to_pylist()]
                yield pa.array([
                    {"text": None, "hits": []} if d is None else
                    {"text": d[0], "hits": [{"ord": o, "n": n} for o, n in d[1]]} for d in done], kind)

    return edit(text)


def apply_edits(
    docs: DataFrame, rules: DataFrame, text: str = "text", out: str = "edited", hits: str = "hits",
    run_bytes: int | None = None,
) -> DataFrame:
    """Adds the edited text and ``hits``, ``(ord, n)`` of each rule that applied to the row.

    A NULL text stays NULL. Rules with an empty pattern never apply.
    """
    given = [c for c in docs.columns if c not in (out, hits)]
    res = docs.withColumns({"__t": F.col(text), "__h": F.array().cast(HITS)})
    kept = [*given, "__t", "__h"]
    for run in runs_of(rules, RUN_BYTES if run_bytes is None else run_bytes):
        if run[0].kind == "regex":
            for e in run:
                n = F.coalesce(tx.count_matches("__t", e.pattern), F.lit(0))
                more = F.when(n > 0, F.array(F.struct(F.lit(e.ord).alias("ord"), n.alias("n")))).otherwise(F.array().cast(HITS))
                res = tx.evaluated(res, given, {
                    "__h": F.concat("__h", more), "__t": F.regexp_replace("__t", e.pattern, e.replacement)})
        else:
            done = res.withColumn("__e", _by_automaton(docs, run, F.col("__t")))
            res = done.select(*given, F.col("__e.text").alias("__t"), F.concat("__h", "__e.hits").alias("__h"))
    return res.select(*kept).withColumnsRenamed({"__t": out, "__h": hits})


def edit_counts(edited: DataFrame, rules: DataFrame, hits: str = "hits") -> DataFrame:
    """``(rule_id, n_hits, used)`` of every rule of the table; unused ones have 0."""
    sums = edited.select(F.inline(hits)).groupBy("ord").agg(F.sum("n").alias("n"))
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return rules.select("rule_id", "ord").join(sums, "ord", "left").select(
        "rule_id", n.alias("n_hits"), (n > 0).cast("int").alias("used"))
