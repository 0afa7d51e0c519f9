"""Glossaries of any size: words and phrases of a table, replaced in one pass.

The rule is that of ``glossary_rewrite``: whole words, any case, longer phrases before shorter
ones, phrases before words, the case of what was found kept (UPPER, Title, as written). All
entries stand in one Aho-Corasick automaton, which gives every place of every entry; places are
taken in the order of the entries (longest first, then by source) and, for one entry, from the
left; those that overlap a taken place are left. An entry's replacement is itself subject to the entries after it, which is settled
once per entry, before any text is read.

A glossary of bounded size is shared as it is. Beyond that nothing is shared: an entry is keyed by
the first words of its source (by its first characters, if it has no word), texts are dealt into
blocks of bounded size, and a block asks for the entries keyed by what it holds. As a place is never
inside a word, these are all that can be found in it. One join takes them to the blocks, and each
block is rewritten with its own entries, so each text is read twice however long the glossary is.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.batches import cuts, pieces
from corpusprep.operators.lookup import estimated_bytes
from corpusprep.session import materialise

RUN_BYTES = 32 << 20
BLOCK_BYTES = 16 << 20
KEY_WORDS = 3


@lru_cache(maxsize=4096)
def in_word(c: str) -> bool:
    """Letters, digits, marks and connectors, as ``\\w`` has them in Unicode patterns."""
    return c.isalnum() or unicodedata.category(c) in ("Mn", "Mc", "Me", "Pc") or c in "‌‍"


def lowered(text: str) -> str:
    """Lower case, a character for each character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


def cased(found: str, put: str) -> str:
    if found.upper() != found.lower():
        if found == found.upper():
            return put.upper()
        if found == " ".join(w[:1].upper() + w[1:].lower() for w in found.split(" ")):
            return put[:1].upper() + put[1:].lower()
    return put


class Glossary:
    """Entries ``(source, put)`` in order: phrases by falling length, then words.

    ``settled`` tells that the entries after it have been applied to each put.
    """

    def __init__(self, entries: list[tuple[str, str]], settled: bool = False):
        self.sources = [lowered(s) for s, _ in entries]
        self.puts = [p for _, p in entries]
        self.settled = settled
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def _prepare(self) -> None:
        if self._automaton is not None:
            return
        self._automaton = ahocorasick.Automaton()
        for i in range(len(self.sources) - 1, -1, -1):
            # Of equal sources the first one counts.
            self._automaton.add_word(self.sources[i], i)
        self._automaton.make_automaton()
        if self.settled:
            return
        # From the last entry on: what comes after an entry is settled already.
        for i in range(len(self.puts) - 1, -1, -1):
            self.puts[i] = self._rewritten(self.puts[i], after=i)

    def _places(self, text: str, after: int) -> list[tuple[int, int, int]]:
        """Places ``(start, end, entry)`` in order that do not overlap."""
        low = lowered(text)
        found = []
        for last, i in self._automaton.iter(low):
            start, end = last + 1 - len(self.sources[i]), last + 1
            if i > after and not (start and in_word(low[start - 1])) and not (end < len(low) and in_word(low[end])):
                found.append((i, start, end))
        if not found:
            return []
        found.sort()
        taken: list[tuple[int, int, int]] = []
        free = bytearray(b"\1") * len(low)
        for i, start, end in found:
            if free.find(0, start, end) < 0:
                free[start:end] = bytes(end - start)
                taken.append((start, end, i))
        return sorted(taken)

    def _rewritten(self, text: str, after: int) -> str:
        out, at = [], 0
        for start, end, i in self._places(text, after):
            out += [text[at:start], cased(text[start:end], self.puts[i])]
            at = end
        return "".join([*out, text[at:]]) if out else text

    def rewrite(self, text: str) -> str:
        if not self.sources:
            return text
        self._prepare()
        return self._rewritten(text, -1)


@lru_cache(maxsize=1)
def words() -> re.Pattern:
    """Runs of the characters that ``in_word`` has."""
    more = [c for c in map(chr, range(sys.maxunicode + 1)) if in_word.__wrapped__(c) and not re.match(r"\w", c)]
    # Kept apart, as a set that holds far characters is searched one by one, for each letter and blank.
    near, far = ("".join(c for c in more if (c > "\uffff") == is_far) for is_far in (False, True))
    return re.compile(rf"(?:\w+|[{near}]+|(?=[\U00010000-\U0010ffff])[{far}])+")


def key_of(low: str) -> tuple[int, str]:
    """How many words the key of a source has, and the key; without a word, characters, and their number below 0."""
    found = words().findall(low)[:KEY_WORDS]
    return (len(found), " ".join(found)) if found else (-len(low[:KEY_WORDS]), low[:KEY_WORDS])


def keys_in(low: str, sizes: Sequence[int]) -> set[str]:
    """The keys, of the sizes in use, that a source found in the text may have."""
    found, keys = words().findall(low), set()
    for n in sizes:
        if n > 0:
            keys.update(map(" ".join, zip(*(found[i:] for i in range(n)))))
        else:
            keys.update(gap[i:i - n] for gap in set(words().split(low)) for i in range(len(gap) + n + 1))
    return keys


def entries_of(glossary: DataFrame) -> DataFrame:
    """``(o, put)``: where an entry stands, by falling length, phrases first, and its replacement."""
    phrase = F.col("source").rlike(r"(?U)\W").cast("int")
    put = F.coalesce("put", F.lit(""))
    place = F.struct((-phrase).alias("phrase"), (-F.length("source")).alias("size"), "source", put.alias("put"))
    return glossary.filter(F.length("source") > 0).select(place.alias("o"), put.alias("put"))


def keyed(entries: DataFrame) -> DataFrame:
    """``(low, o, put, n, key)``: of sources that are equal in lower case the first one counts."""

    @F.arrow_udf("struct<low:string,n:int,key:string>")
    def key(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("low", pa.string()), ("n", pa.int32()), ("key", pa.string())])
        for batch in batches:
            rows = []
            for s in batch.to_pylist():
                n, k = key_of(low := lowered(s))
                rows.append({"low": low, "n": n, "key": k})
            yield pa.array(rows, kind)

    named = entries.select("o", key("o.source").alias("k")).groupBy("k.low").agg(
        F.min("o").alias("o"), F.first("k.n").alias("n"), F.first("k.key").alias("key"))
    return named.select("low", "o", F.col("o.put").alias("put"), "n", "key")


def with_settled_puts(entries: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Entries with the entries after them applied to their puts; a round settles those that wait for none."""

    @F.arrow_udf("array<string>")
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[*keys_in(lowered(p), sizes)] for p in batch.to_pylist()], pa.list_(pa.string()))

    @F.arrow_udf("string")
    def applied(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for puts, rules in batches:
            yield pa.array([
                Glossary([(r["low"], r["put"]) for r in some or []], settled=True).rewrite(p)
                for p, some in zip(puts.to_pylist(), rules.to_pylist())], pa.string())

    asking = entries.select("low", "o", F.explode(keys("put")).alias("key"))
    later = entries.select("key", F.struct("o", "low").alias("after"))
    found = asking.join(later, "key").filter(F.col("after.o") > F.col("o"))
    left = materialise(found.groupBy("low").agg(F.collect_set("after").alias("after")), "glossary-open")
    while not left.isEmpty():
        unsettled = left.select(F.col("low").alias("other"))
        waits = left.select("low", F.explode("after.low").alias("other")).join(unsettled, "other", "left_semi")
        waiting = waits.select("low").distinct()
        ready = left.join(waiting, "low", "left_anti").select("low", F.inline("after").alias("place", "other"))
        puts = entries.select(F.col("low").alias("other"), "put")
        rules = ready.join(puts, "other").groupBy("low").agg(F.array_sort(F.collect_list(
            F.struct("place", F.col("other").alias("low"), "put"))).alias("rules"))
        entries = materialise(entries.join(rules, "low", "left").withColumn(
            "put", F.when(F.col("rules").isNull(), F.col("put")).otherwise(applied("put", "rules"))).drop("rules"), "glossary")
        left = materialise(left.join(waiting, "low", "left_semi"), "glossary-open")
    return entries


def in_blocks(docs: DataFrame, text: str, sizes: Sequence[int]) -> DataFrame:
    """The rows with their ``__block`` of bounded size and, in ``__keys``, the keys that are new in it; written."""
    block_bytes = BLOCK_BYTES

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, filled, seen = TaskContext.get().partitionId() << 32, 0, set()
        for batch in batches:
            for a, b in cuts(batch.column(text)):
                piece = batch.slice(a, b - a)
                if filled > block_bytes:
                    number, filled, seen = number + 1, 0, set()
                filled += piece.nbytes
                fresh = []
                for t in piece.column(text).to_pylist():
                    keys = keys_in(lowered(t or ""), sizes) - seen
                    seen |= keys
                    fresh.append([*keys])
                yield pa.record_batch(
                    [*piece.columns, pa.array([number] * len(fresh), pa.int64()), pa.array(fresh, pa.list_(pa.string()))],
                    [*piece.schema.names, "__block", "__keys"])

    schema = docs.select("*", F.lit(0).cast("bigint").alias("__block"), F.array().cast("array<string>").alias("__keys")).schema
    return materialise(docs.mapInArrow(mark, schema), "glossary-blocks")


def _by_blocks(docs: DataFrame, entries: DataFrame, text: str, out: str) -> DataFrame:
    entries = materialise(keyed(entries), "glossary")
    sizes = sorted(r["n"] for r in entries.select("n").distinct().collect())
    entries = with_settled_puts(entries, sizes)
    marked = in_blocks(docs, text, sizes)
    asked = marked.select("__block", F.explode("__keys").alias("key"))
    # Both sides come from the written blocks, whose columns would be the same.
    found = asked.join(entries, "key").select(F.col("__block").alias("__at"), "o", "low", "put")

    def rewrite(rows: pa.Table, own: pa.Table) -> pa.Table:
        places = [tuple(o.values()) for o in own.column("o").to_pylist()]
        rules = sorted(zip(places, own.column("low").to_pylist(), own.column("put").to_pylist()))
        glossary = Glossary([(low, put) for _, low, put in rules], settled=True)
        done = [
            pa.array([None if t is None else glossary.rewrite(t) for t in piece.to_pylist()], pa.string())
            for chunk in rows.column("__t").chunks for piece in pieces(chunk)]
        return rows.drop_columns(["__block", "__t"]).append_column("__done", pa.chunked_array(done, pa.string()))

    rows = marked.drop("__keys").withColumn("__t", F.col(text))
    kept = [c for c in docs.columns if c != out]
    schema = docs.select(*kept, F.lit(None).cast("string").alias("__done")).schema
    done = rows.select("__block", *kept, "__t").groupBy("__block").cogroup(found.groupBy("__at")).applyInArrow(rewrite, schema)
    return done.withColumnRenamed("__done", out)


def _by_automaton(docs: DataFrame, entries: list[tuple[str, str]]):
    shared = docs.sparkSession.sparkContext.broadcast(Glossary(entries))

    @F.arrow_udf("string")
    def rewrite(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        glossary = shared.value
        for batch in batches:
            for piece in pieces(batch):
                yield pa.array([None if t is None else glossary.rewrite(t) for t in piece.to_pylist()], pa.string())

    return rewrite


def rewrite_by_table(
    docs: DataFrame, glossary: DataFrame, text: str = "text", out: str = "rewritten", run_bytes: int | None = None,
) -> DataFrame:
    """Adds the text with the entries ``(source, put)`` of a table applied; a NULL text stays NULL.

    A source whose ends are no word characters matches where no word character adjoins it. Run it on
    masked text: placeholders are words of their own. Glossaries beyond ``run_bytes`` are joined to
    the texts instead of shared; the result is the same.
    """
    limit = RUN_BYTES if run_bytes is None else run_bytes
    rows = glossary.select("source", "put")
    entries = entries_of(rows if estimated_bytes(rows) <= limit else materialise(rows, "glossary"))
    size = entries.agg(F.sum(F.length("o.source") + F.length("put") + 64)).first()[0] or 0
    if size > limit:
        return _by_blocks(docs, entries, text, out)
    run = [(r["source"], r["put"]) for r in entries.orderBy("o").select("o.source", "put").toLocalIterator()]
    res = docs.withColumn("__t", _by_automaton(docs, run)(text)) if run else docs.withColumn("__t", F.col(text))
    return res.select(*[c for c in docs.columns if c != out], F.col("__t").alias(out))
