"""Ranked lexical search: one Aho-Corasick automaton of all item terms reads the documents.

Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z in
lower case. The automaton holds every distinct term between two guards, so it finds whole terms
only; its output is the term's number, which stands for the items that ask for it.

1. *Scan.* Each document is read once, in stretches of bounded size cut between terms. What it
   leaves is its length and how often it holds each asked term, which is written. No index of
   documents is made.
2. *Statistics.* Number and length of documents and the document frequency of asked terms.
3. *Scores.* Each task adds the weights of a document's terms to the items that ask for them and
   keeps the best ``top`` rows per item, so few rows per task and item meet in the ranking.

What is broadcast is measured first: beyond ``PART_BYTES`` of terms or ``PART_CELLS`` (item, term)
cells, items are dealt by hash into parts, with an automaton and a scan each. An item is in one
part, so its scores are the same.

Cases: a NULL or term-less text has no terms and no length, and is not counted; an item without
terms has no result; an item whose terms no document holds has none either. Items that are
equal in id and text count once; one id with different texts is ranked for each of them.
Repeated documents are ranked each; equal scores are ordered by id, NULL last. Empty tables
give an empty result. Only the named columns are read, so other names cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusprep.llm.common import Rows, as_bytes, slices
from corpusprep.session import materialise

TOP = 20
GUARD = b" "
STRETCH = 1 << 20
PART_BYTES = 32 << 20
PART_CELLS = 1 << 18
CELLS = 1 << 20

#: Bytes of terms stay, A-Z in lower case; all others become the guard.
TO_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else GUARD[0] for b in range(256))


def stretches(text: bytes, limit: int = STRETCH):
    """A text as guarded terms, in pieces that end between terms."""
    plain = text.translate(TO_TERMS)
    start = 0
    while start < len(plain):
        stop = plain.find(GUARD, start + limit)
        stop = len(plain) if stop < 0 else stop
        yield plain[start:stop]
        start = stop


def terms_of(text: bytes) -> list[bytes]:
    """All terms in order, with repeats."""
    return [t for part in stretches(text) for t in part.split()]


def item_cells(items: DataFrame, item: str, text: str) -> DataFrame:
    """``(row, item, term, repeats)``: each item's terms; ``row`` tells items apart."""
    kind = items.schema[item].dataType.simpleString()
    rows = as_bytes(items, F.col(item).alias("item"), text=text).distinct()

    def count(batches: Rows) -> Rows:
        for batch in batches:
            for piece in slices(batch, "text"):
                for i, t in enumerate(piece.column("text").to_pylist()):
                    found = Counter(terms_of(t or b""))
                    if found:
                        n = len(found)
                        yield pa.record_batch(
                            [piece.column("item").take(pa.array([i] * n)), pa.array([t] * n, pa.binary()),
                             pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                            ["item", "text", "term", "repeats"])

    return rows.mapInArrow(count, f"item {kind}, text binary, term binary, repeats long").select(
        F.sha2("text", 256).alias("row"), "item", F.col("term").cast("string").alias("term"), "repeats")


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Of all terms between guards; a hit's value is the term's place in the list."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, t in enumerate(terms):
        found.add_word(f" {t} ", i)
    if terms:
        found.make_automaton()
    return found


def scanned(docs: DataFrame, terms: list[str], doc: Column, text: str) -> DataFrame:
    """``(doc, n, numbers, counts)`` of documents with a term: length, and hits by term number."""
    kind = docs.select(doc.alias("doc")).dtypes[0][1]
    rows = as_bytes(docs, doc.alias("doc"), text=text).filter(F.octet_length("text") > 0)
    shared = docs.sparkSession.sparkContext.broadcast(automaton(terms))

    def run(batches: Rows) -> Rows:
        hits, value = shared.value, itemgetter(1)
        for batch in batches:
            for piece in slices(batch, "text"):
                keep, lengths, numbers, counts = [], [], [], []
                for i, t in enumerate(piece.column("text").to_pylist()):
                    n, found = 0, Counter()
                    for part in stretches(t):
                        n += len(part.split())
                        if terms:
                            found.update(map(value, hits.iter(f" {part.decode("utf-8", "replace")} ")))
                    if n:
                        keep.append(i)
                        lengths.append(n)
                        numbers.append(list(found))
                        counts.append(list(found.values()))
                yield pa.record_batch(
                    [piece.column("doc").take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()),
                     pa.array(numbers, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                    ["doc", "n", "numbers", "counts"])

    return rows.mapInArrow(run, f"doc {kind}, n long, numbers array<int>, counts array<bigint>")


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Best:
    """The rows with the highest scores of each item, equal scores by id."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.zeros(items, np.int64)
        self.item = self.score = np.empty(0, np.int64)
        self.docs: list = []

    def add(self, scores: np.ndarray, docs: list) -> None:
        """``scores`` has a row per document; those that cannot be among the best are passed over."""
        if len(scores) > self.top:
            self.least = np.maximum(self.least, np.partition(scores, -self.top, axis=0)[-self.top])
        row, item = np.nonzero((scores > 0) & (scores >= self.least))
        if not len(row):
            return
        self.item = np.concatenate([self.item, item])
        self.score = np.concatenate([self.score, scores[row, item]])
        self.docs += [docs[r] for r in row.tolist()]
        # Ids of any type: ties by rank among the ids at hand, NULL last.
        ids = sorted({d for d in self.docs if d is not None})
        place = {d: i for i, d in enumerate(ids)} | {None: len(ids)}
        by = np.lexsort([np.fromiter(map(place.__getitem__, self.docs), np.int64, len(self.docs)), -self.score, self.item])
        kinds = self.item[by]
        first = np.searchsorted(kinds, kinds)
        nth = np.arange(len(by)) - first
        self.least[kinds[nth == self.top - 1]] = self.score[by][nth == self.top - 1]
        by = by[nth < self.top]
        self.item, self.score = self.item[by], self.score[by]
        self.docs = [self.docs[i] for i in by.tolist()]


def scored(
    counts: DataFrame, cells: list[tuple[int, int, int]], n_items: int, documents: int, length: int, df: dict[int, int],
    top: int,
) -> DataFrame:
    """``(item, doc, score)``: the best rows of each task; ``cells`` are (term number, item number, repeats)."""
    kind, doc_type = dict(counts.dtypes)["doc"], to_arrow_type(counts.schema["doc"].dataType)
    spread = np.array(sorted(cells), np.int64).reshape(-1, 3)
    n_terms = int(spread[:, 0].max(initial=-1)) + 1
    starts = np.searchsorted(spread[:, 0], np.arange(n_terms + 1))
    weights = np.array([weight(documents, df.get(t, 0)) for t in range(n_terms)], np.int64)
    shared = counts.sparkSession.sparkContext.broadcast((starts, spread[:, 1].copy(), spread[:, 2] * weights[spread[:, 0]]))
    per_slice = max(1, CELLS // max(1, n_items))

    def run(batches: Rows) -> Rows:
        starts, items, gains = shared.value
        best = Best(n_items, top)
        for batch in batches:
            for at in range(0, batch.num_rows, per_slice):
                piece = batch.slice(at, per_slice)
                tf = piece.column("counts").flatten().to_numpy(zero_copy_only=False)
                term = piece.column("numbers").flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(piece.num_rows), piece.column("numbers").value_lengths().to_numpy())
                known = term < len(starts) - 1
                tf, term, row = tf[known], term[known], row[known]
                n = piece.column("n").to_numpy()
                m = 100 - 25 + (25 * n * documents) // length
                part = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
                sizes = starts[term + 1] - starts[term]
                cell = np.repeat(starts[term] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                scores = np.zeros((piece.num_rows, n_items), np.int64)
                np.add.at(scores, (np.repeat(row, sizes), items[cell]), gains[cell] * np.repeat(part, sizes))
                best.add(scores, piece.column("doc").to_pylist())
        yield pa.record_batch(
            [pa.array(best.item, pa.int32()), pa.array(best.docs, doc_type), pa.array(best.score, pa.int64())],
            ["item", "doc", "score"])

    return counts.mapInArrow(run, f"item int, doc {kind}, score long")


def search(
    docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", top: int = TOP, part_bytes: int | None = None, part_cells: int | None = None,
) -> DataFrame:
    """``(item, rank, doc, score)``: the ``top`` documents of each item with a score above 0."""
    spark = docs.sparkSession
    cells = materialise(item_cells(items, item, item_text), "item-terms")
    asked = cells.groupBy("row", "item").agg(F.count("*").alias("cells"), F.sum(F.octet_length("term") + 16).alias("bytes"))
    total = asked.agg(F.sum("cells").alias("cells"), F.sum("bytes").alias("bytes")).first()
    parts = 1 + max((total["cells"] or 0) // (part_cells or PART_CELLS), (total["bytes"] or 0) // (part_bytes or PART_BYTES))

    ranked = None
    for part in range(parts):
        mine = cells.filter(F.pmod(F.xxhash64("row", "item"), F.lit(parts)) == part).orderBy("item", "row", "term").collect()
        found = _best_of(docs, mine, doc, text, top)
        named = spark.createDataFrame(
            list(enumerate(dict.fromkeys((r["row"], r["item"]) for r in mine))),
            f"number int, key struct<row string, item {items.schema[item].dataType.simpleString()}>")
        some = found.join(F.broadcast(named), found["item"] == named["number"]).select("key", "doc", "score")
        ranked = some if ranked is None else ranked.unionByName(some)
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        F.col("key.item").alias(item), "rank", F.col("doc").alias(doc), "score")


def _best_of(docs: DataFrame, cells: list, doc: str, text: str, top: int) -> DataFrame:
    terms = {t: i for i, t in enumerate(dict.fromkeys(r["term"] for r in cells))}
    rows = {k: i for i, k in enumerate(dict.fromkeys((r["row"], r["item"]) for r in cells))}
    counts = materialise(scanned(docs, list(terms), F.col(doc), text), "term-counts")
    size = counts.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
    df = counts.select(F.explode("numbers").alias("t")).groupBy("t").count()
    placed = [(terms[r["term"]], rows[r["row"], r["item"]], r["repeats"]) for r in cells]
    return scored(
        counts, placed, len(rows), size["documents"], size["length"] or 1, {r["t"]: r["count"] for r in df.collect()}, top)
