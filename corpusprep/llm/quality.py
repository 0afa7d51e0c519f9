"""Quality rules: counts with fixed limits, then a calibrated logistic regression.

Words are runs without ASCII white space. Features of the regression are hashed word uni-
and bigrams and byte trigrams of the whole text, as shares. It is fitted on at most
``ROWS`` labelled rows of each quality (chosen by a hash of their ids); a fourth of them is
set aside to calibrate the probability, weighted back to the labels' true proportion. A
document is kept if the probability of good quality is at least ``THRESHOLD``.

Cases: a NULL text has no words and fails the base rule; labels that are NULL, or whose
document is missing, teach nothing, and a document with contradicting labels counts once for
each; with labels of one kind only (or none) the rule alone decides; repeated rows give
repeated results; an empty table gives an empty result; other columns are not read. A text is
judged whole, however long, with memory in proportion to it; of labelled rows with equal hashes
those with the smaller id are taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusprep.llm import features as ft
from corpusprep.llm.common import as_bytes, map_slices, texts

# The base rule.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 5

ROWS = 2000
BUCKETS = 1 << 14
THRESHOLD = 0.5
# Bytes per slice: the arrays of a slice take some 60 times as much.
SLICE = 1 << 20


def repeat_words(words: list[bytes], hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words inside a run of ``width`` words that occurs at two places or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    key = hashes[:n].copy()
    for k in range(1, width):
        key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[k:n + k]
    if len(np.unique(key)) == n:
        return 0
    seen: dict[tuple, int] = {}
    hit = np.zeros(n, bool)
    for i, run in enumerate(zip(*(words[k:] for k in range(width)))):
        first = seen.setdefault(run, i)
        if first != i:
            hit[first] = hit[i] = True
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + width, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen: set[bytes] = set()
    n = 0
    for line in lines:
        if line in seen:
            n += bool(line.split())
        seen.add(line)
    return n


def _code_points(text: bytes) -> int:
    data = np.frombuffer(text, np.uint8)
    return int(((data & 0xC0) != 0x80).sum())


def base_counts(text: bytes, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, repeated words."""
    return (
        len(words), _code_points(text.translate(None, SPACES)),
        len(text) - len(text.translate(None, SYMBOLS)), duplicate_lines(text), repeat_words(words, hashes))


def _ids(data, offsets, hashes):
    """Word uni- and bigram buckets per text, and one array of character buckets."""
    by_word = [[ft.word_ids(h, 1, BUCKETS), ft.word_ids(h, 2, BUCKETS)] for h in hashes]
    return by_word, ft.char_ids(data, offsets, 3, BUCKETS)


def labelled_features(docs: DataFrame, labels: DataFrame, rows: int) -> pa.Table:
    """``(quality, row)`` of the chosen labelled rows; their number is bounded by ``2 * rows``."""
    by = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        "doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    chosen = chosen.withColumn("__n", F.row_number().over(by)).filter(F.col("__n") <= rows).drop("__n")
    some = as_bytes(docs, "doc_id").join(F.broadcast(chosen), "doc_id").select("quality", "text")

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        held = texts(piece)
        data, offsets = ft.joined(held)
        by_word, by_char = _ids(data, offsets, [ft.word_hashes(t.lower().split()) for t in held])
        rows = [ft.pack(ft.shares([*w, by_char[a:b]], BUCKETS))
                for w, a, b in zip(by_word, offsets[:-1], offsets[1:])]
        return pa.record_batch([piece.column("quality"), pa.array(rows, pa.binary())], ["quality", "row"])

    return map_slices(some, "text", run, "quality int, row binary", SLICE).orderBy("quality", "row").toArrow()


def logistic(x: ft.Sparse, y: np.ndarray, columns: int, rounds: int = 300, ridge: float = 1e-2):
    """Weights and bias by gradient steps with a running scale per column."""
    w, b = np.zeros(columns), 0.0
    scale, scale_b = np.full(columns, 1e-8), 1e-8
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w) + b, -30, 30)))
        r = (p - y) * weight
        g, gb = x.transposed_dot(r, columns) + ridge * w / columns, r.sum()
        scale += g * g
        scale_b += gb * gb
        w -= 0.1 * g / np.sqrt(scale)
        b -= 0.1 * gb / np.sqrt(scale_b)
    return w, b


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """``a, c`` of the probability ``1 / (1 + exp(-(a * margin + c)))``, by Newton steps."""
    good, bad = (weight * y).sum(), (weight * (1 - y)).sum()
    goal = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    # The margin is brought to unit scale, and a step is halved until the loss falls.
    unit = max(float(np.std(margin)), 1e-9)
    z = margin / unit

    def loss(a: float, c: float) -> float:
        t = a * z + c
        return float((weight * (np.logaddexp(0, t) - goal * t)).sum()) + 0.5e-3 * a * a

    a, c = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
        r, s = weight * (p - goal), weight * p * (1 - p)
        h = np.array([[(s * z * z).sum(), (s * z).sum()], [(s * z).sum(), s.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, np.array([(r * z).sum() + 1e-3 * a, r.sum()]))
        now, scale = loss(a, c), 1.0
        while scale > 1e-6 and loss(a - scale * step[0], c - scale * step[1]) > now:
            scale /= 2
        a, c = a - scale * step[0], c - scale * step[1]
    return float(a / unit), float(c)


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> dict | None:
    """The model's tables; None unless both qualities are labelled."""
    found = labelled_features(docs, labels, rows)
    y = found.column("quality").to_numpy().astype(np.float64)
    if len(np.unique(y)) < 2:
        return None
    packed = [ft.unpack(r) for r in found.column("row").to_pylist()]
    every = {int(r["quality"]): r["count"] for r in labels.filter("quality IN (0, 1)").groupBy("quality").count().collect()}
    columns = 3 * BUCKETS
    aside = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[aside])) < 2 or len(np.unique(y[~aside])) < 2:
        aside = np.zeros(len(y), bool)
    x = ft.Sparse([p for p, out in zip(packed, aside) if not out])
    factor = x.scaled(columns)
    w, b = logistic(x, y[~aside], columns)
    w = w * factor
    held = aside if aside.any() else ~aside
    margin = ft.Sparse([p for p, inside in zip(packed, held) if inside]).dot(w) + b
    share = np.array([every.get(0, 0), every.get(1, 0)], np.float64)
    seen = np.array([(y[held] == 0).sum(), (y[held] == 1).sum()])
    weight = (share / share.sum() / np.maximum(seen, 1))[y[held].astype(int)] * held.sum()
    a, c = platt(margin, y[held], weight)
    zero = np.zeros(1)
    return {"w": [np.concatenate([w[k * BUCKETS:(k + 1) * BUCKETS], zero]) for k in range(3)], "b": b, "a": a, "c": c}


def judge(docs: DataFrame, labels: DataFrame, rows: int = ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and ``quality`` (the probability) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        held, m = texts(piece), model.value
        split = [t.split() for t in held]
        counts = np.array(
            [base_counts(t, w, ft.word_hashes(w)) for t, w in zip(held, split)], np.int64).reshape(-1, 5)
        failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
        p = np.ones(len(held))
        if m is not None:
            data, offsets = ft.joined(held)
            by_word, by_char = _ids(data, offsets, [ft.word_hashes(t.lower().split()) for t in held])
            n = np.maximum(np.diff(offsets) - 2, 1)
            margin = m["b"] + ft.sums(m["w"][2][by_char], offsets) / n
            margin += [sum(m["w"][k][i].mean() for k, i in enumerate(ids) if len(i)) for ids in by_word]
            p = 1 / (1 + np.exp(-np.clip(m["a"] * margin + m["c"], -30, 30)))
        columns = [pa.array(counts[:, k]) for k in range(5)]
        return pa.record_batch(
            [piece.column("doc_id"), *columns, pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p)],
            ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept", "quality"])

    return map_slices(as_bytes(docs, "doc_id"), "text", run, (
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, quality double"), SLICE)
