"""Language of a text by stages: the family first, then one against one inside the family.

Both stages are linear support vector machines on hashed byte n-grams (one to three bytes)
of the whole text, as shares. They are fitted on at most ``PER_LANGUAGE`` documents of each
language, chosen by a hash of their ids. Scoring sums one weight per position and machine.

Families are given by ``FAMILIES``; a language that is not listed is a family of its own.

Cases: NULL texts and texts without a letter are ``und`` with score 0; rows without id or
language teach nothing but are predicted; with one language learned all texts get it, with
none ``und``; repeated rows give repeated results; an empty table gives an empty result;
``lang``, ``source`` and ``doc_id`` are no inputs of a prediction. A text is judged whole, however
long, with memory in proportion to it; of documents with equal hashes those with the smaller id
are learned from.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusprep.llm import features as ft
from corpusprep.llm.common import as_bytes, map_slices, remainder, texts

PER_LANGUAGE = 500
BUCKETS = 1 << 12
ORDERS = (1, 2, 3)
NONE = "und"
# Bytes per slice: the arrays of a slice take some 60 times as much.
SLICE = 1 << 20

# Families of ISO 639-1 codes.
FAMILIES = {
    code: family
    for family, codes in {
        "germanic": "en de nl sv da no nb nn is af fy lb yi fo",
        "romance": "fr es it pt ro ca gl oc la sc",
        "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
        "uralic": "fi et hu",
        "celtic": "ga gd cy br",
        "baltic": "lt lv",
        "turkic": "tr az kk uz ky tk tt",
        "indic": "hi bn mr gu pa ur ne si",
        "dravidian": "ta te kn ml",
        "semitic": "ar he am mt",
    }.items() for code in codes.split()
}


def machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, columns: int, rounds: int = 30,
            cost: float = 1.0) -> np.ndarray:
    """A linear support vector machine (squared hinge) by dual coordinate descent; last weight is the bias.

    A row is its non-zero columns and their values.
    """
    w, bias = np.zeros(columns), 0.0
    alpha = np.zeros(len(rows))
    square = [float(v @ v) + 1 + 0.5 / cost for _, v in rows]
    order = np.random.default_rng(3)
    for _ in range(rounds):
        most = 0.0
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            g = y[i] * (value @ w[index] + bias) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - g / square[i], 0.0)
            if new != alpha[i]:
                w[index] += (new - alpha[i]) * y[i] * value
                bias += (new - alpha[i]) * y[i]
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return np.append(w, bias)


def _text_rows(held: list[bytes]):
    data, offsets = ft.joined(held)
    return data, offsets, [ft.char_ids(data, offsets, n, BUCKETS) for n in ORDERS]


def training_rows(docs: DataFrame, per_language: int) -> pa.Table:
    """``(lang, row)`` of the chosen documents of each language."""
    by = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang").distinct()
    chosen = chosen.withColumn("__n", F.row_number().over(by)).filter(F.col("__n") <= per_language).drop("__n")
    some = as_bytes(docs, "doc_id").join(F.broadcast(chosen), "doc_id").select("lang", "text")

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        _, offsets, ids = _text_rows(texts(piece))
        rows = [ft.pack(ft.shares([i[a:b] for i in ids], BUCKETS)) for a, b in zip(offsets[:-1], offsets[1:])]
        return pa.record_batch([piece.column("lang"), pa.array(rows, pa.binary())], ["lang", "row"])

    return map_slices(some, "text", run, "lang string, row binary", SLICE).orderBy("lang", "row").toArrow()


def fit(docs: DataFrame, families: Mapping[str, str] = FAMILIES, per_language: int = PER_LANGUAGE) -> dict:
    """The machines: one per family (two families share one), one per pair inside a family."""
    found = training_rows(docs, per_language)
    lang = np.array(found.column("lang").to_pylist(), dtype=object)
    names = sorted(set(lang.tolist()))
    columns = len(ORDERS) * BUCKETS
    x = [(i, v.astype(np.float32)) for i, v in map(ft.unpack, found.column("row").to_pylist())]
    # Columns are scaled to unit mean square, rows then have about unit length.
    total = np.zeros(columns)
    for index, value in x:
        total[index] += value.astype(np.float64) ** 2
    factor = 1 / np.sqrt(total / max(len(x), 1) + 1e-6) / np.sqrt(columns)
    x = [(index, (value * factor[index]).astype(np.float32)) for index, value in x]
    family = {n: families.get(n, n) for n in names}
    kinds = sorted(set(family.values()))
    member = np.array([kinds.index(family[n]) for n in lang], np.int64) if len(lang) else np.empty(0, np.int64)
    weights, stages = [], {"families": [], "pairs": []}

    def add(rows: np.ndarray, y: np.ndarray) -> int:
        w = machine([x[i] for i in rows], y, columns)
        weights.append((w[:-1] * factor, w[-1]))
        return len(weights) - 1

    everything = np.arange(len(lang))
    if len(kinds) == 2:
        k = add(everything, np.where(member == 1, 1.0, -1.0))
        stages["families"] = [(k, -1), (k, 1)]
    elif len(kinds) > 2:
        stages["families"] = [(add(everything, np.where(member == f, 1.0, -1.0)), 1) for f in range(len(kinds))]
    for a, b in combinations(range(len(names)), 2):
        if family[names[a]] == family[names[b]]:
            rows = np.flatnonzero((lang == names[a]) | (lang == names[b]))
            stages["pairs"].append((add(rows, np.where(lang[rows] == names[b], 1.0, -1.0)), a, b))
    table = np.zeros((len(ORDERS), BUCKETS + 1, max(1, len(weights))), np.float32)
    for m, (w, _) in enumerate(weights):
        table[:, :BUCKETS, m] = w.reshape(len(ORDERS), BUCKETS)
    return {
        "names": names, "family": [kinds.index(family[n]) for n in names], "kinds": kinds,
        "table": table, "bias": np.array([b for _, b in weights]), **stages}


def margins(held: list[bytes], model: dict) -> np.ndarray:
    """Signed distances, one column per machine."""
    _, offsets, ids = _text_rows(held)
    out = np.tile(model["bias"], (len(held), 1)).astype(np.float64)
    for k, n in enumerate(ORDERS):
        count = np.maximum(np.diff(offsets) - n + 1, 1)
        for m in range(out.shape[1]):
            out[:, m] += ft.sums(model["table"][k, :, m][ids[k]], offsets) / count
    return out


def predicted(m: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """Number of the language and a score from 0 to 1 of each row."""
    n = len(m)
    sure = lambda d: 1 / (1 + np.exp(-np.clip(2 * d, -30, 30)))
    by_family = np.zeros((n, max(1, len(model["kinds"]))))
    for f, (k, sign) in enumerate(model["families"]):
        by_family[:, f] = sign * m[:, k]
    best = by_family.argmax(1)
    score = sure(by_family.max(1)) if model["families"] else np.ones(n)
    votes = np.zeros((n, len(model["names"])))
    total = np.zeros_like(votes)
    least = np.full_like(votes, np.inf)
    for k, a, b in model["pairs"]:
        d = m[:, k]
        votes[:, b] += d > 0
        votes[:, a] += d <= 0
        for c, sign in ((a, -1), (b, 1)):
            total[:, c] += sign * d
            least[:, c] = np.minimum(least[:, c], sign * d)
    # Votes decide, the sum of distances breaks ties; other families are out.
    rank = votes + 0.5 * np.tanh(total)
    rank[np.array(model["family"])[None, :] != best[:, None]] = -np.inf
    choice = rank.argmax(1)
    inner = least[np.arange(n), choice]
    return choice, score * np.where(np.isinf(inner), 1.0, sure(inner))


_LETTER = regex.compile(r"\p{L}")


def predict(docs: DataFrame, model: dict, *keep: str, text: str = "text") -> DataFrame:
    """``(*keep, lang_pred, score)`` of every row; ``keep`` may name the text itself."""
    own = [] if text in keep else [text]
    rows = docs.select(*[F.col(c).cast("binary").alias(c) if c == text else F.col(c) for c in [*keep, *own]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(piece: pa.RecordBatch) -> pa.RecordBatch:
        held, m = texts(piece, text), shared.value
        if m["names"]:
            choice, score = predicted(margins(held, m), m)
        else:
            choice, score = np.zeros(len(held), int), np.zeros(len(held))
        blank = [not m["names"] or not _LETTER.search(t.decode("utf-8", "replace")) for t in held]
        names = [NONE if out else m["names"][c] for out, c in zip(blank, choice)]
        return pa.record_batch(
            [*(piece.column(k) for k in keep), pa.array(names, pa.string()), pa.array(np.where(blank, 0.0, score))],
            [*keep, "lang_pred", "score"])

    kinds = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep]
    found = map_slices(rows, text, run, ", ".join([*kinds, "lang_pred string, score double"]), SLICE)
    return found.withColumn(text, F.col(text).cast("string")) if text in keep else found


def identify(docs: DataFrame, modulus: int = 4, held: int = 2, **options) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learn from the other remainders, predict all."""
    rest = remainder(F.col("doc_id"), modulus)
    model = fit(docs.filter(rest != held), **options)
    marked = docs.select("doc_id", F.coalesce(rest == held, F.lit(False)).alias("held_out"), "text")
    return predict(marked, model, "doc_id", "held_out")
