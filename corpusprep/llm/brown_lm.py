"""A Brown class bigram model: exchange clustering, then class-transition and word-emission probabilities.

Words are lower-cased (A-Z) runs without ASCII white space; an end token closes each text.
All counts cover every training document. Texts are split once, into numbered words of blocks,
and a block's neighbours are counted once; all that follows works on these counts. The classes
start from the ``HEAD`` most frequent words, which are clustered on their bigram counts, first
into ``CLASSES`` classes, and these classes' items again into ``GROUPS`` groups. Every other word
starts in the class of its count's magnitude in the group of frequent words that most often
stands right before it.

Then all words are exchanged, in up to ``TURNS`` turns. A turn takes the classes of the words from
their buckets to the blocks that have them, and the classes beside each word, summed up, from the
blocks to the word's bucket; the bounded class-by-class table is broadcast. Each word's exact gain in likelihood, all
other words staying, follows from these, and it moves to its best class. As words of a turn do
not see each other's moves, a turn that lowers the likelihood is taken back, and half as many
words are asked in the next one. Each turn's classes are written. Words and their classes are
neither collected nor broadcast, whatever their number.

``P(text)`` is the product of ``P(class | class before) * P(word | class)``, the end token
included. Transitions are smoothed with the class distribution. Words seen once lend half of
their mass to the unseen word, which counts as one word as in the base score. After an unseen
word the transitions are those of the classes of words seen once, by their share.

Cases: a NULL text is the empty one (one end token); a row without id is scored but neither
held out nor learned from; repeated rows count as often as they occur; with no training text
every word is unseen and the scores stay finite; an empty table gives an empty result; a text
longer than a block is a block of its own; words with equal counts are ordered by their bytes,
and of classes with equal gain the first is taken; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.blocks import (
    buckets_for, by_number, documents_of, meet, neighbours, numbered, pack, pack_words, pairs_of, pieces_of, placed,
    unpack, unpack_words, width, words_of)
from corpusprep.llm.common import as_bytes, gather, remainder, short_lived_shuffles
from corpusprep.session import materialise

HEAD = 1000
CLASSES = 64
GROUPS = 8
BANDS = 40
ROUNDS = 8
TURNS = 3
SLICE_WORDS = 4096
SLICE_ROWS = 256
SHORT = 8
PARTS = 64
FEW = 6
SMALL = 16
PRIOR = 20.0
UNSEEN = 0.5
END = b"\n"


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def _xlogx(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, n * np.log(np.maximum(n, 1e-300)), 0.0)


def exchange(bigrams: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Classes of items that locally maximise the class-bigram likelihood.

    Items are visited by falling frequency. The first ones open a class each, the others
    join the class that gains most; then each item moves to where it gains most.
    """
    items = len(bigrams)
    classes = max(1, min(classes, items))
    m = bigrams.astype(np.float64)
    order = np.argsort(-(m.sum(0) + m.sum(1)), kind="stable")
    of = np.full(items, classes)
    n = np.zeros((classes, classes))
    for turn in range(rounds):
        moved = 0
        for seat, w in enumerate(order):
            own, self_ = of[w], m[w, w]
            # Items without a class yet count for none.
            right = np.bincount(of, weights=m[w], minlength=classes + 1)
            left = np.bincount(of, weights=m[:, w], minlength=classes + 1)
            right[own] -= self_
            left[own] -= self_
            right, left = right[:classes], left[:classes]
            if turn:
                n[own] -= right
                n[:, own] -= left
                n[own, own] -= self_
            rows, cols = n.sum(1), n.sum(0)
            by_row = _xlogx(n + right) - _xlogx(n)
            by_col = _xlogx(n + left[:, None]) - _xlogx(n)
            d = np.arange(classes)
            gain = by_row.sum(1) - by_row[d, d] + by_col.sum(0) - by_col[d, d]
            gain += _xlogx(n[d, d] + right + left + self_) - _xlogx(n[d, d])
            gain -= _xlogx(rows + right.sum() + self_) - _xlogx(rows)
            gain -= _xlogx(cols + left.sum() + self_) - _xlogx(cols)
            best = int(np.argmax(gain))
            if not turn and seat < classes:
                best = seat
            elif turn and gain[best] <= gain[own] + 1e-9:
                best = own
            moved += best != own
            of[w] = best
            n[best] += right
            n[:, best] += left
            n[best, best] += self_
        if not moved:
            break
    return of


def vocabulary(words: DataFrame, buckets: int) -> DataFrame:
    """What buckets know of their words, written.

    Rows without a block are the words a bucket has learned, by falling count and then by bytes:
    ``words``, ``n``, and their ``total`` and ``distinct`` number. Rows with a block say for each of the
    block's ``numbers`` which of these words it is, ``at``, from 1 on; 0 is none.
    """

    def index(table: pa.Table) -> pa.Table:
        lists = [unpack_words(w) for w in table.column("words").to_pylist()]
        place = {w: i for i, w in enumerate(sorted(set().union(*lists)))}
        seats = [np.fromiter(map(place.__getitem__, held), np.int64, len(held)) for held in lists]
        n = np.zeros(len(place), np.int64)
        for seat, counts in zip(seats, table.column("n").to_pylist()):
            n[seat] += unpack(counts)
        order = np.argsort(-n, kind="stable")[:int((n > 0).sum())]
        at = np.zeros(len(place), np.int64)
        at[order] = np.arange(1, len(order) + 1)
        names, rows = list(place), len(lists)
        bucket = table.column("bucket")[0].as_py()
        return pa.table({
            "bucket": pa.array([bucket] * (rows + 1), pa.int32()),
            "block": pa.array([None, *table.column("block").to_pylist()], pa.int64()),
            "words": pa.array([pack_words([names[i] for i in order.tolist()]), *[None] * rows], pa.binary()),
            "n": pa.array([pack(n[order]), *[None] * rows], pa.binary()),
            "total": pa.array([int(n.sum()), *[None] * rows], pa.int64()),
            "distinct": pa.array([len(order), *[None] * rows], pa.int64()),
            "numbers": pa.array([None, *table.column("numbers").to_pylist()], pa.binary()),
            "at": pa.array([None, *[pack(at[seat]) for seat in seats]], pa.binary())})

    rows = words.groupBy("bucket").applyInArrow(index, (
        "bucket int, block long, words binary, n binary, total long, distinct long, numbers binary, at binary"))
    return placed(rows, "bucket", buckets, "vocabulary")


def most_frequent(learned: DataFrame, head: int) -> list:
    """``(bucket, at)`` of the end token, if there is any, and of the ``head`` most frequent other words."""

    def first(batches):
        for batch in batches:
            for bucket, blob, n in zip(*(batch.column(c).to_pylist() for c in ("bucket", "words", "n"))):
                words, counts = unpack_words(blob), unpack(n).tolist()
                some = [i for i, w in enumerate(words) if i <= head or w == END]
                yield pa.record_batch(
                    [pa.array([bucket] * len(some), pa.int32()), pa.array(some, pa.int64()),
                     pa.array([words[i] for i in some], pa.binary()), pa.array([counts[i] for i in some], pa.int64())],
                    ["bucket", "at", "word", "n"])

    rows = learned.select("bucket", "words", "n").mapInArrow(first, "bucket int, at long, word binary, n long")
    is_end = F.col("word") == F.lit(bytearray(END))
    found = rows.orderBy(is_end.desc(), F.desc("n"), "word").limit(head + 1).collect()
    return [(r["bucket"], r["at"]) for r in found] if found and bytes(found[0]["word"]) == END else []


def classes_of(index: DataFrame, classed: DataFrame) -> DataFrame:
    """``(block, bucket, numbers, at, class)``: the classes go to the blocks; 0 is none."""

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        of = np.concatenate([[0], *[unpack(c) for c in right.column("class").to_pylist()[:1]]])
        found = [pack(of[unpack(at)]) for at in left.column("at").to_pylist()]
        return pa.table({c: left.column(c) for c in ("block", "bucket", "numbers", "at")} | {"class": pa.array(found, pa.binary())})

    return meet(index, classed.select("bucket", "class"), "bucket", look_up,
                "block long, bucket int, numbers binary, at binary, class binary")


def words_of_block(known: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class (-1: none), bucket and place there of a block's words, by number."""
    bucket = np.zeros(size, np.int64)
    for b, numbers in zip(known.column("bucket").to_pylist(), known.column("numbers").to_pylist()):
        bucket[unpack(numbers)] = b
    return by_number(known, "class", size, 0) - 1, bucket, by_number(known, "at", size, 0) - 1


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of counts of each."""
    if not len(keys):
        return keys, counts
    bits = int(counts.max()).bit_length()
    if int(keys.max()).bit_length() + bits < 64:
        # Both fit into one number: it is sorted as such, which is much faster than sorting places.
        both = np.sort(keys << bits | counts)
        keys, counts = both >> bits, both & ((1 << bits) - 1)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _pair_counts(pairs: DataFrame, known: DataFrame, kinds: int) -> np.ndarray:
    """How often which class stands before which, over all texts; words without a class are left out."""

    def count(left: pa.Table, words: pa.Table) -> pa.Table:
        a, b, n = neighbours(left.column("pair").to_pylist())
        of = by_number(words, "class", width(words, a, b), 0) - 1
        a, b = of[a], of[b]
        some = (a >= 0) & (b >= 0)
        # Sums of whole numbers in doubles are exact far beyond a block.
        sums = np.bincount(a[some] * kinds + b[some], n[some], kinds * kinds).astype(np.int64)
        cell = np.flatnonzero(sums)
        return pa.table({"cell": pa.array(cell, pa.int64()), "n": pa.array(sums[cell], pa.int64())})

    rows = meet(pairs, known.select("block", "numbers", "class"), "block", count, "cell long, n long")
    got = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(kinds * kinds, np.int64)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(kinds, kinds)


PACKED = "bucket int, part long, word binary, code binary, n binary"


def _to_buckets(left: pa.Table, bucket: np.ndarray, word: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.Table:
    """Counts of a block by word and code, packed for the words' buckets."""
    # Narrow numbers are sorted by their digits.
    bucket = bucket.astype(np.min_scalar_type(int(bucket.max(initial=0))))
    order = np.argsort(bucket, kind="stable")
    there, first = np.unique(bucket[order], return_index=True)
    cut = lambda x: pa.array([pack(p) for p in np.split(x[order], first[1:])] if len(there) else [], pa.binary())
    part = left.column("block")[0].as_py() if left.num_rows else 0
    return pa.table({"bucket": pa.array(there.astype(np.int32)), "part": pa.array([part] * len(there), pa.int64()),
                     "word": cut(word), "code": cut(code), "n": cut(n)})


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    join = lambda c: np.concatenate([np.empty(0, np.int64), *map(unpack, table.column(c).to_pylist())])
    return join("word"), join("code"), join("n")


def _gathered(rows: DataFrame, pairs: DataFrame, codes: int) -> DataFrame:
    """Packed counts, so summed up that a bucket takes in those of a bounded number of parts."""

    def merge(table: pa.Table) -> pa.Table:
        word, code, n = _unpacked(table)
        keys, n = _summed(word * codes + code, n)
        return pa.table({
            "bucket": table.column("bucket")[:1], "part": table.column("group")[:1],
            "word": pa.array([pack(keys // codes)], pa.binary()), "code": pa.array([pack(keys % codes)], pa.binary()),
            "n": pa.array([pack(n)], pa.binary())})

    parts = pairs.select("block").distinct().count()
    while parts > PARTS:
        parts = -(-parts // PARTS)
        group = F.pmod(F.xxhash64("part"), F.lit(parts)).cast("bigint")
        rows = rows.withColumn("group", group).groupBy("bucket", "group").applyInArrow(merge, PACKED)
    return rows


def _beside(pairs: DataFrame, known: DataFrame, kinds: int) -> DataFrame:
    """How often which class stands beside each word, packed for the words' buckets.

    Code ``c`` is class ``c`` after the word, ``kinds + c`` before it, and ``2 * kinds`` the word
    itself after it, which the others leave out.
    """
    codes = 2 * kinds + 1

    def count(left: pa.Table, words: pa.Table) -> pa.Table:
        a, b, n = neighbours(left.column("pair").to_pylist())
        of, bucket, at = words_of_block(words, width(words, a, b))
        same = a == b
        keys, n = _summed(
            np.concatenate([a * codes + np.where(same, 2 * kinds, of[b]), (b * codes + kinds + of[a])[~same]]),
            np.concatenate([n, n[~same]]))
        word = keys // codes
        return _to_buckets(left, bucket[word], at[word], keys - word * codes, n)

    return _gathered(meet(pairs, known, "block", count, PACKED), pairs, codes)


def likelihood(table: np.ndarray) -> float:
    """Log-likelihood of the texts under the classes, up to a constant of the words."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(1)).sum() - _xlogx(table.sum(0)).sum())


def small_steps(table: np.ndarray) -> list[list[np.ndarray]]:
    """For each side and each count up to ``SMALL``: what class ``d`` beside a word adds to its gain in each class."""
    f = _xlogx(table)
    return [[np.ascontiguousarray((_xlogx(cells + v) - logs).T) for v in range(1, SMALL + 1)]
            for cells, logs in ((table, f), (table.T, f.T))]


def gains(
    table: np.ndarray, own: np.ndarray, n: np.ndarray, word: np.ndarray, code: np.ndarray, count: np.ndarray,
    steps: list[list[np.ndarray]] | None = None,
):
    """Gain in likelihood of each word in each class, over the word in none.

    ``word, code, count`` are the words' neighbours, in order of word and code; ``steps`` are the table's
    ``small_steps``, where they are there.
    """
    steps = steps or small_steps(table)
    kinds, words = len(table), len(own)
    f, size = _xlogx(table), table.sum(1)
    out = np.zeros((words, kinds))
    # Of the own class: what leaves with the word.
    mine = np.zeros(words)
    right, left, self_ = np.zeros((words, kinds)), np.zeros((words, kinds)), np.zeros(words)
    is_right, is_self = code < kinds, code == 2 * kinds
    is_left = ~is_right & ~is_self
    right[word[is_right], code[is_right]] = count[is_right]
    left[word[is_left], code[is_left] - kinds] = count[is_left]
    self_[word[is_self]] = count[is_self]
    seat = np.arange(words)
    for there, offset, other, cells, across, logs, small in (
            (is_right, 0, left, table, np.ascontiguousarray(table.T), np.ascontiguousarray(f.T), steps[0]),
            (is_left, kinds, right, table.T, table, f, steps[1])):
        w, d, c = word[there], code[there] - offset, count[there]
        # cells[b, d] grows by c when the word joins class b; the word's own class is apart.
        apart = d == own[w]
        for v in range(1, SMALL + 1):
            hit = np.flatnonzero((c == v) & ~apart)
            if len(hit):
                _add_rows(out, w[hit], small[v - 1], d[hit])
        many = np.flatnonzero((c > SMALL) & ~apart)
        for start in range(0, len(many), SLICE_WORDS):
            hit = many[start:start + SLICE_WORDS]
            step = _xlogx(across[d[hit]] + c[hit, None]) - logs[d[hit]]
            _add_rows(out, w[hit], step, np.arange(len(hit)))
        # Here the word's own occurrences are in the cells.
        hit = np.flatnonzero(apart)
        base = np.maximum(across[d[hit]] - other[w[hit]], 0)
        _add_rows(out, w[hit], _xlogx(base + c[hit, None]) - _xlogx(base), np.arange(len(hit)))
        value = cells[own[w], d]
        mine += np.bincount(w, np.where(apart, 0, _xlogx(value) - _xlogx(value - c)), words)
    # The cell of a class with itself gets both sides at once.
    both = right + left + self_[:, None]
    w, d = np.nonzero(both)
    cell = np.diag(table)[d]
    out[w, d] += _xlogx(cell + both[w, d]) - _xlogx(cell + right[w, d]) - _xlogx(cell + left[w, d]) + _xlogx(cell)
    value = table[own, own]
    mine += _xlogx(value) - _xlogx(value - both[seat, own])
    each, at = np.unique(n, return_inverse=True)
    out -= 2 * (_xlogx(size + each[:, None]) - _xlogx(size))[at]
    mine -= 2 * (_xlogx(size[own]) - _xlogx(size[own] - n))
    out[seat, own] = mine
    return out


def _add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray, index: np.ndarray) -> None:
    """``out[at] += rows[index]`` for rising ``at``.

    Most runs of an ``at`` are short. Those of a length are added up together, whole rows at a time and in the
    order of ``np.add.reduceat``, which walks each column of each run by itself.
    """
    if not len(at):
        return
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    sizes = np.diff(first, append=len(at))
    for size in range(1, SHORT + 1):
        starts = first[sizes == size]
        for cut in range(0, len(starts), SLICE_ROWS):
            some = starts[cut:cut + SLICE_ROWS]
            sums = rows[index[some + (size > 1)]]
            for i in range(2, size):
                sums += rows[index[some + i]]
            if size > 1:
                sums += rows[index[some]]
            out[at[some]] += sums
    long = np.flatnonzero(sizes > SHORT)
    for cut in range(0, len(long), SLICE_ROWS):
        some = long[cut:cut + SLICE_ROWS]
        entries, each = gather(index, np.append(first, len(at)), some)
        out[at[first[some]]] += np.add.reduceat(rows[entries], np.cumsum(each) - each, axis=0)


def _alike(own: np.ndarray, n: np.ndarray, word: np.ndarray, code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the number of its kind, and the first word of each kind, in order.

    Words with at most ``FEW`` neighbours are of a kind if they agree in all; each other word is its own kind.
    """
    begin = np.searchsorted(word, np.arange(len(own) + 1))
    few = np.flatnonzero(np.diff(begin) <= FEW)
    rows = np.full((len(few), 2 + 2 * FEW), -1, np.int64)
    rows[:, 0], rows[:, 1] = own[few], n[few]
    for i in range(FEW):
        at = begin[few] + i
        there = at < begin[few + 1]
        rows[there, 2 + 2 * i], rows[there, 3 + 2 * i] = code[at[there]], count[at[there]]
    packed = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel()
    _, one, kind = np.unique(packed, return_index=True, return_inverse=True)
    head = np.arange(len(own))
    head[few] = few[one][kind]
    first = np.unique(head)
    return np.searchsorted(first, head), first


CLASSED = "bucket int, class binary, n binary"


def _moved(classed: DataFrame, pairs: DataFrame, index: DataFrame, table: np.ndarray, turn: int, parts: int) -> DataFrame:
    """The words' classes after one turn, in which one of ``parts`` words is asked."""
    kinds = len(table)
    codes = 2 * kinds + 1
    shared = classed.sparkSession.sparkContext.broadcast(table)

    def move(left: pa.Table, right: pa.Table) -> pa.Table:
        own, n = (unpack(right.column(c)[0].as_py()) for c in ("class", "n"))
        own = own - 1
        word, code, count = _unpacked(left)
        keys, count = _summed(word * codes + code, count)
        word = keys // codes
        code = keys - word * codes
        # Words with the same class and the same few neighbours have the same gains: one of them is asked.
        alike, first = _alike(own, n, word, code, count)
        place = np.full(len(own), -1)
        place[first] = np.arange(len(first))
        of_first = place[word]
        word, code, count = of_first[of_first >= 0], code[of_first >= 0], count[of_first >= 0]
        best = own[first].copy()
        steps = small_steps(shared.value)
        for start in range(0, len(first), SLICE_WORDS):
            some = first[start:start + SLICE_WORDS]
            a, b = np.searchsorted(word, [start, start + SLICE_WORDS])
            gain = gains(
                shared.value, own[some], n[some].astype(np.float64), word[a:b] - start, code[a:b], count[a:b].astype(np.float64), steps)
            to, at = gain.argmax(1), np.arange(len(gain))
            better = gain[at, to] > gain[at, own[some]] + 1e-9
            best[start:start + SLICE_WORDS] = np.where(better, to, own[some])
        to = np.where(np.arange(len(own)) % parts == turn % parts, best[alike], own)
        return pa.table({"bucket": right.column("bucket")[:1], "class": pa.array([pack(to + 1)], pa.binary()),
                         "n": right.column("n")[:1]})

    out = materialise(
        meet(_beside(pairs, classes_of(index, classed), kinds), classed, "bucket", move, CLASSED), "classes")
    shared.destroy()
    return out


def exchange_all(
    pairs: DataFrame, index: DataFrame, classed: DataFrame, kinds: int, turns: int = TURNS,
) -> tuple[DataFrame, np.ndarray]:
    """``(classes, table)`` after exchanging every word; the likelihood never falls."""
    best = None
    parts = 1
    for turn in range(turns + 1):
        table = _pair_counts(pairs, classes_of(index, classed), kinds).astype(np.float64)
        if best is None or likelihood(table) >= best[0]:
            settled = best is not None and likelihood(table) - best[0] <= 1e-9 * abs(best[0]) and parts == 1
            best = (likelihood(table), classed, table)
            if settled:
                break
        else:
            parts *= 2
        if turn < turns:
            classed = _moved(best[1], pairs, index, best[2], turn, parts)
    return best[1], best[2]


def _start(
    pairs: DataFrame, learned: DataFrame, index: DataFrame, top: list, classes: int, groups: int,
) -> tuple[DataFrame, int]:
    """The classes the words start from, and how many there are."""
    spark = learned.sparkSession

    def given(values) -> DataFrame:
        """Classes of the most frequent words alone."""
        by_bucket: dict = {}
        for (bucket, at), value in zip(top, values):
            by_bucket.setdefault(bucket, []).append((at, int(value)))

        def fill(batches):
            for batch in batches:
                out = []
                for bucket, distinct in zip(batch.column("bucket").to_pylist(), batch.column("distinct").to_pylist()):
                    of = np.zeros(distinct, np.int64)
                    for at, value in by_bucket.get(bucket, []):
                        of[at] = value + 1
                    out.append(pack(of))
                yield pa.record_batch([batch.column("bucket"), pa.array(out, pa.binary()), batch.column("n")], ["bucket", "class", "n"])

        return learned.select("bucket", "distinct", "n").mapInArrow(fill, CLASSED)

    matrix = _pair_counts(pairs, classes_of(index, given(range(len(top)))), max(1, len(top)))
    of = exchange(matrix, classes)
    n_classes = int(of.max()) + 1
    pick = np.eye(n_classes, dtype=np.int64)[of]
    group_of = exchange(pick.T @ matrix @ pick, groups)[of]
    n_groups = int(group_of.max()) + 1

    # The other words start by their count, in the group of frequent words that most often precede them.
    def votes(left: pa.Table, known: pa.Table) -> pa.Table:
        a, b, n = neighbours(left.column("pair").to_pylist())
        group, bucket, at = words_of_block(known, width(known, a, b))
        some = (group[a] >= 0) & (group[b] < 0)
        keys, n = _summed(b[some] * n_groups + group[a[some]], n[some])
        word = keys // n_groups
        return _to_buckets(left, bucket[word], at[word], keys % n_groups, n)

    voted = _gathered(
        meet(pairs, classes_of(index, given(group_of[:len(top)])), "block", votes, PACKED), pairs, n_groups)

    def begin(left: pa.Table, right: pa.Table) -> pa.Table:
        own, n = (unpack(right.column(c)[0].as_py()) for c in ("class", "n"))
        word, group, count = _unpacked(left)
        votes_ = np.zeros((len(own), n_groups), np.int64)
        np.add.at(votes_, (word, group), count)
        band = np.minimum(np.log2(n).astype(np.int64), BANDS - 1)
        code = np.where(own > 0, own - 1, n_classes + votes_.argmax(1) * BANDS + band)
        return pa.table({"bucket": right.column("bucket")[:1], "class": pa.array([pack(code)], pa.binary()),
                         "n": right.column("n")[:1], "used": pa.array([np.unique(code).tolist()], pa.list_(pa.int32()))})

    coded = materialise(meet(voted, given(of[:len(top)]), "bucket", begin, CLASSED + ", used array<int>"), "start")
    # Only the classes that have words are numbered.
    used = sorted(r[0] for r in coded.select(F.explode("used")).distinct().collect())
    seats = np.zeros(max(used, default=0) + 1, np.int64)
    seats[used] = np.arange(1, len(used) + 1)

    def renumber(batches):
        for batch in batches:
            yield pa.record_batch(
                [batch.column("bucket"), pa.array([pack(seats[unpack(c)]) for c in batch.column("class").to_pylist()], pa.binary()),
                 batch.column("n")], ["bucket", "class", "n"])

    return coded.select("bucket", "class", "n").mapInArrow(renumber, CLASSED), max(1, len(used))


def _class_sums(batches):
    """Occurrences of each class, and how many of its words were seen once."""
    for batch in batches:
        for c, n in zip(batch.column("class").to_pylist(), batch.column("n").to_pylist()):
            of, n = unpack(c) - 1, unpack(n)
            there, at = np.unique(of, return_inverse=True)
            once = np.bincount(at, n == 1, len(there)).astype(np.int64)
            total = np.zeros(len(there), np.int64)
            np.add.at(total, at, n)
            yield pa.record_batch([pa.array(there, pa.int64()), pa.array(total), pa.array(once)], ["class", "n", "once"])


def train(docs: DataFrame, head: int = HEAD, classes: int = CLASSES, groups: int = GROUPS, turns: int = TURNS,
          **sizes: int):
    """``(lexicon, facts)`` of all texts: class and count of each word, and the model's tables."""
    buckets = sizes.pop("buckets", None) or buckets_for(docs)
    held = numbered(docs.select("text", F.lit(True).alias("learn")), tokens, learn="learn", buckets=buckets, **sizes)
    return train_blocks(held, buckets, head, classes, groups, turns)


def train_blocks(held: DataFrame, buckets: int, head: int = HEAD, classes: int = CLASSES, groups: int = GROUPS, turns: int = TURNS):
    """``train`` on the texts to learn from of a table of blocks."""
    pairs = pairs_of(held)
    rows = vocabulary(words_of(held), buckets)
    learned = rows.filter("block IS NULL AND distinct > 0").select("bucket", "words", "n", "total", "distinct")
    index = rows.filter("block IS NOT NULL").select("bucket", "block", "numbers", "at")
    total, distinct = learned.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    classed, n_kinds = _start(pairs, learned, index, most_frequent(learned, head), classes, groups)

    # From here on every word is exchanged, over the classes the start has opened.
    classed, table = exchange_all(pairs, index, classed, n_kinds, turns)
    # The last class is that of the unseen word alone.
    sizes_of, singles = np.zeros(n_kinds + 1), np.zeros(n_kinds + 1)
    got = classed.select("class", "n").mapInArrow(_class_sums, "class long, n long, once long").groupBy("class").agg(
        F.sum("n").alias("n"), F.sum("once").alias("once")).toArrow()
    sizes_of[got.column("class").to_numpy()] = got.column("n").to_numpy()
    singles[got.column("class").to_numpy()] = got.column("once").to_numpy()
    # It has mass of its own only if no word was seen once.
    alone = 0.0 if singles.sum() else 1.0
    share = sizes_of.copy()
    share[-1] = alone
    share /= share.sum()
    move = (np.pad(table, (0, 1)) + PRIOR * share) / (np.pad(table.sum(1), (0, 1))[:, None] + PRIOR)
    if singles.sum():
        move[-1] = singles @ move / singles.sum()
    lent = UNSEEN * singles / np.maximum(sizes_of, 1)
    lent[-1] = alone
    lexicon = learned.select("bucket", "words").join(classed, "bucket")
    return lexicon, {
        "total": int(total), "distinct": int(distinct), "move": np.log10(np.maximum(move, 1e-300)),
        "unseen": np.log10(move @ lent), "size": sizes_of, "buckets": buckets,
    }


def listed(lexicon: DataFrame) -> DataFrame:
    """``(word, class, n)``: a lexicon's words, a row each."""

    def run(batches):
        for batch in batches:
            for words, c, n in zip(*(batch.column(k).to_pylist() for k in ("words", "class", "n"))):
                yield pa.record_batch([pa.array(unpack_words(words), pa.binary()), pa.array(unpack(c) - 1), pa.array(unpack(n))],
                                      ["word", "class", "n"])

    return lexicon.select("words", "class", "n").mapInArrow(run, "word binary, class long, n long")


def score(docs: DataFrame, lexicon: DataFrame, facts: dict, *keep: str, text: str = "text", **sizes: int) -> DataFrame:
    """``(*keep, n_tokens, n_known, base_score, score)`` of every row."""
    names = [f"__k{i}" for i in range(len(keep))]
    rows = as_bytes(docs, *[F.col(k).alias(n) for k, n in zip(keep, names)], text=text)
    held = numbered(rows, tokens, names, buckets=facts["buckets"], **sizes)
    return score_blocks(held, lexicon, facts, *names).withColumnsRenamed(dict(zip(names, keep)))


def score_blocks(held: DataFrame, lexicon: DataFrame, facts: dict, *keep: str) -> DataFrame:
    """``score`` of the documents of a table of blocks with as many buckets as the lexicon."""
    kinds = [f"`{k}` {held.schema[k].dataType.elementType.simpleString()}" for k in keep]
    shared = held.sparkSession.sparkContext.broadcast(facts)

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        of, n, place = np.zeros(1, np.int64), np.zeros(1, np.int64), {}
        if right.num_rows:
            words, c, counts = (right.column(k)[0].as_py() for k in ("words", "class", "n"))
            place = {w: i for i, w in enumerate(unpack_words(words), 1)}
            of, n = np.concatenate([of, unpack(c)]), np.concatenate([n, unpack(counts)])
        found = [np.array([place.get(w, 0) for w in unpack_words(b)], np.int64) for b in left.column("words").to_pylist()]
        return pa.table({"block": left.column("block"), "numbers": left.column("numbers"),
                         "class": pa.array([pack(of[at]) for at in found], pa.binary()),
                         "n": pa.array([pack(n[at]) for at in found], pa.binary())})

    known = meet(words_of(held).select("bucket", "block", "words", "numbers"), lexicon, "bucket", look_up,
                 "block long, numbers binary, class binary, n binary")

    def judge(left: pa.Table, words: pa.Table) -> pa.Table:
        f = shared.value
        size = width(words)
        classes, counts = by_number(words, "class", size, 0) - 1, by_number(words, "n", size, 0)
        out = []
        for columns, entries, offsets in pieces_of(left, keep):
            code, n = classes[entries], counts[entries].astype(np.float64)
            known = code >= 0
            base = np.log10((n + 1) / (f["total"] + f["distinct"] + 1))
            code = np.where(known, code, len(f["size"]) - 1)
            before = np.roll(code, 1)
            before[offsets[:-1]] = code[offsets[1:] - 1]
            kept = np.where(n == 1, 1 - UNSEEN, 1.0)
            spoken = f["move"][before, code] + np.log10(kept * np.maximum(n, 1) / np.maximum(f["size"][code], 1))
            spoken = np.where(known, spoken, f["unseen"][before])
            sums = lambda x: np.add.reduceat(x, offsets[:-1])
            out.append(pa.record_batch(
                [*columns, pa.array(np.diff(offsets)), pa.array(sums(known.astype(np.int64))),
                 pa.array(sums(base)), pa.array(sums(spoken))],
                [*keep, "n_tokens", "n_known", "base_score", "score"]))
        empty = pa.schema([*((k, left.schema.field(k).type.value_type) for k in keep), ("n_tokens", pa.int64()),
                           ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        return pa.Table.from_batches(out, out[0].schema if out else empty)

    schema = ", ".join([*kinds, "n_tokens long, n_known long, base_score double, score double"])
    return meet(documents_of(held, *keep), known, "block", judge, schema)


def score_documents(docs: DataFrame, modulus: int = 7, held: int = 2, **sizes: int) -> DataFrame:
    """Train on documents whose remainder is not ``held`` and score all; texts are split once."""
    rest = remainder(F.col("doc_id"), modulus)
    rows = as_bytes(docs, "doc_id", F.coalesce(rest == held, F.lit(False)).alias("held_out"),
                    F.coalesce(rest != held, F.lit(False)).alias("learn"))
    buckets = sizes.pop("buckets", None) or buckets_for(docs)
    blocks = numbered(rows, tokens, ["doc_id", "held_out"], "learn", buckets, **sizes)
    with short_lived_shuffles(docs.sparkSession):
        lexicon, facts = train_blocks(blocks, buckets)
    scored = score_blocks(blocks, lexicon, facts, "doc_id", "held_out")
    return scored.withColumn("train_tokens", F.lit(facts["total"]).cast("bigint"))
