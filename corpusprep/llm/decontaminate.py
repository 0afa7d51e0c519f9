"""Benchmark decontamination by SimHash of item-sized windows; column expressions only.

Words are lower-cased (A-Z) runs without ASCII white space, shingles are five words, or all
words of a shorter item. A document is contaminated by an item if some window of as many
words as the item has a weighted Jaccard similarity of ``SIMILARITY`` or more to it, a shingle
weighing as often as it occurs. A document shorter than the item has one window, the whole of it.

1. Windows that share no shingle with any item have similarity 0. So shingle hashes of all
   documents meet the items' shingles, and only windows around a match go on, once per
   distinct content. Matches and windows are rows, whatever the length of a text.
2. A window's SimHash counts bits in eight words of eight 8-bit lanes (in slices of 127
   shingles). Fingerprints are cut into ``RADIUS + 1`` bit blocks; two within the radius agree
   in a block, so a join on item length, block and its bits finds all of them.
3. The candidates' exact weighted similarity decides.

At similarity 0.8 fingerprints differ in 10 bits of 64 on average with a deviation of 3;
``RADIUS`` is 20.

Cases: NULL and word-less texts and items match nothing; repeated rows give repeated
results; an item given twice is reported under each id; an empty table on either side gives
an empty result; only the named columns are read, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.llm.common import ascii_lower
from corpusprep.session import materialise

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 20
BROADCAST_ROWS = 500_000
FULL = 127


def words(text: str) -> Column:
    split = F.split(ascii_lower(F.col(text)), r"[ \t-\r]+")
    return F.filter(split, lambda w: w != "")


def shingles(hashes: Column, width: int) -> Column:
    """A hash per run of ``width`` words, in order."""
    n = F.size(hashes) - width + 1
    each = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)])
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), each)).otherwise(
        F.array().cast("array<bigint>"))


def fingerprints(contents: DataFrame) -> DataFrame:
    """``(n_words, w, fp)`` of distinct ``(n_words, w, sh)``; a bit is set where over half the hashes set it."""
    flat = contents.select("n_words", "w", F.posexplode("sh").alias("pos", "h"))
    lanes = flat.groupBy("n_words", "w", F.floor(F.col("pos") / FULL).alias("part")).agg(
        F.count("*").alias("m"),
        *[F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(0x0101010101010101))).alias(f"b{k}") for k in range(8)])
    # Lane j of word k counts bit 8 j + k.
    counts = lanes.groupBy("n_words", "w").agg(
        F.sum("m").alias("m"),
        *[F.sum(F.shiftrightunsigned(f"b{i % 8}", 8 * (i // 8)).bitwiseAND(F.lit(0xFF))).alias(f"c{i}") for i in range(64)])
    fp = F.lit(0).cast("bigint")
    for i in range(64):
        bit = (1 << i) - (1 << 64 if i == 63 else 0)
        fp = fp.bitwiseOR(F.when(2 * F.col(f"c{i}") > F.col("m"), F.lit(bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return counts.select("n_words", "w", fp.alias("fp"))


def similarities(pairs: DataFrame, contents: DataFrame, known: DataFrame, near: Callable) -> DataFrame:
    """Adds the weighted Jaccard similarity of windows ``(n_words, w)`` and items."""
    window = contents.select("n_words", "w", F.size("sh").alias("m"), F.explode("sh").alias("s")).groupBy(
        "n_words", "w", "m", "s").agg(F.count("*").alias("c"))
    item = known.select("number", F.size("sh").alias("mi"), F.explode("sh").alias("s")).groupBy(
        "number", "mi", "s").agg(F.count("*").alias("ci"))
    shared = pairs.join(window, ["n_words", "w"]).join(near(item), ["number", "s"]).groupBy(
        "n_words", "w", "item_words", "number", "distance", "m", "mi").agg(F.sum(F.least("c", "ci")).alias("i"))
    return shared.withColumn("similarity", F.col("i") / (F.col("m") + F.col("mi") - F.col("i")))


def _blocks(fp: Column, radius: int) -> Column:
    """``(number, bits)`` of ``radius + 1`` ranges of the fingerprint."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(i).alias("block"),
                 F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
        for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def item_table(items: DataFrame, item: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(item, number)`` of the items with a word, and per distinct content
    ``(number, n_words, width, sh, fp)``."""
    base = items.select(F.col(item).alias("item"), words(text).alias("w")).filter(F.size("w") > 0)
    base = base.select("item", F.size("w").alias("n_words"), F.transform("w", lambda x: F.xxhash64(x)).alias("wh"))
    base = base.withColumn("width", F.least("n_words", F.lit(WIDTH)))
    sh = F.when(F.col("width") == WIDTH, shingles(F.col("wh"), WIDTH))
    for k in range(1, WIDTH):
        sh = sh.when(F.col("width") == k, shingles(F.col("wh"), k))
    named = materialise(base.withColumn("sh", sh).withColumn("w", F.xxhash64("sh")), "items")
    contents = named.groupBy("n_words", "w").agg(F.first("width").alias("width"), F.first("sh").alias("sh"))
    known = contents.join(fingerprints(contents), ["n_words", "w"]).withColumn("number", F.xxhash64("n_words", "w"))
    known = materialise(known.select("number", "n_words", "width", "sh", "fp"), "contents")
    return named.select("item", F.xxhash64("n_words", "w").alias("number")), known


def window_starts(matched: DataFrame, threshold: float) -> DataFrame:
    """``(d, width, n_words, item_words, start)``: all windows that hold a matched shingle, once each.

    A text shorter than an item is one window, if it has shingles enough for the threshold.
    """
    each = matched.select("d", "width", "size", "pos", F.explode("lengths").alias("n"))
    size, n, k, pos = (F.col(c) for c in ("size", "n", "width", "pos"))
    # The windows around a match begin where those around the match before it have ended.
    before = F.lag("pos", 1, -1).over(Window.partitionBy("d", "width", "n").orderBy("pos"))
    ranges = each.filter(size >= n).withColumn("low", F.greatest(pos - n + k, before + 1, F.lit(0))).withColumn(
        "high", F.least(pos, size - n)).filter("low <= high")
    full = ranges.select(
        "d", "width", n.alias("n_words"), n.alias("item_words"), F.explode(F.sequence("low", "high")).alias("start"))
    short = each.filter((size < n) & (size - k + 1 >= F.lit(threshold) * (n - k + 1) - 1e-9)).select(
        "d", "width", size.alias("n_words"), n.alias("item_words"), F.lit(0).alias("start")).distinct()
    return full.unionByName(short)


def contaminated(
    docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", threshold: float = SIMILARITY, radius: int = RADIUS,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """``(doc, item, start_word, n_words, distance, similarity)``: the best window per pair."""
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    named_items, known = item_table(items, item, item_text)
    keys = materialise(
        known.select("width", "n_words", F.explode("sh").alias("s")).distinct()
        .groupBy("width", "s").agg(F.collect_set("n_words").alias("lengths")), "shingles")
    few = keys.count() <= limit
    near = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    widths = sorted(r["width"] for r in known.select("width").distinct().collect())

    named = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("d"))
    hashed = named.withColumn("wh", F.transform(words("text"), lambda w: F.xxhash64(w)))
    rows = None
    for k in widths:
        one = hashed.select("doc", "d", F.size("wh").alias("size"), F.posexplode(shingles(F.col("wh"), k)).alias("pos", "s"))
        met = one.join(near(keys.filter(F.col("width") == k).drop("width")), "s").select(
            "doc", "d", "size", F.lit(k).alias("width"), "pos", "lengths")
        rows = met if rows is None else rows.unionByName(met)
    if rows is None:
        nothing = named_items.limit(0).select(
            F.col("item").alias(item), F.lit(0).alias("start_word"), F.lit(0).alias("n_words"),
            F.lit(0).alias("distance"), F.lit(0.0).alias("similarity"))
        return docs.select(doc).limit(0).join(nothing, F.lit(True))
    # One document per distinct content goes on.
    matched = materialise(rows.groupBy("d", "width", "pos").agg(
        F.first("size").alias("size"), F.first("lengths").alias("lengths"), F.min("doc").alias("rep")), "matches")
    reps = matched.groupBy("d").agg(F.min("rep").alias("rep"))

    # Few contents match: where their number allows it, only their texts are shuffled.
    if reps.count() <= limit:
        reps = F.broadcast(reps)
    texts = named.join(reps, ["d"]).filter(F.col("doc").eqNullSafe(F.col("rep")))
    texts = texts.select("d", F.transform(words("text"), lambda w: F.xxhash64(w)).alias("wh"))
    places = window_starts(matched, threshold)
    windows = None
    for k in widths:
        some = places.filter(F.col("width") == k).join(texts.select("d", shingles(F.col("wh"), k).alias("sh")), "d").select(
            "d", "n_words", "item_words", "start", F.slice("sh", F.col("start") + 1, F.col("n_words") - k + 1).alias("sh"))
        windows = some if windows is None else windows.unionByName(some)
    placed = materialise(windows.withColumn("w", F.xxhash64("sh")), "windows")

    contents = materialise(placed.groupBy("n_words", "w").agg(F.first("sh").alias("sh")), "window-contents")
    printed = materialise(fingerprints(contents), "window-fingerprints")
    short = placed.filter("item_words > n_words").select("n_words", "w", "item_words").distinct()
    asked = printed.withColumn("item_words", F.col("n_words")).unionByName(printed.join(short, ["n_words", "w"]))
    left = asked.select("n_words", "w", "item_words", "fp", F.explode(_blocks(F.col("fp"), radius)).alias("b"))
    right = known.select(
        "number", F.col("n_words").alias("item_words"), F.col("fp").alias("item_fp"), F.explode(_blocks(F.col("fp"), radius)).alias("b"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # A pair may agree in several blocks.
    pairs = left.join(near(right), ["item_words", "b"]).select(
        "n_words", "w", "item_words", "number", distance.alias("distance")).filter(F.col("distance") <= radius).distinct()
    verified = similarities(pairs, contents, known, near).filter(F.col("similarity") >= threshold)
    met = placed.select("d", "n_words", "item_words", "start", "w").join(verified, ["n_words", "w", "item_words"]).join(near(named_items), "number")
    best = met.groupBy("d", "item").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "start", "n_words", "distance")).alias("m"))
    return named.select("doc", "d").join(best, "d").select(
        F.col("doc").alias(doc), F.col("item").alias(item), F.col("m.start").alias("start_word"),
        F.col("m.n_words").alias("n_words"), F.col("m.distance").alias("distance"),
        (-F.col("m.s")).alias("similarity"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents in which no item was found; columns as they came.

    Rows are told apart by content, so rows without an id are judged as well.
    """
    marked = docs.withColumn("__d", F.xxhash64(text))
    keyed = marked.select(F.col("__d").alias("content"), F.col(text).alias("text"))
    found = contaminated(keyed, items, "content", "text", **options).select(F.col("content").alias("__d")).distinct()
    return marked.join(found, "__d", "left_anti").select(*docs.columns)
