"""Audits and reports over sequences, revisions, statuses and errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusprep.functions import text as tx
from corpusprep.operators.lookup import bounded
from corpusprep.operators.scan import Cutting, Run, running, with_extremes

GAP_BLOCK = 1 << 16


def sequence_audit(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Numbers that should run from 1 without gap or repeat: counts per key."""
    keys = list(keys)
    counted = rows.groupBy(*keys, number).agg(F.count("*").alias("__n"))
    return counted.groupBy(*keys).agg(
        F.sum("__n").alias("n_rows"),
        F.count("*").alias("n_present"),
        (F.max(number) - F.count("*")).cast("bigint").alias("n_missing"),
        F.count_if(F.col("__n") > 1).alias("n_duplicated"),
    )


def missing_numbers(rows: DataFrame, keys: Sequence[str], number: str, bits: Cutting = None) -> DataFrame:
    """The numbers from 1 to the largest that do not occur.

    Gaps lie between neighbours, so only they are generated, block by block: a
    huge gap never becomes one huge array.
    """
    keys = list(keys)
    present = rows.select(*keys, F.col(number).cast("bigint").alias("__n")).distinct()
    before = running(present, keys, "__n", {"__p": Run("max", F.col("__n"), inclusive=False)}, bits)
    low, high = F.coalesce("__p", F.lit(0)) + 1, F.col("__n") - 1
    gaps = before.select(*keys, low.alias("__lo"), high.alias("__hi")).filter("__lo <= __hi")
    blocks = gaps.select(*keys, "__hi", F.explode(
        F.sequence("__lo", "__hi", F.lit(GAP_BLOCK).cast("bigint"))).alias("__lo"))
    return blocks.select(*keys, F.explode(F.sequence(
        "__lo", F.least("__hi", F.col("__lo") + GAP_BLOCK - 1))).alias("missing"))


def pair_balance(docs: DataFrame, by: Sequence[str], pairs: Sequence[tuple[str, str, str]],
                 text: str = "text") -> DataFrame:
    """Openers and closers per group and pair, with their difference."""
    sums = docs.groupBy(*by).agg(*[
        c for name, opener, closer in pairs for c in (
            F.sum(tx.count_matches(text, opener)).alias(f"{name}_o"),
            F.sum(tx.count_matches(text, closer)).alias(f"{name}_c"),
        )
    ])
    rows = F.array(*[F.struct(
        F.lit(name).alias("pair"), F.col(f"{name}_o").alias("n_open"),
        F.col(f"{name}_c").alias("n_close"),
        (F.col(f"{name}_o") - F.col(f"{name}_c")).alias("deficit")) for name, _, _ in pairs])
    return sums.select(*by, F.inline(rows))


def table_width(text: Column | str, row_sep: str = "\n", col_sep: str = r" \| ") -> Column:
    """The largest number of columns in any row of a table text."""
    rows = F.filter(F.split(tx.col(text), row_sep, -1), lambda r: F.length(tx.strip(r)) > 0)
    return F.coalesce(
        F.array_max(F.transform(rows, lambda r: tx.count_matches(r, col_sep) + 1)), F.lit(1))


def build_status(builds: DataFrame, by: str, status: str) -> DataFrame:
    """Counts by pass and status with subtotals; NULL stands for all."""
    return builds.rollup(by, status).agg(F.count("*").alias("n"))


def ranked(counts: DataFrame, n: str, name: str = "rnk") -> DataFrame:
    """Rank groups by count.

    Only the distinct counts meet in one task, with the number of groups of each.
    """
    levels = counts.groupBy(n).agg(F.count("*").alias("__groups"))
    above = F.sum("__groups").over(
        Window.orderBy(F.desc(n)).rowsBetween(Window.unboundedPreceding, -1))
    places = levels.select(n, (F.coalesce(above, F.lit(0)) + 1).cast("int").alias(name))
    return counts.join(places, n).select(*counts.columns, name)


def error_summary(
    lines: DataFrame, keys: Sequence[str], is_error: Column, pos: str = "pos", k: int = 15,
    tail: int = 20, bits: Cutting = None,
) -> DataFrame:
    """The last ``k`` error lines of a job; of a job without any, its last ``tail`` lines.

    Rank filters are pushed below the shuffle, so a job with endless lines sends
    at most ``k`` or ``tail`` of them per task.
    """
    keys = list(keys)
    flagged = lines.withColumn("__err", F.coalesce(is_error, F.lit(False)).cast("int"))
    known = with_extremes(flagged, keys, pos, {"__any": ("max", F.col("__err"))}, bits)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(pos)))

    def newest(rows: DataFrame, n: int) -> DataFrame:
        return rows.withColumn("__rn", last).filter(F.col("__rn") <= n)

    errors = newest(known.filter("__err = 1"), k)
    quiet = newest(known.filter("__any = 0"), tail)
    return errors.unionByName(quiet).select(*lines.columns, (F.col("__err") == 1).cast("int").alias("is_error"))


def error_histogram(errors: DataFrame, message: Column, top: int | None = None) -> DataFrame:
    """Errors by message, most frequent first."""
    counted = errors.groupBy(message.alias("message")).agg(F.count("*").alias("n"))
    ordered = counted.orderBy(F.desc("n"), "message")
    return ordered.limit(top) if top else ordered


def select_ranges(rows: DataFrame, ranges: Sequence[tuple[int, int]], number: str) -> DataFrame:
    """Rows of each 1-based inclusive range, with ``range_no``; a row may lie in several.

    The ranges are the caller's argument, so they travel in the plan: no join.
    """
    table = F.array(*[F.struct(
        F.lit(i).alias("range_no"), F.lit(a).cast("bigint").alias("a"),
        F.lit(b).cast("bigint").alias("b")) for i, (a, b) in enumerate(ranges, 1)])
    hits = F.filter(table, lambda r: F.col(number).between(r["a"], r["b"]))
    return rows.select("*", F.explode(F.transform(hits, lambda r: r["range_no"])).alias("range_no"))


def parse_ranges(tokens: str | Sequence[str]) -> list[tuple[int, int]]:
    """Ranges from ``"3-7,9"``; empty, reversed and non-positive ones are refused."""
    out = []
    for token in tokens.split(",") if isinstance(tokens, str) else tokens:
        first, dash, last = token.strip().partition("-")
        if not first:
            raise ValueError(f"empty range {token!r}")
        a = int(first)
        b = int(last) if dash else a
        if a < 1 or b < a:
            raise ValueError(f"range {token!r} must be 1-based with its end not before its start")
        out.append((a, b))
    return out


def range_violations(rows: DataFrame, keys: Sequence[str], ranges: Sequence[tuple[int, int]],
                     number: str) -> DataFrame:
    """Ranges that end past a document's last number."""
    table = F.array(*[F.struct(F.lit(i).alias("range_no"), F.lit(b).cast("bigint").alias("range_end"))
                      for i, (_, b) in enumerate(ranges, 1)])
    sizes = rows.groupBy(*keys).agg(F.max(number).alias("n_numbers"))
    return sizes.select(*keys, "n_numbers", F.inline(table)).filter("range_end > n_numbers")


def donor_fill(current: DataFrame, donor: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sections from the current revision, else from the donor.

    ``verify`` marks sections both have with different values.
    """
    keys = list(keys)
    cur = current.select(*keys, F.col(value).alias("__c"), F.lit(1).alias("__hc"))
    don = donor.select(*keys, F.col(value).alias("__d"), F.lit(1).alias("__hd"))
    both = cur.join(don, keys, "full")
    status = (
        F.when(F.col("__hc").isNull(), "insert")
        .when(F.col("__hd").isNull() | F.col("__c").eqNullSafe(F.col("__d")), "present")
        .otherwise("verify")
    )
    put = F.when(F.col("__hc").isNull(), F.col("__d")).otherwise(F.col("__c"))
    return both.select(*keys, put.alias(value), status.alias("status"))


def revision_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Block-wise comparison of two revisions: ``(*keys, change)``.

    Only hashes are shuffled, not texts.
    """
    keys = list(keys)
    old = a.select(*keys, tx.digest(text).alias("__a"))
    new = b.select(*keys, tx.digest(text).alias("__b"))
    change = (
        F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed")
        .when(F.col("__a") == F.col("__b"), "same").otherwise("changed")
    )
    return old.join(new, keys, "full").select(*keys, change.alias("change"))


def required(rows: DataFrame, names: DataFrame, on: Sequence[str]) -> DataFrame:
    """Names with a check column: reading a name that has no row raises an error."""
    found = rows.select(*on).distinct().withColumn("__found", F.lit(True))
    checked = names.join(bounded(found), list(on), "left")
    label = F.concat_ws("/", *[F.col(c).cast("string") for c in on])
    return checked.filter(F.when(
        F.col("__found").isNull(), F.raise_error(F.concat(F.lit("no chunk named "), label)).cast("boolean")
    ).otherwise(True)).drop("__found")
