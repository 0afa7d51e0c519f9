"""Blocks and lines: splitting, joining, classifying, filtering."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions import text as tx


def split_blocks(docs: DataFrame, doc: str = "doc_id", text: str = "text",
                 boundary: str = r"\n\s*\n+") -> DataFrame:
    """One row per non-empty block, positions counted before empties are left out."""
    return (
        docs.select(doc, F.posexplode(F.split(text, boundary, -1)).alias("pos", text))
        .withColumn(text, tx.strip(text))
        .filter(F.length(text) > 0)
    )


def explode_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row ``(doc, line_no, line)`` per line."""
    return docs.select(doc, F.posexplode(tx.lines(text)).alias("line_no", "line"))


def joined(segments: Column, sep: str = "\n\n") -> Column:
    """Join an array of segments: trimmed, empties left out, one newline at the end."""
    kept = F.filter(F.transform(segments, tx.strip), lambda s: F.length(s) > 0)
    whole = tx.strip(tx.collapse_newlines(F.array_join(kept, sep)))
    return F.when(F.length(whole) > 0, F.concat(whole, F.lit("\n"))).otherwise(F.lit(""))


def classify(line: Column | str, kinds: Sequence[tuple[str, str]], default: str = "prose") -> Column:
    """The first kind whose pattern occurs in the line."""
    line = tx.col(line)
    out = None
    for name, pattern in kinds:
        out = (F if out is None else out).when(line.rlike(pattern), F.lit(name))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


# What opens each kind of Markdown block.
MARKDOWN_KINDS = (
    ("heading", r"^\s*#{1,6}\s+"),
    ("code", r"^\s*(?:```|~~~)"),
    ("image", r"^\s*!\[[^\]]*\]\([^)]+\)\s*$"),
    ("table", r"^\s*\|"),
    ("quote", r"^\s*>"),
)


def symbol_line(
    line: Column | str, symbol: str, prose: str, exempt: Sequence[str] = (), ignore: Sequence[str] = (),
) -> Column:
    """Does a line have a ``symbol``, no ``prose`` outside what is to ``ignore``, and nothing ``exempt``."""
    def judge(body: Column) -> Column:
        outside = body
        for pattern in ignore:
            outside = F.regexp_replace(outside, pattern, "")
        reads = body.rlike(symbol)
        for pattern in exempt:
            reads = reads & ~body.rlike(pattern)
        return (F.length(body) > 0) & reads & ~outside.rlike(prose)

    return tx.let(tx.strip(line), judge)


def route(n_hits: Column, n_lines: Column) -> Column:
    """``none``, ``all`` or ``mixed`` by the share of matching lines."""
    return F.when(n_hits == 0, "none").when(n_hits == n_lines, "all").otherwise("mixed")


def unsafe_line(
    line: Column | str, risky: str, glued: str, exempt: str,
    formula: Callable[[Column], Column] | None = None, command: str | None = None,
) -> Column:
    """Lines that match ``risky`` or ``glued``, or are a ``formula`` with a ``command``.

    Lines that match ``exempt`` and lines in single back quotes are safe.
    """
    def judge(body: Column) -> Column:
        danger = body.rlike(risky) | body.rlike(glued)
        if formula is not None and command is not None:
            danger = danger | (formula(body) & body.rlike(command))
        quoted = body.startswith("`") & body.endswith("`")
        return (F.length(body) > 0) & ~quoted & danger

    def open_line(whole: Column) -> Column:
        item = tx.strip(F.regexp_replace(whole, r"^(?:[-*+]|\d+\.)\s+", ""))
        return ~whole.rlike(exempt) & tx.let(item, judge)

    return tx.let(tx.strip(line), open_line)


def flag_counts(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Rows per flag, one pass: ``(flag, n)``; flags that never hit are listed with 0."""
    counted = df.agg(*[F.count_if(c).alias(n) for n, c in flags.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("flag"), F.col(n).alias("n")) for n in flags])
    return counted.select(F.inline(pairs))


def malformed_flags(body: Column | str, environments: Sequence[str] = ()) -> dict[str, Column]:
    """The audits of a formula body, by name."""
    body = tx.col(body)

    def n(pattern: str) -> Column:
        return tx.count_matches(body, pattern)

    names = "|".join(tx.quote(e) for e in environments) or r"[A-Za-z*]+"
    # A body is balanced when dropping every begin and every end of a name leaves equally many.
    begins = F.array_sort(tx.find_all(body, rf"\\begin\{{({names})\}}", 1))
    ends = F.array_sort(tx.find_all(body, rf"\\end\{{({names})\}}", 1))
    array_body = F.regexp_replace(body, r"\\begin\{array\}\{[^\}]*\}|\\end\{array\}", "")
    return {
        "leaked_token": body.rlike("MATHBLK|MATHINL|HIDE"),
        "foreign_command": body.rlike(r"(?U)\\\p{IsCyrillic}+"),
        "empty_array": body.contains(r"\begin{array}") & (F.length(tx.strip(array_body)) == 0),
        "lone_begin": body.rlike(r"^\s*\\begin\{[A-Za-z*]+\}\s*$"),
        "list_or_heading": body.rlike(r"(?m)^\s*(?:#|- |\d+\.)"),
        "brace_imbalance": n(r"\{") != n(r"\}"),
        "environment_imbalance": begins != ends,
    }


def mark_pages(blocks: DataFrame, pattern: str, text: str = "text", pages: str = "pages",
               page: str = "page") -> DataFrame:
    """Page numbers that markers in a block's text name (group 1 of ``pattern``).

    ``pages`` has all of them in order, ``page`` the first; a block without markers,
    or without text, has none.
    """
    found = F.transform(tx.find_all(text, pattern, 1), lambda m: m.try_cast("int"))
    listed = F.coalesce(F.filter(found, lambda p: p.isNotNull()), F.array().cast("array<int>"))
    return blocks.withColumn(pages, listed).withColumn(page, F.get(pages, F.lit(0)))


def edit_literal(text: Column | str, start: str, end: str, replacement: str) -> Column:
    """Replace from the first ``start`` up to the first ``end`` after it, inside one text.

    Nothing happens when either is missing, or ``end`` falls on ``start`` itself.
    """
    text = tx.col(text)
    body = replacement.rstrip() + "\n\n"

    def put(at: Column) -> Column:
        begin, stop = at["begin"], at["stop"]
        edited = F.concat(F.substring(text, F.lit(1), begin - 1), F.lit(body),
                          F.substring(text, stop, F.length(text)))
        return F.when((begin > 0) & (stop > begin), edited).otherwise(text)

    begin = F.locate(start, text)
    stop = tx.let(begin, lambda b: F.when(b > 0, F.call_function("locate", F.lit(end), text, b)).otherwise(0))
    return tx.let(F.struct(begin.alias("begin"), stop.alias("stop")), put)


def drop_contaminated(blocks: DataFrame, start_page: Column, matches: Column,
                      from_page: int = 150) -> DataFrame:
    """Drop matching blocks, but only in chunks that start at ``from_page`` or later."""
    return blocks.filter(~F.coalesce((start_page >= from_page) & matches, F.lit(False)))
