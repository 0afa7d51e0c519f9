"""Text expressions whose meaning must not depend on the regex engine's defaults."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters Unicode counts as white space.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ESCAPED = set(r"\.^$|?*+()[]{}#&-~")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote(literal: str) -> str:
    """Escape a literal for a Java pattern."""
    return "".join("\\" + ch if ch in ESCAPED else ch for ch in literal)


def any_of(words: Iterable[str]) -> str:
    """One alternation of literals, longest first."""
    return "|".join(quote(w) for w in sorted(words, key=lambda w: (-len(w), w)))


def first_of(words: Iterable[str]) -> str:
    """A look-ahead on the first letters, in either case; it rejects most places at once."""
    letters = {c for w in words for c in (w[0].lower(), w[0].upper()) if len(c) == 1}
    return "(?=[" + "".join(quote(c) for c in sorted(letters)) + "])"


def whole_words(words: Iterable[str]) -> str:
    """A Unicode-aware whole-word pattern."""
    words = list(words)
    return rf"(?U){first_of(words)}\b(?:{any_of(words)})\b"


def strip(c: Column | str) -> Column:
    """Drop all surrounding white space, not only blanks."""
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once, also inside a lambda."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def collapse_newlines(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\n{3,}", "\n\n")


def lines(c: Column | str) -> Column:
    return F.split(col(c), "\n", -1)


def digest(c: Column | str) -> Column:
    return F.md5(F.encode(col(c), "UTF-8"))


def count_matches(c: Column | str, pattern: str) -> Column:
    return F.regexp_count(col(c), F.lit(pattern))


def find_all(c: Column | str, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col(c), F.lit(pattern), F.lit(group))


def basename(c: Column | str) -> Column:
    return F.element_at(F.split(col(c), "/"), -1)


def capitalise(c: Column | str) -> Column:
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))


def preserve_case(found: Column, replacement: Column) -> Column:
    """UPPER and Title finds pass their case on; anything else takes the text as written."""
    has_case = F.upper(found) != F.lower(found)
    return (
        F.when(has_case & (found == F.upper(found)), F.upper(replacement))
        .when(has_case & (found == F.initcap(found)), capitalise(replacement))
        .otherwise(replacement)
    )


def evaluated(df: DataFrame, keep: Iterable[str], values: dict[str, Column]) -> DataFrame:
    """``keep`` plus ``values``, each computed exactly once per row.

    The values leave through a generator of one row. Later filters and joins on
    them cannot be pushed below it, which would repeat long chains of regular
    expressions once per use.
    """
    row = F.struct(*[c.alias(n) for n, c in values.items()])
    return df.select(*keep, F.inline(F.array(row)))
