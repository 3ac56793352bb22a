"""Text functions as column expressions with Unicode code-point semantics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space (inside a character class).
WS = r"\t\n\x0B\f\r\x1c-\x1f\x85\p{Z}"
#: One word: letters, numbers and underscore of any script.
WORD = r"[\p{L}\p{N}_]+"
TRUNCATED = "\n... [truncated]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """White space of any kind removed at both ends."""
    return F.regexp_replace(c, rf"\A[{WS}]+|[{WS}]+\z", "")


def is_blank(c: Column) -> Column:
    """Null, empty or only white space."""
    return c.isNull() | ~c.rlike(rf"[^{WS}]")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(c, rf"[{WS}]+", " "))


def printable_ratio(c: Column) -> Column:
    """Share of printable characters, line feed, return and tab; 0 for null and empty."""
    kept = F.length(F.regexp_replace(c, r"[\p{C}\p{Z}&&[^ \n\r\t]]", ""))
    return F.when(F.length(c) > 0, kept / F.length(c)).otherwise(F.lit(0.0))


def word_list(c: Column) -> Column:
    """Lower-case words in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"({WORD})"), 1)


def shingles(c: Column, n: int = 5) -> Column:
    """Distinct word n-grams; a shorter text is one shingle, a text without words has none."""

    def grams(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, F.array_distinct(each)).when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>"))

    # The list is bound to a variable, else each gram would split the text again.
    return let(word_list(c), grams)


def truncate_lines(c: Column, n: int = 8000) -> Column:
    """At most ``n`` characters, cut at the last line feed if that lies beyond the middle, and
    marked; shorter texts are unchanged."""
    head = F.substring(c, 1, n)
    feed = F.lit(n) - F.locate("\n", F.reverse(head))  # 0-based place of the last line feed
    at_line = F.when(F.locate("\n", head) == 0, head).when(feed > n // 2, F.substring(head, F.lit(1), feed)).otherwise(head)
    return F.when(F.length(c) <= n, c).otherwise(F.concat(at_line, F.lit(TRUNCATED)))


def truncate(c: Column, n: int) -> Column:
    """At most ``n`` characters, marked when cut."""
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.substring(c, 1, n), F.lit(TRUNCATED)))


def clip(c: Column, n: int = 4000) -> Column:
    """Stripped, then at most ``n`` characters; null gives an empty text."""
    return truncate(strip(F.coalesce(c, F.lit(""))), n)


def first_filled(*cols: Column) -> Column:
    """The first column that isn't blank, as it is; an empty text if all are."""
    return F.coalesce(*[F.when(~is_blank(c), c) for c in cols], F.lit(""))


def host(url: Column) -> Column:
    """Authority of an address (with user and port); null if it has none."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))
