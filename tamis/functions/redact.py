"""Redaction of e-mail addresses and six kinds of keys, in order, with counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions.text import let

_L, _R = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_KINDS = "(?:RSA |EC |OPENSSH |DSA |PGP )?PRIVATE KEY"
#: Patterns in the order in which they are applied, and what takes their place.
PATTERNS: list[tuple[str, str]] = [
    (rf"(?s)-----BEGIN {_KINDS}-----.*?-----END {_KINDS}-----", "[REDACTED_PRIVATE_KEY]"),
    (rf"{_L}AKIA[0-9A-Z]{{16}}{_R}", "[REDACTED_AWS_KEY]"),
    (rf"{_L}gh[pousr]_[A-Za-z0-9]{{36,}}{_R}", "[REDACTED_GH_TOKEN]"),
    (rf"{_L}sk-[A-Za-z0-9]{{20,}}{_R}", "[REDACTED_API_KEY]"),
    (rf"{_L}xox[baprs]-[A-Za-z0-9-]{{10,}}{_R}", "[REDACTED_SLACK_TOKEN]"),
    (rf"{_L}[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}{_R}", "[REDACTED_EMAIL]"),
]


#: What any match of a pattern holds: texts without it aren't searched.
NEEDLES = [["PRIVATE KEY"], ["AKIA"], ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], ["sk-"], ["xox"], ["@"]]


def scrub(df: DataFrame, column: str, count: str = "redactions", patterns: list[tuple[str, str]] = PATTERNS, needles: list[list[str]] | None = None) -> DataFrame:
    """``df`` with ``column`` redacted and the number of matches in ``count``.

    Each pattern sees the text that the one before left, and searches only texts that hold one of its needles. Null
    texts stay null and count 0. A stage's text is bound once, so the expression grows with the number of patterns only,
    also where a filter on it is pushed down.
    """
    needles = needles if needles is not None else NEEDLES if patterns is PATTERNS else [[] for _ in patterns]
    done = F.struct(F.col(column).alias("text"), F.lit(0).alias("n"))

    def stage(rx: str, to: str, any_of: list[str]):
        def body(s):
            may = F.lit(not any_of)
            for x in any_of:
                may = may | F.contains(s["text"], F.lit(x))
            return F.when(may, F.struct(F.regexp_replace(s["text"], rx, to).alias("text"), (s["n"] + F.coalesce(F.regexp_count(s["text"], F.lit(rx)), F.lit(0))).alias("n"))).otherwise(s)

        return body

    for (rx, to), any_of in zip(patterns, needles):
        done = let(done, stage(rx, to, any_of))
    return df.withColumn("__s", done).withColumns({column: F.col("__s.text"), count: F.col("__s.n").cast("long")}).drop("__s")
