"""Instruction rows of many shapes as pairs, language filter, import scan and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.functions.redact import scrub
from tamis.operators.clean import CleanOptions, clean
from tamis.plans.runtime import spread, written

#: Field names by priority.
INSTRUCTION_KEYS = ["instruction", "problem", "prompt", "question", "query", "task"]
RESPONSE_KEYS = ["response", "output", "solution", "completion", "answer", "code"]
CONTEXT_KEYS = ["context", "input"]
#: Signs of the one language that the heuristic knows.
GO_FENCE = r"(?i)```go(?![\p{L}\p{N}_])"
GO_MARKERS = ["package ", "func ", ":= ", "import ("]
GO_ALIASES = ["go", "golang"]


def _pick(df: DataFrame, keys: list[str]) -> Column:
    """First filled text field of ``keys`` that the table has."""
    have = [F.col(f"`{k}`") for k in keys if k in df.columns and df.schema[k].dataType.simpleString() == "string"]
    return T.first_filled(*have) if have else F.lit("")


def chat_fold(messages: Column) -> dict[str, Column]:
    """Instruction (last user turn), response (last assistant turn), context (system turns, one a line)
    of an array of ``struct<role, content>``; blank turns are ignored."""

    def turns(role: str) -> Column:
        kept = F.filter(messages, lambda m: (m["role"] == role) & ~T.is_blank(m["content"]))
        return F.transform(kept, lambda m: T.strip(m["content"]))

    last = lambda role: F.coalesce(F.try_element_at(turns(role), F.lit(-1)), F.lit(""))
    return {"instruction": last("user"), "response": last("assistant"), "context": F.coalesce(F.array_join(turns("system"), "\n"), F.lit(""))}


def normalize(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` and instruction, response, context of the rows that have both sides.

    A non-empty ``messages`` array wins even where it yields nothing. Fields are taken by
    priority and stripped; rows with a blank side are dropped.
    """
    flat = {"instruction": _pick(rows, INSTRUCTION_KEYS), "response": _pick(rows, RESPONSE_KEYS), "context": _pick(rows, CONTEXT_KEYS)}
    if "messages" in rows.columns:
        chat = chat_fold(F.col("messages"))
        use = F.coalesce(F.size("messages") > 0, F.lit(False))
        flat = {k: F.when(use, chat[k]).otherwise(v) for k, v in flat.items()}
    out = rows.select(*[F.col(f"`{k}`") for k in keep or []], *[T.strip(v).alias(k) for k, v in flat.items()])
    return out.where("instruction <> '' and response <> ''")


def in_language(declared: Column, language: str, *texts: Column) -> Column:
    """The declared language decides where it isn't blank; else, for Go only, its signs in the texts."""
    target = language.strip().lower()
    said = F.lower(T.strip(declared))
    by_name = said.isin(GO_ALIASES) if target == "go" else said == target
    if target == "go":
        t = F.concat_ws("\n", *[F.coalesce(x, F.lit("")) for x in texts])
        signs = t.rlike(GO_FENCE)
        for m in GO_MARKERS:
            signs = signs | t.contains(m)
    else:
        signs = F.lit(False)
    return F.when(~T.is_blank(declared), by_name).otherwise(signs)


def declared_language(df: DataFrame) -> Column:
    """``lang`` unless null or empty, else ``language``; a blank ``lang`` hides ``language``."""
    have = [F.when(F.col(c) != "", F.col(c)) for c in ("lang", "language") if c in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def import_scan(rows: DataFrame, order: str, language: str = "go", max_results: int = 100, max_scan: int | None = None) -> DataFrame:
    """The first matching pairs in order: at most ``max_scan`` rows are looked at (at least one), at most
    ``max_results`` come out (at least one if any matches). The limit is the operator."""
    if max_scan is not None:
        rows = rows.orderBy(order).limit(max(1, max_scan))
    tagged = rows.withColumn("__lang", declared_language(rows))
    pairs = normalize(tagged, [order, "__lang"])
    hit = pairs.where(in_language(F.col("__lang"), language, F.col("instruction"), F.col("response"), F.col("context")))
    return hit.drop("__lang").orderBy(order).limit(max(1, max_results))


def import_clean(pairs: DataFrame, order: str = "ord", o: CleanOptions = CleanOptions(min_length=40, max_length=20_000, scrub=False)) -> DataFrame:
    """All pairs with both sides filled after redaction, with ``redactions`` by field and the
    ``drop_reason`` of cleaning their joined text (instruction, context, response)."""
    fields = ["instruction", "response", "context"]
    pairs = spread(pairs)
    for f in fields:
        pairs = scrub(pairs, f, f"__r_{f}")
    pairs = pairs.withColumn("redactions", sum((F.col(f"__r_{f}") for f in fields[1:]), F.col("__r_instruction"))).drop(*[f"__r_{f}" for f in fields])
    parts = [F.when(F.col(f) != "", F.col(f)) for f in ("instruction", "context", "response")]
    # Written before the filter, so that it reads redacted texts and doesn't redact them again.
    joined = written(pairs).where(~T.is_blank(F.col("instruction")) & ~T.is_blank(F.col("response"))).withColumn("content", F.concat_ws("\n\n", *parts)).withColumnRenamed("redactions", "__red")
    done = clean(joined, order, o, license_=None)
    return done.drop("redactions", "content").withColumnRenamed("__red", "redactions")
