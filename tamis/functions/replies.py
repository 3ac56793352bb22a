"""Replies of models as columns: fences, lenient JSON, fields and numbers, all in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions import text as T

#: Fixed value: a fence around JSON.
FENCE = r"(?s)```(?:json)?[\t\n\x0B\f\r\x1c-\x1f\x85\p{Z}]*(.*?)```"


def unfenced(raw: Column) -> Column:
    """The inside of the first fence, stripped, or the stripped text."""
    return T.let(T.strip(raw), lambda t: F.when(t.rlike(FENCE), T.strip(F.regexp_extract(t, FENCE, 1))).otherwise(t))


def _between(text: Column, opener: str, closer: str) -> Column:
    """From the first ``opener`` to the last ``closer``; null without such a stretch."""
    a = F.locate(opener, text)
    b = F.length(text) - F.locate(closer, F.reverse(text)) + 1
    return F.when((a > 0) & F.contains(text, F.lit(closer)) & (a < b), F.substring(text, a, b - a + 1))


def strict_json(text: Column) -> Column:
    """A variant of a text that is one JSON value and nothing more; the parser alone would stop after the first value."""
    inside = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return T.let(inside, lambda x: F.when(F.size(x) == 1, x[0]))


def lenient_json(text: Column) -> Column:
    """A variant of the text, else of its widest object, else of its widest list; null if none can be read."""
    return T.let(text, lambda t: F.coalesce(*[strict_json(c) for c in (t, _between(t, "{", "}"), _between(t, "[", "]"))]))


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def text_of(v: Column, field: str) -> Column:
    """A field of a variant object as text; null where it is missing. A JSON null reads ``None``."""
    x = F.try_variant_get(v, f"$.{field}", "variant")
    return F.when(F.is_variant_null(x), F.lit("None")).otherwise(F.try_variant_get(v, f"$.{field}", "string"))


def unit_number(v: Column, field: str) -> Column:
    """A field of a variant object as a number in [0, 1]: numbers, numeric text and booleans; anything else, NaN and a
    missing field are 0."""
    boolean = F.schema_of_variant(F.try_variant_get(v, f"$.{field}", "variant")) == "BOOLEAN"
    number = T.let(F.lower(F.trim(F.try_variant_get(v, f"$.{field}", "string"))), lambda t: F.when(boolean & (t == "true"), F.lit(1.0)).otherwise(t.try_cast("double")))
    return T.let(number, lambda x: F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))))
