"""The kernels under names for SQL: temporary functions whose bodies are SQL expressions, so nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tamis.functions import text as T
from tamis.functions.replies import FENCE
from tamis.operators.judge import AXES
from tamis.operators.verify import BARE, FENCED, TAGGED, TEST


def _r(pattern: str) -> str:
    """A pattern as a raw SQL literal."""
    quote = '"' if "'" in pattern else "'"
    return f"r{quote}{pattern}{quote}"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, r'\A[{T.WS}]+|[{T.WS}]+\z', '')"


def _widest(a: str, b: str) -> str:
    return f"CASE WHEN locate('{a}', t) > 0 AND locate('{a}', t) < length(t) - locate('{b}', reverse(t)) + 1 AND contains(t, '{b}') THEN substring(t, locate('{a}', t), length(t) - locate('{b}', reverse(t)) + 2 - locate('{a}', t)) END"


def _field(v: str, name: str) -> str:
    return f"CASE WHEN is_variant_null(try_variant_get({v}, '$.{name}', 'variant')) THEN 'None' ELSE try_variant_get({v}, '$.{name}', 'string') END"


def _unit(name: str) -> str:
    t = f"lower(trim(try_variant_get(v, '$.{name}', 'string')))"
    x = f"(CASE WHEN schema_of_variant(try_variant_get(v, '$.{name}', 'variant')) = 'BOOLEAN' AND {t} = 'true' THEN 1D ELSE try_cast({t} AS DOUBLE) END)"
    return f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 0D ELSE greatest(0D, least(1D, {x})) END"


def _blocks(rx: str) -> str:
    return f"filter(transform(regexp_extract_all(t, {_r(rx)}, 1), b -> btrim(b, '\\n')), b -> b rlike r'[^{T.WS}]')"


def definitions() -> list[str]:
    """The statements that make ``parse_reply(text)``, ``parse_pairs(text)`` and the table function
    ``extract_code(text) -> (idx, block, is_test)``, with their helpers."""
    axes = ", ".join(f"'{a}', {_unit(a)}" for a in AXES)
    pair = "array<struct<instruction:string,response:string>>"
    made = ", ".join(f"{_strip('coalesce(' + _field('x', n) + f', {chr(39)*2})')} AS {n}" for n in ("instruction", "response"))
    return [
        f"tamis_unfenced(raw STRING) RETURNS STRING RETURN CASE WHEN {_strip('raw')} rlike {_r(FENCE)} THEN {_strip(f'regexp_extract({_strip("raw")}, {_r(FENCE)}, 1)')} ELSE {_strip('raw')} END",
        "tamis_values(t STRING) RETURNS ARRAY<VARIANT> RETURN try_variant_get(try_parse_json('[' || t || ']'), '$', 'array<variant>')",
        "tamis_one(x ARRAY<VARIANT>) RETURNS VARIANT RETURN CASE WHEN size(x) = 1 THEN x[0] END",
        f"tamis_json(t STRING) RETURNS VARIANT RETURN coalesce(tamis_one(tamis_values(t)), tamis_one(tamis_values({_widest('{', '}')})), tamis_one(tamis_values({_widest('[', ']')})))",
        f"tamis_axes(v VARIANT) RETURNS MAP<STRING, DOUBLE> RETURN map({axes})",
        f"tamis_reply(raw STRING, v VARIANT) RETURNS STRUCT<score: DOUBLE, axes: MAP<STRING, DOUBLE>, rationale: STRING> RETURN struct(round(aggregate(map_values(tamis_axes(v)), 0D, (a, x) -> a + x) / {len(AXES)}, 6) AS score, tamis_axes(v) AS axes, CASE WHEN raw IS NULL OR NOT raw rlike r'[^{T.WS}]' THEN 'empty reply' WHEN v IS NULL THEN 'unreadable reply' ELSE {_strip('coalesce(' + _field('v', 'rationale') + f', {chr(39)*2})')} END AS rationale)",
        "tamis_object(v VARIANT) RETURNS VARIANT RETURN CASE WHEN schema_of_variant(v) LIKE 'OBJECT%' THEN v END",
        "parse_reply(raw STRING) RETURNS STRUCT<score: DOUBLE, axes: MAP<STRING, DOUBLE>, rationale: STRING> RETURN tamis_reply(raw, tamis_object(tamis_json(tamis_unfenced(raw))))",
        f"tamis_items(v VARIANT) RETURNS {pair} RETURN coalesce(filter(transform(coalesce(try_variant_get(v, '$.pairs', 'array<variant>'), try_variant_get(v, '$', 'array<variant>')), x -> struct({made})), p -> p.instruction <> '' AND p.response <> ''), array())",
        f"parse_pairs(raw STRING) RETURNS {pair} RETURN tamis_items(tamis_json(tamis_unfenced(raw)))",
        f"code_blocks(t STRING) RETURNS ARRAY<STRING> RETURN CASE WHEN size({_blocks(TAGGED)}) > 0 THEN {_blocks(TAGGED)} WHEN size({_blocks(FENCED)}) > 0 THEN {_blocks(FENCED)} WHEN t rlike {_r(BARE)} THEN array(btrim(t, '\\n')) ELSE array() END",
        f"extract_code(t STRING) RETURNS TABLE (idx INT, block STRING, is_test BOOLEAN) RETURN SELECT e.pos, e.col, e.col rlike {_r(TEST)} FROM (SELECT code_blocks(t) AS b) s, LATERAL posexplode(s.b) e",
    ]


def register(spark: SparkSession) -> None:
    """Makes the functions known to a session."""
    for d in definitions():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {d}")
