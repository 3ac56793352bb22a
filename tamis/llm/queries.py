"""Queries of the language-model operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.answers import defective

    return defective(_table(spark, d, "pairs"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.secrets import found_lines

    return found_lines(_table(spark, d, "documents_raw"), _table(spark, d, "pairs"))


def p2_redacted(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.secrets import redacted

    return redacted(_table(spark, d, "documents_raw"), _table(spark, d, "pairs"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.handwritten import not_handwritten

    return not_handwritten(_table(spark, d, "documents_raw"), _table(spark, d, "download_results"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.groups import related

    return related(_table(spark, d, "source_records"))


def p4_splits(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.groups import grouped_splits, related

    return grouped_splits(related(_table(spark, d, "source_records")), _table(spark, d, "split_targets"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.caps import over_cap

    return over_cap(_table(spark, d, "pairs"), _table(spark, d, "judge_results"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.overlap import cross_split

    return cross_split(_table(spark, d, "pairs"))


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.overlap import overlap_report

    return overlap_report(_table(spark, d, "pairs"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.licences import licence_of_all

    return licence_of_all(_table(spark, d, "documents_raw"), _table(spark, d, "source_records"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.tokenize import encode_corpus

    return encode_corpus(_table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.leaks import leaked

    return leaked(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from tamis.llm.residue import residue

    return residue(_table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p2_found, p2_redacted, p3_found, p4_found, p4_splits, p5_found, p6_found, p6_report, p7_found, p8_ids, p9_found, p10_found)}


#: A contributor's spelling in SQL, for the pairs of the test tables.
_CONTRIBUTOR = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(source_id)), '^[a-z]+://', ''), '^([a-z0-9-]+\.)+[a-z]{2,}/+', ''), '[/\s]+$', ''), '\.git$', ''), '^(\d{4}\.\d{4,5})(v\d+)?$', '\1')"


def oracle_sql() -> dict[str, str]:
    return {
        "p5_found": f"""
WITH v AS (SELECT pair_ord, list(score ORDER BY judged_at DESC NULLS LAST, ord DESC)[1] AS score FROM judge_results WHERE pair_ord IS NOT NULL GROUP BY pair_ord),
p AS (SELECT ord, build, {_CONTRIBUTOR} AS c FROM pairs WHERE build IS NOT NULL),
n AS (SELECT build, CAST(ceil(count(*) * 4 / 100.0) AS BIGINT) AS cap FROM p GROUP BY build),
r AS (SELECT p.ord, p.build, row_number() OVER (PARTITION BY p.build, p.c ORDER BY v.score DESC NULLS LAST, p.ord) AS k
      FROM p LEFT JOIN v ON v.pair_ord = p.ord WHERE p.c IS NOT NULL AND p.c <> '')
SELECT r.ord FROM r JOIN n ON n.build = r.build WHERE r.k > n.cap""",
    }
