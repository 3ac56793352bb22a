"""Queries of the core operators over the test tables, and SQL with the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions import redact
from tamis.functions import text as T
from tamis.functions.redact import scrub
from tamis.operators import build as B
from tamis.operators import clean as C
from tamis.operators import generate as G
from tamis.operators import judge as J
from tamis.operators import minhash as M
from tamis.operators import pairs as P
from tamis.operators import verify as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: White space and blank tests in SQL.
_WS = r"[\t\n\x0B\f\r\x1c-\x1f\x{85}\p{Z}]"
_STRIP = "regexp_replace(regexp_replace({0}, '\\A" + _WS + "+', ''), '" + _WS + "+\\z', '')"


def _strip(c: str) -> str:
    return _STRIP.replace("{0}", c)


def _filled(c: str) -> str:
    return "coalesce(regexp_matches(" + c + r", '[^\t\n\x0B\f\r\x1c-\x1f\x{85}\p{Z}]'), false)"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


_RATIO = r"CASE WHEN length(content) > 0 THEN length(regexp_replace(content, '[^\P{C}\n\r\t]|[^\P{Z} ]', '', 'g')) / length(content) ELSE 0.0 END"
_ALLOWED = "(" + ", ".join(f"'{x}'" for x in C.LICENSES) + ")"


@query(f"SELECT ord, ({_RATIO} >= 0.85) AS printable FROM documents_raw")
def clean_printable(spark, d):
    return _t(spark, d, "documents_raw").select("ord", (T.printable_ratio(F.col("content")) >= 0.85).alias("printable"))


@query(f"SELECT ord FROM documents_raw WHERE license IS NOT NULL AND license IN {_ALLOWED}")
def clean_license(spark, d):
    return _t(spark, d, "documents_raw").where(C.allowed_license(F.col("license"), unknown=False)).select("ord")


@query("SELECT ord FROM documents_raw WHERE length(content) BETWEEN 50 AND 100000")
def clean_length(spark, d):
    return _t(spark, d, "documents_raw").where(F.length("content").between(50, 100_000)).select("ord")


@query("SELECT ord FROM (SELECT ord, replace(file_path, '\\', '/') AS p FROM documents_raw) WHERE (ends_with(p, '.go') OR ends_with(p, '.py')) AND NOT (" + " OR ".join(f"contains(p, '{x}')" for x in C.EXCLUDES) + ")")
def path_filter(spark, d):
    return _t(spark, d, "documents_raw").where(C.wanted_path(F.col("file_path"), [".go", ".py"])).select("ord")


def _re2(rx: str) -> tuple[str, str]:
    """A redaction pattern in the dialect of the SQL engine, which has word borders for look-arounds, and its options."""
    plain = rx.replace(redact._L, r"\b").replace(redact._R, r"\b")
    return plain.removeprefix("(?s)"), "s" if plain.startswith("(?s)") else ""


_PII = [(*_re2(rx), to) for rx, to in redact.PATTERNS]


def _scrub_sql(source: str, cols: str) -> str:
    """Common table expressions s0..s6 of the redaction stages of a text column c."""
    out = [f"s0 AS ({source})"]
    for i, (rx, opt, to) in enumerate(_PII):
        o = "'g" + opt + "'"
        body = f"(?s){rx}" if opt else rx
        out.append(f"s{i + 1} AS (SELECT {cols}, regexp_replace(c, '{rx}', '{to}', {o}) AS c, n + coalesce(len(regexp_extract_all(c, '{body}')), 0) AS n FROM s{i})")
    return ",\n".join(out)


@query("WITH " + _scrub_sql("SELECT ord, content AS c, CAST(0 AS BIGINT) AS n FROM documents_raw", "ord") + "\nSELECT ord, md5(c) AS digest, CAST(n AS BIGINT) AS redactions FROM s6")
def scrub_pii(spark, d):
    return scrub(_t(spark, d, "documents_raw"), "content").select("ord", F.md5("content").alias("digest"), "redactions")


@query("SELECT min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text")
def exact_dedup(spark, d):
    docs = _t(spark, d, "documents").where("text is not null").withColumn("drop_reason", F.lit(None).cast("string"))
    return C.exact_marked(docs, "doc_id", "text").where("drop_reason is null").select("doc_id")


_REASONS = (
    "WITH a AS (SELECT ord, content, CASE WHEN " + _RATIO + " < 0.85 THEN 'encoding' WHEN license IS NOT NULL AND license NOT IN " + _ALLOWED + " THEN 'license' END AS r FROM documents_raw),\n"
    + _scrub_sql("SELECT ord, content, r, CASE WHEN r IS NULL THEN content END AS c, CAST(0 AS BIGINT) AS n FROM a", "ord, content, r")
    + ",\nb AS (SELECT ord, n, coalesce(c, content) AS c, coalesce(r, CASE WHEN length(coalesce(c, content)) NOT BETWEEN 50 AND 100000 THEN 'length' END) AS r FROM s6),\n"
    "e AS (SELECT ord, n, CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY r IS NULL, c ORDER BY ord) > 1 THEN 'exact_duplicate' ELSE r END AS r FROM b)\n"
)
_NO_NEAR = C.CleanOptions(near_threshold=2.0)


@query(_REASONS + "SELECT ord, r AS drop_reason, CAST(n AS BIGINT) AS redactions FROM e")
def clean_drop_reason(spark, d):
    return C.clean(_t(spark, d, "documents_raw"), "ord", _NO_NEAR).select("ord", "drop_reason", "redactions")


@query(_REASONS + "SELECT count(*) AS total_in, count(*) FILTER (r IS NULL) AS total_out, " + ", ".join(f"count(*) FILTER (r = '{x}') AS {x}" for x in C.REASONS) + ", CAST(coalesce(sum(n), 0) AS BIGINT) AS redactions FROM e")
def clean_stats(spark, d):
    return C.clean_stats(C.clean(_t(spark, d, "documents_raw"), "ord", _NO_NEAR))


@query()
def clean_full(spark, d):
    return C.clean(_t(spark, d, "documents_raw"), "ord").select("ord", "drop_reason", "content_hash")


@query()
def near_dedup(spark, d):
    return M.greedy_near_duplicates(_t(spark, d, "documents").select(F.col("doc_id").alias("ord"), "text"), 0.85).withColumnRenamed("ord", "doc_id")


_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


@query(
    f"WITH w AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents), g AS (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, CAST(len(w) - 3 AS BIGINT)), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [NULL] END) AS x FROM w)\n"
    "SELECT doc_id, CAST(any_value(len(w)) AS BIGINT) AS words, count(DISTINCT x) AS shingles FROM g GROUP BY doc_id"
)
def shingles(spark, d):
    docs = _t(spark, d, "documents").withColumn("text", F.coalesce("text", F.lit("")))
    return docs.select("doc_id", F.size(T.word_list(F.col("text"))).cast("long").alias("words"), F.size(T.shingles(F.col("text"))).cast("long").alias("shingles"))


_FIRST = "CASE WHEN {0} THEN {1} WHEN {2} THEN {3} ELSE '' END"


@query(
    "WITH k AS (SELECT ord, CASE WHEN ord % 3 <> 0 THEN instruction ELSE ' ' END AS instruction, CASE WHEN ord % 3 = 0 THEN instruction END AS question, CASE WHEN ord % 4 <> 1 THEN response END AS output, CASE WHEN ord % 4 = 1 THEN response ELSE 'late' END AS code, CASE WHEN ord % 2 = 0 THEN context END AS context, role AS input FROM pairs)\n"
    "SELECT ord, md5(i) AS instruction, md5(r) AS response, md5(c) AS context FROM (SELECT ord, "
    + ", ".join(_strip(_FIRST.format(_filled(a), a, _filled(b), b)) + f" AS {n}" for a, b, n in (("instruction", "question", "i"), ("output", "code", "r"), ("context", "input", "c")))
    + " FROM k) WHERE i <> '' AND r <> ''"
)
def normalize_rows(spark, d):
    when = lambda c, x: F.when(F.expr(c), F.col(x))
    rows = _t(spark, d, "pairs").select("ord", F.coalesce(when("ord % 3 <> 0", "instruction"), F.when(F.expr("ord % 3 = 0"), F.lit(" "))).alias("instruction"), when("ord % 3 = 0", "instruction").alias("question"), when("ord % 4 <> 1", "response").alias("output"), F.when(F.expr("ord % 4 = 1"), F.col("response")).otherwise("late").alias("code"), when("ord % 2 = 0", "context").alias("context"), F.col("role").alias("input"), F.lit(7).alias("task"))
    return P.normalize(rows, ["ord"]).select("ord", *[F.md5(c).alias(c) for c in ("instruction", "response", "context")])


@query(
    "WITH t AS (SELECT ord, CASE WHEN " + _filled("instruction") + " THEN " + _strip("instruction") + " ELSE 'first of ' || ord END AS i, CASE WHEN " + _filled("response") + " THEN " + _strip("response") + " ELSE 'early' END AS r, CASE WHEN " + _filled("context") + " THEN " + _strip("context") + " || chr(10) ELSE '' END || 'be brief' AS c FROM pairs)\n"
    "SELECT ord, md5(i) AS instruction, md5(r) AS response, md5(c) AS context FROM t"
)
def chat_to_pairs(spark, d):
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    turns = [turn("system", F.col("context")), turn("user", F.concat(F.lit(" first of "), F.col("ord"))), turn("assistant", F.lit("early")), turn("user", F.col("instruction")), turn("tool", F.lit("x")), turn("system", F.lit("be brief\n")), turn("assistant", F.col("response")), turn("user", F.lit(" \n"))]
    chat = _t(spark, d, "pairs").select("ord", F.array(*turns).alias("messages"), F.lit("never").alias("instruction"))
    return P.normalize(chat, ["ord"]).select("ord", *[F.md5(c).alias(c) for c in ("instruction", "response", "context")])


@query("SELECT doc_id FROM documents WHERE lower(" + _strip("lang") + ") = 'de'")
def language_filter_declared(spark, d):
    docs = _t(spark, d, "documents")
    return docs.where(P.in_language(P.declared_language(docs), "de")).select("doc_id")


@query(
    "SELECT ord FROM (SELECT ord, concat_ws(chr(10), coalesce(instruction, ''), coalesce(response, ''), coalesce(context, '')) AS t FROM pairs) WHERE regexp_matches(t, '(?i)```go(?:[^\\p{L}\\p{N}_]|\\z)') OR contains(t, 'package ') OR contains(t, 'func ') OR contains(t, ':= ') OR contains(t, 'import (')"
)
def language_filter_heuristic(spark, d):
    return _t(spark, d, "pairs").where(P.in_language(F.lit(None).cast("string"), "go", F.col("instruction"), F.col("response"), F.col("context"))).select("ord")


@query(
    "SELECT ord FROM (SELECT ord, " + _strip("instruction") + " AS i, " + _strip("response") + " AS r, concat_ws(chr(10), " + _strip("instruction") + ", " + _strip("response") + ", coalesce(" + _strip("context") + ", '')) AS t FROM (SELECT * FROM pairs ORDER BY ord LIMIT 2000)) WHERE i <> '' AND r <> '' AND (regexp_matches(t, '(?i)```go(?:[^\\p{L}\\p{N}_]|\\z)') OR contains(t, 'package ') OR contains(t, 'func ') OR contains(t, ':= ') OR contains(t, 'import (')) ORDER BY ord LIMIT 300"
)
def import_capped(spark, d):
    """The scan and match caps are the operator."""
    return P.import_scan(_t(spark, d, "pairs"), "ord", "go", max_results=300, max_scan=2000).select("ord")


@query()
def import_clean(spark, d):
    return P.import_clean(_t(spark, d, "pairs"), "ord").select("ord", "drop_reason", "redactions")


@query(
    "WITH q AS (SELECT ord, sha256(" + _strip("instruction") + " || chr(0) || " + _strip("response") + ") AS h FROM pairs WHERE " + _filled("instruction") + " AND " + _filled("response") + "),\n"
    "v AS (SELECT ord, ('0x' || h[1:4])::INT / 65535.0::DOUBLE AS a, ('0x' || h[5:8])::INT / 65535.0::DOUBLE AS b, ('0x' || h[9:12])::INT / 65535.0::DOUBLE AS c, ('0x' || h[13:16])::INT / 65535.0::DOUBLE AS e FROM q)\n"
    "SELECT p.ord, CASE WHEN v.ord IS NULL THEN 0.0::DOUBLE ELSE round((v.a + v.b + v.c + v.e) / 4, 6) END AS judge_score FROM pairs p LEFT JOIN v ON v.ord = p.ord"
)
def judge_offline(spark, d):
    return J.judge_offline(_t(spark, d, "pairs")).select("ord", "judge_score")


@query("SELECT pair_ord, score FROM judge_results WHERE score >= 0.6")
def judge_filter(spark, d):
    return J.judge_filter(_t(spark, d, "judge_results").withColumnRenamed("score", "judge_score"), 0.6).select("pair_ord", F.col("judge_score").alias("score"))


@query("SELECT ord, CAST(row_number() OVER (ORDER BY score DESC, ord) AS BIGINT) AS rank FROM judge_results WHERE score >= 0.6")
def judge_rank(spark, d):
    return J.judge_rank(_t(spark, d, "judge_results").withColumnRenamed("score", "judge_score"), 0.6).select("ord", "rank")


@query("SELECT source_id, build, ord FROM (SELECT p.source_id, p.build, p.ord, row_number() OVER (PARTITION BY p.source_id, p.build ORDER BY coalesce(j.score, -1) DESC, p.ord) AS k FROM pairs p LEFT JOIN (SELECT pair_ord, max(score) AS score FROM judge_results GROUP BY pair_ord) j ON j.pair_ord = p.ord) WHERE k = 1")
def best_of_k(spark, d):
    j = _t(spark, d, "judge_results").groupBy("pair_ord").agg(F.max("score").alias("score"))
    p = _t(spark, d, "pairs").select("ord", "source_id", "build")
    return G.best_of(p.join(j, p["ord"] == j["pair_ord"], "left").drop("pair_ord"), ["source_id", "build"], F.col("score"), "ord").select("source_id", "build", "ord")


@query("SELECT d.doc_id, r.role FROM documents d, (VALUES ('go_reviewer'), ('go_tester')) r(role) WHERE " + _filled("d.text"))
def doc_role_cross(spark, d):
    roles = G.role_table(spark, ["go_reviewer", "go_tester"])
    return G.doc_roles(_t(spark, d, "documents"), roles, "text").select("doc_id", "role")


@query("SELECT doc_id FROM documents WHERE n_chars IS NOT NULL ORDER BY doc_id LIMIT 250")
def cap_max_pairs(spark, d):
    """The row cap is the operator."""
    return G.capped_rows(_t(spark, d, "documents").where("n_chars is not null"), ["doc_id"], 250).select("doc_id")


@query("SELECT doc_id FROM (SELECT doc_id, coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) WHERE before < 300000")
def cap_running_total(spark, d):
    return G.running_total_cap(_t(spark, d, "documents").select("doc_id", "n_chars"), ["doc_id"], "n_chars", 300_000).select("doc_id")


@query(
    "SELECT doc_id, md5(CASE WHEN length(text) <= 400 THEN text ELSE (CASE WHEN length(regexp_extract(substring(text, 1, 400), '(?s)^(.*)\\n', 1)) > 200 THEN regexp_extract(substring(text, 1, 400), '(?s)^(.*)\\n', 1) ELSE substring(text, 1, 400) END) || chr(10) || '... [truncated]' END) AS digest FROM documents WHERE text IS NOT NULL"
)
def truncate_context(spark, d):
    return _t(spark, d, "documents").where("text is not null").select("doc_id", F.md5(T.truncate_lines(F.col("text"), 400)).alias("digest"))


@query(
    "WITH b AS (SELECT ord, response, list_filter(list_transform(regexp_extract_all(response, '(?is)```go(?:[^\\p{L}\\p{N}_\\n][^\\n]*)?\\n(.*?)```', 1), lambda x: trim(x, chr(10))), lambda x: regexp_matches(x, '[^\\s\\p{Z}]')) AS t, list_filter(list_transform(regexp_extract_all(response, '(?s)```[^\\n]*\\n(.*?)```', 1), lambda x: trim(x, chr(10))), lambda x: regexp_matches(x, '[^\\s\\p{Z}]')) AS f FROM pairs)\n"
    "SELECT ord, CAST(CASE WHEN len(t) > 0 THEN len(t) WHEN len(f) > 0 THEN len(f) WHEN regexp_matches(response, '(?s)\\A\\s*package\\s+\\w+.*\\bfunc\\b') THEN 1 ELSE 0 END AS BIGINT) AS blocks, md5(CASE WHEN len(t) > 0 THEN t[1] WHEN len(f) > 0 THEN f[1] WHEN regexp_matches(response, '(?s)\\A\\s*package\\s+\\w+.*\\bfunc\\b') THEN trim(response, chr(10)) END) AS first FROM b"
)
def extract_code(spark, d):
    return _t(spark, d, "pairs").select("ord", V.code_blocks(F.col("response")).alias("b")).select("ord", F.size("b").cast("long").alias("blocks"), F.md5(F.try_element_at("b", F.lit(1))).alias("first"))


@query("SELECT count(*) AS generated, count(*) FILTER (verify_status = 'failed') AS verified_dropped, count(*) FILTER (verify_status IS DISTINCT FROM 'failed' AND score < 0.6) AS judged_dropped, count(*) FILTER (verify_status IS DISTINCT FROM 'failed' AND coalesce(score >= 0.6, true)) AS kept FROM pairs p LEFT JOIN (SELECT pair_ord, max(score) AS score FROM judge_results GROUP BY pair_ord) j ON j.pair_ord = p.ord")
def gate_stats(spark, d):
    j = _t(spark, d, "judge_results").groupBy("pair_ord").agg(F.max("score").alias("score"))
    p = _t(spark, d, "pairs").select("ord", "verify_status")
    return G.gate_stats(p.join(j, F.col("ord") == F.col("pair_ord"), "left"), F.col("verify_status") != "failed", F.col("score") >= 0.6)


@query(
    "SELECT ord, md5(concat_ws('|', 'You are a careful programming assistant.', CASE WHEN c = '' THEN i ELSE i || chr(10) || chr(10) || c END, r)) AS digest FROM (SELECT ord, coalesce(" + _strip("instruction") + ", '') AS i, coalesce(" + _strip("response") + ", '') AS r, coalesce(" + _strip("context") + ", '') AS c FROM pairs) WHERE i <> '' AND r <> ''"
)
def sft_records(spark, d):
    recs = B.records(_t(spark, d, "pairs"), ["ord"], on_error="drop")
    return recs.select("ord", F.md5(F.concat_ws("|", F.transform("messages", lambda m: m["content"]))).alias("digest"))


@query("SELECT split, count(*) AS records FROM (SELECT CASE WHEN row_number() OVER (ORDER BY sha256('7:' || ord), ord) <= CAST(floor(count(*) OVER () * 0.1::DOUBLE) AS BIGINT) THEN 'validation' ELSE 'train' END AS split FROM pairs WHERE " + _filled("instruction") + " AND " + _filled("response") + ") GROUP BY split")
def split_sizes(spark, d):
    recs = B.records(_t(spark, d, "pairs"), ["ord"], on_error="drop")
    return B.split_sizes(B.split(recs, "ord", 0.1, 7))


@query("SELECT ord, CASE WHEN row_number() OVER (ORDER BY sha256('7:' || ord), ord) <= CAST(floor(count(*) OVER () * 0.1::DOUBLE) AS BIGINT) THEN 'validation' ELSE 'train' END AS split FROM pairs WHERE " + _filled("instruction") + " AND " + _filled("response"))
def split_rows(spark, d):
    recs = B.records(_t(spark, d, "pairs"), ["ord"], on_error="drop")
    return B.split(recs, "ord", 0.1, 7).select("ord", "split")


@query(
    "WITH r AS (SELECT ord, row_number() OVER (ORDER BY sha256('42:' || ord), ord) - 1 AS p, CAST(floor(count(*) OVER () * 0.1::DOUBLE) AS BIGINT) AS n FROM pairs WHERE " + _filled("instruction") + " AND " + _filled("response") + ")\n"
    "SELECT ord, CASE WHEN p < n THEN 'validation' ELSE 'train' END AS split, CAST(CASE WHEN p < n THEN p ELSE p - n END AS BIGINT) AS pos FROM r"
)
def split_shuffle(spark, d):
    recs = B.records(_t(spark, d, "pairs"), ["ord"], on_error="drop")
    return B.split(recs, "ord", 0.1, 42).select("ord", "split", "pos")


@query(
    "WITH i AS (SELECT ord, id, coalesce(nullif(url, ''), nullif(fetch_url, '')) AS u FROM source_records), p AS (SELECT url, min(content) AS content FROM download_results WHERE url IS NOT NULL GROUP BY url)\n"
    "SELECT i.id, CASE WHEN p.content IS NOT NULL THEN 'success' ELSE 'failed' END AS status, CASE WHEN i.u IS NULL THEN 'no url' WHEN p.content IS NULL THEN 'not stored' END AS error FROM i LEFT JOIN p ON p.url = i.u"
)
def fetch_replay(spark, d):
    from tamis.sources.fetch import fetch_replay as replay

    pages = _t(spark, d, "download_results").where("url is not null")
    return replay(_t(spark, d, "source_records"), pages).select("id", "status", "error")


@query("SELECT ord, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS host, CAST((row_number() OVER (PARTITION BY regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) ORDER BY ord) - 1) * 2.0 AS DOUBLE) AS start FROM source_records WHERE url LIKE '%://%'")
def host_schedule(spark, d):
    from tamis.sources.fetch import host_schedule as schedule

    return schedule(_t(spark, d, "source_records").where("url like '%://%'"), 2.0, "ord").select("ord", "host", "start")


@query("SELECT count(*) FILTER (status IN ('success', 'cached')) AS succeeded, count(*) AS total FROM download_results")
def download_success(spark, d):
    from tamis.sources.fetch import successes

    return successes(_t(spark, d, "download_results"))


@query("WITH l AS (SELECT id, list(license ORDER BY found_at DESC, ord DESC)[1] AS license FROM source_records GROUP BY id) SELECT r.ord, l.license FROM download_results r LEFT JOIN l ON l.id = r.id")
def download_license_join(spark, d):
    from tamis.sources.fetch import with_license

    return with_license(_t(spark, d, "download_results"), _t(spark, d, "source_records")).select("ord", "license")


@query("SELECT ord, 'github' AS source, id, coalesce(nullif(title, ''), id) AS title, license, extra.clone_url AS fetch_url, extra.stars AS stars FROM source_records WHERE source = 'github'")
def code_host_standardize(spark, d):
    from tamis.sources import code_host_records

    raw = _t(spark, d, "source_records").where("source = 'github'")
    payload = raw.select(F.col("id").alias("full_name"), F.col("url").alias("html_url"), F.col("title").alias("description"), F.struct(F.col("license").alias("spdx_id")).alias("license"), F.col("extra.clone_url").alias("clone_url"), F.col("extra.default_branch").alias("default_branch"), F.col("extra.stars").alias("stargazers_count"), F.col("extra.language").alias("language"), F.col("extra.updated_at").alias("updated_at"), "ord")
    made = code_host_records(payload.withColumn("full_name", F.concat("full_name", F.lit("\0"), "ord")))
    return made.select(F.element_at(F.split("id", "\0"), 2).cast("long").alias("ord"), "source", F.element_at(F.split("id", "\0"), 1).alias("id"), F.when(F.col("title").contains("\0"), F.element_at(F.split("title", "\0"), 1)).otherwise(F.col("title")).alias("title"), "license", "fetch_url", F.col("extra.stars").alias("stars"))


from tamis import more_queries  # noqa: E402,F401  registers the rest


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The cleaning query with all stages: kept documents."""
    return C.kept(C.clean(_t(spark, d, "documents_raw"), "ord"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
