"""Queries of sources, sinks, near-duplicates, generation and the gate, and SQL with the same results."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.operators import build as B
from tamis.operators import clean as C
from tamis.operators import generate as G
from tamis.operators import judge as J
from tamis.operators import minhash as M
from tamis.operators import pairs as P
from tamis.operators import teach as X
from tamis.operators import verify as V
from tamis.plans import pipeline
from tamis.plans.runtime import positions, scratch
from tamis.queries import _RATIO, _filled, _scrub_sql, _strip, _t, query

_Q = chr(39) * 2


def _stripped(c: str) -> str:
    return f"coalesce({_strip(c)}, '')"


# --- MinHash and near-duplicates, by SHA-256 -------------------------------------------------------------------


def _coefficient_rows(seed: int = 1) -> str:
    a, b = M.coefficients(seed=seed)
    return ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(zip(a, b)))


def _signatures_sql(source: str) -> str:
    """Common table expressions up to ``sig(id, i, v)``, the signatures of ``source(id, text)`` by SHA-256."""
    grams = "CASE WHEN len(w) >= 5 THEN list_transform(range(1, CAST(len(w) - 3 AS BIGINT)), lambda i: array_to_string(w[i:i+4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"
    return (
        f"src AS ({source}),\nwords AS (SELECT id, coalesce(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), []) AS w FROM src),\n"
        f"grams AS (SELECT DISTINCT id, unnest({grams}) AS g FROM words),\n"
        "hashed AS (SELECT id, ('0x' || substr(sha256(g), 1, 16))::UBIGINT::HUGEINT AS h FROM grams),\n"
        f"coef(i, a, b) AS (VALUES {_coefficient_rows()}),\n"
        f"sig AS (SELECT s.id, c.i, coalesce(min((c.a * h.h + c.b) % {M.PRIME}), 0) AS v FROM src s CROSS JOIN coef c LEFT JOIN hashed h ON h.id = s.id GROUP BY s.id, c.i)"
    )


def _greedy_sql(source: str, threshold: float) -> str:
    """Common table expressions up to ``gone(id)``, what the scan in order drops. ``source`` has the id and text."""
    need = M.least_equal(threshold)
    return (
        _signatures_sql(source) + ",\n"
        "whole AS MATERIALIZED (SELECT id, list(v ORDER BY i) AS s FROM sig GROUP BY id),\n"
        "rep AS MATERIALIZED (SELECT min(id) AS id, s FROM whole GROUP BY s),\n"
        "rv AS MATERIALIZED (SELECT id, unnest(range(64)) AS i, unnest(s) AS v FROM rep),\n"
        f"edge AS MATERIALIZED (SELECT x.id AS late, y.id AS early FROM rv x JOIN rv y ON x.i = y.i AND x.v = y.v AND y.id < x.id GROUP BY 1, 2 HAVING count(*) >= {need}),\n"
        "adj AS MATERIALIZED (SELECT late, list(early) AS e, row_number() OVER (ORDER BY late) AS k FROM edge GROUP BY late),\n"
        "walk AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS dropped UNION ALL SELECT w.k + 1, CASE WHEN len(list_filter(a.e, lambda x: NOT list_contains(w.dropped, x))) > 0 THEN list_append(w.dropped, a.late) ELSE w.dropped END FROM walk w JOIN adj a ON a.k = w.k + 1),\n"
        "gone AS (SELECT unnest(arg_max(dropped, k)) AS id FROM walk UNION ALL SELECT w.id FROM whole w JOIN rep r ON r.s = w.s WHERE w.id <> r.id)"
    )


@query(f"WITH {_signatures_sql('SELECT doc_id AS id, text FROM documents')}\nSELECT id AS doc_id, md5(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS digest FROM sig GROUP BY id")
def minhash_sha256(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("ord"), "text")
    return M.signatures(docs, "sha256").select(F.col("ord").alias("doc_id"), F.md5(F.array_join(F.transform("sig", lambda x: x.cast("string")), ",")).alias("digest"))


@query("WITH RECURSIVE c(i, s) AS (SELECT 0, 1::BIGINT UNION ALL SELECT i + 1, (1103515245 * s + 12345) % 2147483648 FROM c WHERE i < 128)\nSELECT CAST(x.i - 1 AS BIGINT) AS i, greatest(x.s, 1) AS a, y.s AS b FROM c x JOIN c y ON y.i = x.i + 64 WHERE x.i BETWEEN 1 AND 64")
def minhash_coefficients(spark, d):
    a, b = M.coefficients()
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(zip(a, b))], "i bigint, a bigint, b bigint")


@query(f"WITH {_signatures_sql('SELECT doc_id AS id, text FROM documents')},\nn AS (SELECT id, lead(id) OVER (ORDER BY id) AS other FROM src)\nSELECT n.id AS doc_id, count(*) FILTER (x.v = y.v) / 64.0::DOUBLE AS similarity FROM n JOIN sig x ON x.id = n.id JOIN sig y ON y.id = n.other AND y.i = x.i GROUP BY n.id")
def minhash_similarity(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("ord"), "text")
    placed = positions(M.signatures(docs, "sha256"), [F.col("ord")], "k")
    other = placed.select((F.col("k") - 1).alias("k"), F.col("sig").alias("sig2"))
    return placed.join(other, "k").select(F.col("ord").alias("doc_id"), M.similarity(F.col("sig"), F.col("sig2")).alias("similarity"))


@query(f"WITH RECURSIVE {_greedy_sql('SELECT doc_id AS id, text FROM documents', 0.85)}\nSELECT id AS doc_id FROM gone")
def near_dedup_sha256(spark, d):
    return M.greedy_near_duplicates(_t(spark, d, "documents").select(F.col("doc_id").alias("ord"), "text"), 0.85, "sha256").withColumnRenamed("ord", "doc_id")


@query(f"WITH RECURSIVE {_greedy_sql('SELECT doc_id AS id, text FROM documents', 0.5)}\nSELECT id AS doc_id FROM gone")
def near_dedup_half(spark, d):
    """A low threshold, at which chains of similar documents are long."""
    return M.greedy_near_duplicates(_t(spark, d, "documents").select(F.col("doc_id").alias("ord"), "text"), 0.5, "sha256").withColumnRenamed("ord", "doc_id")


_ALLOWED = "(" + ", ".join(f"'{x}'" for x in C.LICENSES) + ")"
_MARKED = (
    "a AS (SELECT ord, content, CASE WHEN " + _RATIO + " < 0.85 THEN 'encoding' WHEN license IS NOT NULL AND license NOT IN " + _ALLOWED + " THEN 'license' END AS r FROM documents_raw),\n"
    + _scrub_sql("SELECT ord, content, r, CASE WHEN r IS NULL THEN content END AS c, CAST(0 AS BIGINT) AS n FROM a", "ord, content, r")
    + ",\nb AS (SELECT ord, n, coalesce(c, content) AS c, coalesce(r, CASE WHEN length(coalesce(c, content)) NOT BETWEEN 50 AND 100000 THEN 'length' END) AS r FROM s6),\n"
    "e AS MATERIALIZED (SELECT ord, n, c, CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY r IS NULL, c ORDER BY ord) > 1 THEN 'exact_duplicate' ELSE r END AS r, CASE WHEN r IS NULL THEN sha256(c) END AS h FROM b)"
)


@query(f"WITH RECURSIVE {_MARKED},\n{_greedy_sql('SELECT ord AS id, c AS text FROM e WHERE r IS NULL', 0.85)}\nSELECT ord, CASE WHEN g.id IS NOT NULL THEN 'near_duplicate' ELSE r END AS drop_reason, h AS content_hash FROM e LEFT JOIN gone g ON g.id = e.ord")
def clean_full_sha256(spark, d):
    return C.clean(_t(spark, d, "documents_raw"), "ord", C.CleanOptions(hash="sha256")).select("ord", "drop_reason", "content_hash")


def _import_sql() -> str:
    """Common table expressions up to ``m(ord, c, n, r)``: redacted pairs with both sides, marked up to exact copies."""
    out = []
    for f in ("instruction", "response", "context"):
        stages = _scrub_sql(f"SELECT ord, {f} AS c, CAST(0 AS BIGINT) AS n FROM pairs", "ord")
        for k in range(7):
            stages = stages.replace(f"s{k} AS", f"{f[0]}{k} AS").replace(f"FROM s{k})", f"FROM {f[0]}{k})")
        out.append(stages)
    joined = "concat_ws(chr(10) || chr(10), " + ", ".join(f"CASE WHEN {x}6.c <> '' THEN {x}6.c END" for x in "icr") + ")"
    both = f"p AS (SELECT i6.ord, {joined} AS content, CAST(i6.n + r6.n + c6.n AS BIGINT) AS n FROM i6 JOIN r6 ON r6.ord = i6.ord JOIN c6 ON c6.ord = i6.ord WHERE {_filled('i6.c')} AND {_filled('r6.c')})"
    mark = f"q AS (SELECT ord, content AS c, n, CASE WHEN {_RATIO} < 0.85 THEN 'encoding' WHEN length(content) NOT BETWEEN 40 AND 20000 THEN 'length' END AS r FROM p)"
    exact = "m AS MATERIALIZED (SELECT ord, c, n, CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY r IS NULL, c ORDER BY ord) > 1 THEN 'exact_duplicate' ELSE r END AS r FROM q)"
    return ",\n".join([*out, both, mark, exact])


_IMPORT = {"min_length": 40, "max_length": 20_000, "scrub": False}


@query(f"WITH RECURSIVE {_import_sql()},\n{_greedy_sql('SELECT ord AS id, c AS text FROM m WHERE r IS NULL', 0.85)}\nSELECT ord, CASE WHEN g.id IS NOT NULL THEN 'near_duplicate' ELSE r END AS drop_reason, n AS redactions FROM m LEFT JOIN gone g ON g.id = m.ord")
def import_clean_sha256(spark, d):
    return P.import_clean(_t(spark, d, "pairs"), "ord", C.CleanOptions(**_IMPORT, hash="sha256")).select("ord", "drop_reason", "redactions")


@query(f"WITH {_import_sql()}\nSELECT count(*) AS total_in, count(*) FILTER (r IS NULL) AS total_out, " + ", ".join(f"count(*) FILTER (r = '{x}') AS {x}" for x in C.REASONS) + ", CAST(coalesce(sum(n), 0) AS BIGINT) AS redactions FROM m")
def import_stats(spark, d):
    return C.clean_stats(P.import_clean(_t(spark, d, "pairs"), "ord", C.CleanOptions(**_IMPORT, near_threshold=2.0)))


# --- generation and gate -------------------------------------------------------------------------------------

_CONTEXT = "CASE WHEN length(content) <= 8000 THEN content ELSE (CASE WHEN strpos(substring(content, 1, 8000), chr(10)) > 0 AND 8000 - strpos(reverse(substring(content, 1, 8000)), chr(10)) > 4000 THEN substring(content, 1, CAST(8000 - strpos(reverse(substring(content, 1, 8000)), chr(10)) AS BIGINT)) ELSE substring(content, 1, 8000) END) || chr(10) || '... [truncated]' END"
_ROLE_ROWS = lambda names: ", ".join(f"({i}, '{n}', '{G.get_role(n).task}', '{G.get_role(n).prompt}')" for i, n in enumerate(names))


def _units_sql(names: list[str]) -> str:
    return f"u AS (SELECT d.ord, r.*, {_CONTEXT} AS ctx FROM documents_raw d, (VALUES {_ROLE_ROWS(names)}) r(role_ord, role, task, prompt) WHERE {_filled('d.content')})"


_OFFLINE = (
    _units_sql(["go_reviewer", "go_tester"]) + ",\n"
    "o AS (SELECT *, 'As a ' || replace(role, '_', ' ') || ': ' || task || '. The code begins with {\"head\":' || CAST(to_json(substring(regexp_extract(" + _strip("ctx") + ", '\\A([^\\n\\x0B\\f\\r\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]*)', 1), 1, 80)) AS VARCHAR) || '}.' AS instruction, '[offline:' || role || ':' || substr(sha256(ctx), 1, 8) || '] stands in for an answer over ' || length(ctx) || ' characters.' AS response FROM u),\n"
    "h AS (SELECT *, sha256(" + _strip("instruction") + " || chr(0) || " + _strip("response") + ") AS x FROM o),\n"
    "j AS (SELECT *, round((('0x' || x[1:4])::INT / 65535.0::DOUBLE + ('0x' || x[5:8])::INT / 65535.0::DOUBLE + ('0x' || x[9:12])::INT / 65535.0::DOUBLE + ('0x' || x[13:16])::INT / 65535.0::DOUBLE) / 4, 6) AS judge_score FROM h)\n"
)


@query("WITH " + _OFFLINE + "SELECT ord, role, instruction, response, judge_score FROM j WHERE judge_score >= 0.5")
def offline_generate(spark, d):
    docs = _t(spark, d, "documents_raw").where("content is not null")
    return pipeline.generated(docs, ["go_reviewer", "go_tester"], samples=2, threshold=0.5).select("ord", "role", "instruction", "response", "judge_score")


@query("WITH " + _OFFLINE + "SELECT ord, role, CAST(0 AS INTEGER) AS slot, 'no_code' AS verify_status, judge_score FROM j WHERE judge_score >= 0.6")
def gated_generate(spark, d):
    """With a gate there is at least one slot; what has no code passes a check that isn't strict."""
    docs = _t(spark, d, "documents_raw").where("content is not null")
    return pipeline.generated(docs, ["go_reviewer", "go_tester"], max_pairs_per_doc=0, samples=3, threshold=0.6, verify={"available": False}).select("ord", "role", "slot", "verify_status", "judge_score")


@query(f"SELECT * FROM (VALUES {', '.join(f'({i}, {chr(39)}{n}{chr(39)}, {chr(39)}{G.get_role(n).task}{chr(39)})' for i, n in enumerate(['go_tester', 'go_reviewer']))}) r(role_ord, role, task)")
def role_lookup(spark, d):
    return G.role_table(spark, ["go_tester", "go_reviewer"])


@query(f"WITH {_units_sql(['go_reviewer', 'go_tester'])}\nSELECT ord, role, md5(prompt) AS system, md5('Here is real code from an open project. Take it as the ground to ' || task || '.' || chr(10) || chr(10) || 'Write 2 pair(s). An instruction must stand alone, with all code that it speaks of; a response must be whole and right.' || chr(10) || 'Answer with one JSON object and nothing else: {{\"pairs\": [{{\"instruction\": \"...\", \"response\": \"...\"}}]}}' || chr(10) || chr(10) || '----- code -----' || chr(10) || ctx || chr(10) || '----- end -----') AS \"user\" FROM u")
def teacher_prompts(spark, d):
    units = G.doc_roles(_t(spark, d, "documents_raw"), G.role_table(spark, ["go_reviewer", "go_tester"], prompts=True))
    asked = X.teacher_prompt(F.col("prompt"), F.col("task"), T.truncate_lines(F.col("content")), 2)
    return units.select("ord", "role", asked.alias("m")).select("ord", "role", F.md5(F.col("m")[0]["content"]).alias("system"), F.md5(F.col("m")[1]["content"]).alias("user"))


_CUT = lambda c, n: f"CASE WHEN length({c}) <= {n} THEN {c} ELSE substring({c}, 1, {n}) || chr(10) || '... [truncated]' END"


@query("SELECT ord, md5('Rate the response to the instruction on every axis from 0 to 1.' || chr(10) || 'Answer with one JSON object and nothing else: {\"correctness\": 0.0, \"idiomatic\": 0.0, \"completeness\": 0.0, \"alignment\": 0.0, \"rationale\": \"...\"}' || chr(10) || chr(10) || " + " || ".join(f"'----- {c} -----' || chr(10) || {_CUT(f'coalesce({c}, {_Q})', 200)} || chr(10)" for c in ("instruction", "response", "context")) + ") AS \"user\" FROM pairs")
def judge_prompts(spark, d):
    asked = X.judge_prompt(F.col("instruction"), F.col("response"), F.col("context"), 200)
    return _t(spark, d, "pairs").select("ord", F.md5(asked[1]["content"]).alias("user"))


@query(f"SELECT ord, md5({_CUT('response', 100)}) AS cut, md5({_CUT(_stripped('response'), 60)}) AS clipped FROM pairs")
def truncate_and_clip(spark, d):
    return _t(spark, d, "pairs").select("ord", F.md5(T.truncate(F.col("response"), 100)).alias("cut"), F.md5(T.clip(F.col("response"), 60)).alias("clipped"))


def _teacher(asked: list[dict]) -> tuple[str, int, int]:
    """A stand-in for a model: it tells the length of the code, and costs a dollar at a dollar a million tokens."""
    code = asked[1]["content"].split("----- code -----\n", 1)[1].removesuffix("\n----- end -----")
    return json.dumps({"pairs": [{"instruction": f"measure {len(code)}", "response": f" size {len(code) % 97} "}]}), 1_000_000, 0


def _judge(asked: list[dict]) -> tuple[str, int, int]:
    """A stand-in for a judge: the size's last digit, in tenths, in a fence."""
    size = int(asked[1]["content"].split("----- response -----\nsize ", 1)[1].split("\n", 1)[0])
    score = size % 10 / 10
    return "Verdict:\n```json\n" + json.dumps(dict.fromkeys(J.AXES, score)) + "\n```", 500_000, 0


@query(f"WITH {_units_sql(['go_reviewer', 'go_tester'])},\nk AS (SELECT ord, role, length(ctx) AS n, row_number() OVER (ORDER BY ord, role_ord) AS i FROM u)\nSELECT ord, role, 'measure ' || n AS instruction, 'size ' || (n % 97) AS response FROM k WHERE i <= 3")
def teach_budget(spark, d):
    """A dollar a call under a cap of 2.5 dollars is three calls. The cap is the operator."""
    plan = X.Plan(["go_reviewer", "go_tester"], max_spend=2.5, wave=2, price_in=Decimal(1))
    return X.teach(_t(spark, d, "documents_raw"), plan, _teacher).pairs.select("ord", "role", "instruction", "response")


@query(f"WITH {_units_sql(['go_reviewer'])}\nSELECT ord, 'size ' || (length(ctx) % 97) AS response, round(length(ctx) % 97 % 10 / 10.0::DOUBLE, 6) AS judge_score FROM u WHERE round(length(ctx) % 97 % 10 / 10.0::DOUBLE, 6) >= 0.5")
def teach_gate(spark, d):
    """Two samples a slot, the judge's verdicts, and the best of each slot, over all documents."""
    plan = X.Plan(["go_reviewer"], samples=2, judge=_judge, threshold=0.5, wave=100_000)
    return X.teach(_t(spark, d, "documents_raw"), plan, _teacher).pairs.select("ord", "response", "judge_score")


@query("SELECT role, CAST(sum(coalesce(length(context), 0) * 14 + coalesce(length(response), 0) * 28) AS BIGINT) AS spend FROM pairs GROUP BY role")
def spend_by_role(spark, d):
    """In units of 10^-8 dollars."""
    calls = _t(spark, d, "pairs").withColumn("cost", X.cost(F.length("context"), F.length("response")))
    return X.spend(calls, ["role"]).select("role", (F.col("spend") * 100_000_000).cast("bigint").alias("spend"))


@query("WITH c AS (SELECT ord, ord % 3 AS k, length(response) AS n FROM pairs WHERE response IS NOT NULL), u AS (SELECT CAST(floor(ord / 6) AS BIGINT) AS unit, CAST(k AS INTEGER) AS sample, ord, n, coalesce(sum(n) OVER (ORDER BY CAST(floor(ord / 6) AS BIGINT), k, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)\nSELECT unit, CAST(count(*) AS BIGINT) AS calls, max(n) AS best FROM u WHERE before < 200000 GROUP BY unit")
def sample_cap(spark, d):
    """The cap is checked before every sample; a unit keeps the samples that came before it."""
    calls = _t(spark, d, "pairs").where("response is not null").select(F.floor(F.col("ord") / 6).alias("unit"), (F.col("ord") % 3).cast("int").alias("sample"), "ord", F.length("response").alias("n"))
    ran = G.running_total_cap(calls, ["unit", "sample", "ord"], "n", 200_000)
    return ran.groupBy("unit").agg(F.count("*").alias("calls"), F.max("n").cast("long").alias("best"))


_BLOCKS = "b AS (SELECT ord, role, instruction, response, CASE WHEN len(t) > 0 THEN t WHEN len(f) > 0 THEN f WHEN regexp_matches(response, '(?s)\\A\\s*package\\s+\\w+.*\\bfunc\\b') THEN [trim(response, chr(10))] ELSE [] END AS x FROM (SELECT *, list_filter(list_transform(regexp_extract_all(response, '(?is)```go(?:[^\\p{L}\\p{N}_\\n][^\\n]*)?\\n(.*?)```', 1), lambda x: trim(x, chr(10))), lambda x: regexp_matches(x, '[^\\s\\p{Z}]')) AS t, list_filter(list_transform(regexp_extract_all(response, '(?s)```[^\\n]*\\n(.*?)```', 1), lambda x: trim(x, chr(10))), lambda x: regexp_matches(x, '[^\\s\\p{Z}]')) AS f FROM pairs))"
_IS_TEST = "regexp_matches({0}, '(?m)^\\s*func\\s+(?:Test|Benchmark|Example|Fuzz)\\w*\\s*\\(|\"testing\"')"


def _runner(cmd: list[str], folder: str, env: dict, timeout: float) -> tuple[int, str]:
    """A stand-in for a toolchain: build fails on ``goto``, vet on ``err``, test on test files."""
    from pathlib import Path

    files = {p.name: p.read_text(encoding="utf-8") for p in Path(folder).iterdir()}
    text = "\n".join(files.values())
    bad = {"build": "[i]" in text, "vet": "err" in text, "test": any(n.endswith("_test.go") for n in files)}
    return (1, " no ") if bad.get(cmd[1], False) else (0, "")


@query(
    "WITH " + _BLOCKS + ",\nc AS (SELECT role, x, array_to_string(x, chr(10)) AS code, len(list_filter(x, lambda y: " + _IS_TEST.format("y") + ")) > 0 AS test FROM b),\n"
    "v AS (SELECT CASE WHEN x IS NULL OR len(x) = 0 THEN 'extract' WHEN contains(code, '[i]') THEN 'build' WHEN contains(code, 'err') THEN 'vet' WHEN role = 'go_tester' AND test THEN 'test' ELSE 'ok' END AS stage FROM c)\n"
    "SELECT stage, CASE stage WHEN 'extract' THEN 'no_code' WHEN 'ok' THEN 'ok' ELSE 'failed' END AS status, stage = 'ok' AS passed, count(*) AS rows FROM v GROUP BY stage"
)
def verify_policy(spark, d):
    pairs = V.verify(_t(spark, d, "pairs"), runner=_runner, strict=True)
    return pairs.groupBy("verified.stage", "verified.status", "verified.passed").agg(F.count("*").alias("rows"))


@query("WITH " + _BLOCKS + "\nSELECT CASE WHEN x IS NULL OR len(x) = 0 THEN 'extract' ELSE 'toolchain' END AS stage, CASE WHEN x IS NULL OR len(x) = 0 THEN 'no_code' ELSE 'unavailable' END AS status, true AS passed, count(*) AS rows FROM b GROUP BY ALL")
def verify_without_toolchain(spark, d):
    pairs = V.verify(_t(spark, d, "pairs"), available=False)
    return pairs.groupBy("verified.stage", "verified.status", "verified.passed").agg(F.count("*").alias("rows"))


@query("WITH " + _BLOCKS + ",\nn AS (SELECT unnest(list_transform(x, lambda y, i: 'code' || (i - 1) || CASE WHEN " + _IS_TEST.format("y") + " THEN '_test.go' ELSE '.go' END)) AS name FROM b)\nSELECT name, count(*) AS rows FROM n GROUP BY name")
def code_file_names(spark, d):
    return _t(spark, d, "pairs").select(F.explode(V.file_names(V.code_blocks(F.col("response")))).alias("name")).groupBy("name").agg(F.count("*").alias("rows"))


_SCORED = "s AS (SELECT ord, CASE WHEN " + _filled("instruction") + " AND " + _filled("response") + " THEN sha256(" + _strip("instruction") + " || chr(0) || " + _strip("response") + ") END AS h FROM pairs),\nj AS (SELECT ord, CASE WHEN h IS NULL THEN 0.0::DOUBLE ELSE round((('0x' || h[1:4])::INT / 65535.0::DOUBLE + ('0x' || h[5:8])::INT / 65535.0::DOUBLE + ('0x' || h[9:12])::INT / 65535.0::DOUBLE + ('0x' || h[13:16])::INT / 65535.0::DOUBLE) / 4, 6) END AS score FROM s)"


@query("WITH " + _BLOCKS + ",\n" + _SCORED + ",\ng AS (SELECT CASE WHEN x IS NULL OR len(x) = 0 THEN 'verified' WHEN contains(array_to_string(x, chr(10)), '[i]') OR contains(array_to_string(x, chr(10)), 'err') OR role = 'go_tester' AND len(list_filter(x, lambda y: " + _IS_TEST.format("y") + ")) > 0 THEN 'verified' WHEN j.score < 0.45 THEN 'judged' END AS gate FROM b JOIN j ON j.ord = b.ord)\nSELECT count(*) AS input, count(*) FILTER (gate = 'verified') AS verified_dropped, count(*) FILTER (gate = 'judged') AS judged_dropped, count(*) FILTER (gate IS NULL) AS kept FROM g")
def refine_stats(spark, d):
    return pipeline.refine_stats(pipeline.gated(_t(spark, d, "pairs"), {"strict_verify": True, "runner": _runner, "judge_threshold": 0.45}))


_CLAMPED = lambda a: f"CASE WHEN isnan(coalesce(axes['{a}'], 0)) THEN 0 ELSE greatest(0, least(1, coalesce(axes['{a}'], 0))) END"


@query("SELECT ord, CASE ord % 5 WHEN 3 THEN 0.0::DOUBLE WHEN 4 THEN 0.0::DOUBLE ELSE round((" + " + ".join(_CLAMPED(a) for a in J.AXES) + ") / 4, 6) END AS score, CASE WHEN ord % 5 = 3 THEN 'unreadable reply' WHEN ord % 5 = 4 THEN 'empty reply' ELSE coalesce(" + _strip("rationale") + ", '') END AS why FROM judge_results")
def judge_parse(spark, d):
    """Fenced, framed by prose, with numbers as text, broken, and blank replies."""
    v = _t(spark, d, "judge_results")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    axes = F.map_filter(F.coalesce("axes", none), lambda k, x: x.isNotNull())
    fields = [F.try_element_at(axes, F.lit(a)) for a in J.AXES]
    plain = F.to_json(F.struct(*[x.alias(a) for x, a in zip(fields, J.AXES)], F.col("rationale")))
    quoted = F.to_json(F.struct(*[F.concat(F.lit(" "), x.cast("string")).alias(a) for x, a in zip(fields, J.AXES)], F.col("rationale")))
    raw = (
        F.when(F.expr("ord % 5 = 0"), F.concat(F.lit("Verdict:\n```json\n"), plain, F.lit("\n```\nDone.")))
        .when(F.expr("ord % 5 = 1"), F.concat(F.lit("I think: "), plain, F.lit(" is right.")))
        .when(F.expr("ord % 5 = 2"), quoted)
        .when(F.expr("ord % 5 = 3"), F.concat(F.lit("["), F.substring(plain, 2, 10)))
        .otherwise(F.lit(" \n"))
    )
    return v.select("ord", J.parsed_reply(raw).alias("v")).select("ord", "v.score", F.col("v.rationale").alias("why"))


@query("SELECT ord, CAST(0 AS INTEGER) AS pos, md5(" + _stripped("instruction") + ") AS instruction, md5(" + _stripped("response") + ") AS response FROM pairs WHERE ord % 4 <> 3 AND " + _filled("instruction") + " AND " + _filled("response"))
def pairs_parse(spark, d):
    """Replies as an object, as a list, in a fence, and cut off."""
    p = _t(spark, d, "pairs")
    items = F.to_json(F.array(F.struct("instruction", "response"), F.struct(F.lit("x").alias("instruction"), F.lit("  ").alias("response"))), {"ignoreNullFields": "true"})
    items = F.regexp_replace(items, "```", r"\\u0060\\u0060\\u0060")
    raw = F.when(F.expr("ord % 4 = 0"), F.concat(F.lit('{"pairs": '), items, F.lit("}"))).when(F.expr("ord % 4 = 1"), F.concat(F.lit("Here: "), items)).when(F.expr("ord % 4 = 2"), F.concat(F.lit("```json\n"), items, F.lit("\n```"))).otherwise(F.substring(items, 1, 12))
    got = p.select("ord", F.posexplode(G.parsed_pairs(raw)).alias("pos", "x"))
    return got.select("ord", "pos", F.md5("x.instruction").alias("instruction"), F.md5("x.response").alias("response"))


# --- sources and sinks ---------------------------------------------------------------------------------------


@query("SELECT ord, CAST(row_number() OVER (ORDER BY extra.stars DESC NULLS LAST, id, ord) AS BIGINT) AS place FROM source_records WHERE source = 'github' ORDER BY extra.stars DESC NULLS LAST, id, ord LIMIT 100")
def server_sort(spark, d):
    """The first hundred by stars. The limit is the operator."""
    from tamis.sources.records import rank_repositories

    rows = _t(spark, d, "source_records").where("source = 'github'").select("ord", F.concat("id", F.lit("\0"), F.lpad(F.col("ord").cast("string"), 12, "0")).alias("full_name"), F.col("extra.stars").alias("stargazers_count"))
    top = rank_repositories(rows, 100)
    return positions(top, [F.desc_nulls_last("stargazers_count"), F.col("full_name")], "at").select("ord", (F.col("at") + 1).alias("place"))


_COLLAPSE = lambda c: _strip(f"regexp_replace({c}, '[\\t\\n\\x0B\\f\\r\\x1c-\\x1f\\x{{85}}\\p{{Z}}]+', ' ', 'g')")


@query("SELECT ord, 'arxiv' AS source, string_split(u, '/')[-1] AS id, u AS url, " + _COLLAPSE("coalesce(title, '')") + " AS title, 'arXiv-nonexclusive' AS license, coalesce(p, u) AS fetch_url, array_to_string(list_transform(coalesce(a, []), lambda x: coalesce(" + _strip("x") + ", '')), '|') AS authors, array_to_string(list_filter(coalesce(c, []), lambda x: x <> ''), '|') AS categories FROM (SELECT ord, " + _stripped("url") + " AS u, title, extra.pdf_url AS p, extra.authors AS a, extra.categories AS c FROM source_records WHERE source = 'arxiv')")
def paper_feed_records(spark, d):
    """Entries of a feed, with a page link before the PDF link, as records."""
    from tamis.sources import atom_records

    r = _t(spark, d, "source_records").where("source = 'arxiv'")
    link = lambda title, href, kind: F.struct(F.lit(title).alias("_title"), href.alias("_href"), F.lit("related").alias("_rel"), F.lit(kind).alias("_type"))
    links = F.array_compact(F.array(link(None, F.col("url"), "text/html"), F.when(F.col("extra.pdf_url").isNotNull(), link("pdf", F.col("extra.pdf_url"), None))))
    entry = r.select(
        "ord", F.concat(F.lit("\n "), F.coalesce("url", F.lit("")), F.lit(" ")).alias("id"), F.lit(None).cast("string").alias("updated"), F.col("extra.published").alias("published"), "title", F.col("extra.summary").alias("summary"),
        F.transform("extra.authors", lambda a: F.struct(a.alias("name"))).alias("author"), F.transform("extra.categories", lambda c: F.struct(c.alias("_term"))).alias("category"), links.alias("link"), F.struct(F.col("extra.primary_category").alias("_term")).alias("primary_category"),
    )
    made = atom_records(entry, keep=["ord"])
    return made.select("ord", "source", "id", "url", "title", "license", "fetch_url", F.array_join("extra.authors", "|").alias("authors"), F.array_join("extra.categories", "|").alias("categories"))


@query("SELECT 'huggingface' AS source, 'o/set' AS id, 'o/set' AS url, 'o/set' AS title, CAST(NULL AS VARCHAR) AS license, 'test' AS split")
def dataset_descriptor(spark, d):
    from tamis.sources import describe

    return describe(spark, "o/set", "test").select("source", "id", "url", "title", "license", F.col("extra.split").alias("split"))


@query("SELECT ord, id FROM source_records WHERE contains(title, 'cache') ORDER BY ord LIMIT 20")
def discover_registered(spark, d):
    """A source of one's own, found by its name. The limit is the operator."""
    from tamis.sources import Source, discover, register_source

    class Stored(Source):
        def search(self, query, max_results=100, **kw):
            found = _t(self.spark, str(self.options["folder"]), "source_records").where(F.contains("title", F.lit(query)))
            return found.orderBy("ord").limit(max_results)

    register_source("stored", Stored)
    return discover(spark, "stored", "cache", 20, folder=d).select("ord", "id")


@query("SELECT ord FROM (SELECT ord, " + _strip("instruction") + " AS i, " + _strip("response") + " AS r, concat_ws(chr(10), " + _strip("instruction") + ", " + _strip("response") + ", coalesce(" + _strip("context") + ", '')) AS t FROM pairs) WHERE i <> '' AND r <> '' AND (regexp_matches(t, '(?i)```go(?:[^\\p{L}\\p{N}_]|\\z)') OR contains(t, 'package ') OR contains(t, 'func ') OR contains(t, ':= ') OR contains(t, 'import (')) ORDER BY ord LIMIT 1")
def import_cap_of_none(spark, d):
    """A cap of no matches still gives the first one."""
    return P.import_scan(_t(spark, d, "pairs"), "ord", "go", max_results=0).select("ord")


_STORED = "SELECT ord, md5(instruction) AS instruction, md5(response) AS response, md5(context) AS context, source_id FROM pairs"


@query(_STORED)
def stage_round_trip(spark, d):
    """A stage written as JSON lines and read with its schema."""
    from tamis.sources.stages import read_stage, write_stage

    p = _t(spark, d, "pairs").select("ord", "instruction", "response", "context", "source_id")
    path = scratch(spark)
    write_stage(p, path)
    return read_stage(spark, path, "ord bigint, instruction string, response string, context string, source_id string").select("ord", *[F.md5(c).alias(c) for c in ("instruction", "response", "context")], "source_id")


_RECORDS = "SELECT md5(" + _strip("instruction") + ") AS instruction, md5(" + _strip("response") + ") AS response, md5(" + _stripped("context") + ") AS context, md5(" + _stripped("response") + ") AS last FROM pairs WHERE " + _filled("instruction") + " AND " + _filled("response")


def _record_digests(df):
    return df.select(*[F.md5(c).alias(c) for c in ("instruction", "response", "context")], F.md5(T.strip(F.col("messages")[2]["content"])).alias("last"))


@query(_RECORDS)
def jsonl_round_trip(spark, d):
    """Records in part files, read back."""
    path = scratch(spark, ".jsonl")
    B.write_jsonl(B.records(_t(spark, d, "pairs"), on_error="drop"), path, single=False)
    return _record_digests(B.read_jsonl(spark, path))


@query(_RECORDS)
def jsonl_single_file(spark, d):
    """All records, unsplit, in one file."""
    path = scratch(spark, ".jsonl")
    filled = _t(spark, d, "pairs").where(~T.is_blank(F.col("instruction")) & ~T.is_blank(F.col("response")))
    return _record_digests(B.read_jsonl(spark, B.export_jsonl(filled, path)))


@query(_RECORDS)
def parquet_round_trip(spark, d):
    path = scratch(spark, ".parquet")
    B.write_parquet(B.records(_t(spark, d, "pairs"), on_error="drop"), path, single=False)
    back = spark.read.parquet(path)
    return _record_digests(back.withColumn("messages", F.from_json("messages", "array<struct<role:string,content:string>>")))


_N = "(SELECT count(*) AS n, CAST(floor(count(*) * 0.1::DOUBLE) AS BIGINT) AS v FROM pairs WHERE " + _filled("instruction") + " AND " + _filled("response") + ")"


@query("SELECT s.split, f.format, CASE s.split WHEN 'train' THEN n - v ELSE v END AS records, n AS total, 64 AS digest FROM " + _N + ", (VALUES ('train'), ('validation')) s(split), (VALUES ('jsonl'), ('parquet')) f(format) WHERE s.split = 'train' OR v > 0")
def manifest_entries(spark, d):
    """A set built in both formats: what the manifest says of its files."""
    m = B.build(_t(spark, d, "pairs"), "set", scratch(spark), val_ratio=0.1, formats=("jsonl", "parquet"), on_error="drop")
    rows = [(f["split"], f["format"], f["records"], m["total_records"], len(f["sha256"])) for f in m["files"]]
    return spark.createDataFrame(rows, "split string, format string, records bigint, total bigint, digest int")


@query("SELECT 'train' AS split, n AS records, 'instruction,response,context,messages' AS fields, 7 AS stat FROM " + _N)
def manifest_without_validation(spark, d):
    """An empty validation split has no file; the counts of earlier stages are passed on."""
    m = B.build(_t(spark, d, "pairs"), "set", scratch(spark), val_ratio=0.0, stats={"seven": 7}, on_error="drop", single=False)
    n = sum(f["records"] for f in m["files"])
    return spark.createDataFrame([(s, n, ",".join(m["schema_fields"]), m["stats"]["seven"]) for s in {f["split"] for f in m["files"]}], "split string, records bigint, fields string, stat int")


@query("SELECT * FROM (VALUES (-0.1::DOUBLE, false), (0.0, true), (0.5, true), (1.0, false)) r(ratio, ok)")
def ratio_guard(spark, d):
    def ok(r: float) -> bool:
        try:
            B.check_ratio(r)
        except ValueError:
            return False
        return True

    return spark.createDataFrame([(r, ok(r)) for r in (-0.1, 0.0, 0.5, 1.0)], "ratio double, ok boolean")


@query("SELECT min(ord) AS ord FROM documents_raw WHERE content IS NOT NULL GROUP BY content")
def first_of_each(spark, d):
    return C.first_of_each(_t(spark, d, "documents_raw").where("content is not null").select("ord", "content"), ["content"], "ord").select("ord")
