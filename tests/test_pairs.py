import pytest
from pyspark.sql import functions as F

from tamis.operators import build as B
from tamis.operators import clean as C
from tamis.operators import generate as G
from tamis.operators import judge as J
from tamis.operators import pairs as P
from tamis.operators import verify as V


def test_normalize_shapes(spark):
    schema = "ord int, instruction string, problem string, prompt string, response string, solution string, input string, messages array<struct<role:string,content:string>>"
    chat = [("system", "be kind"), ("user", "old"), ("user", " ask "), ("assistant", "say"), ("system", " "), ("user", "")]
    rows = [
        (1, "do", None, None, "done", None, "ctx", None),
        (2, " ", "p", None, None, "s", None, None),
        (3, None, None, None, "r", None, None, None),
        (4, "x", None, None, "y", None, None, chat),
        (5, "x", None, None, "y", None, None, [("user", "only")]),
        (6, "x", None, None, "y", None, None, []),
    ]
    got = {r.ord: (r.instruction, r.response, r.context) for r in P.normalize(spark.createDataFrame(rows, schema), ["ord"]).collect()}
    assert got == {1: ("do", "done", "ctx"), 2: ("p", "s", ""), 4: ("ask", "say", "be kind"), 6: ("x", "y", "")}


def test_language_and_caps(spark):
    rows = [(1, "go", None, "a", "b"), (2, None, "Golang", "a", "b"), (3, "python", None, "a", "b"), (4, None, None, "a", "package main"), (5, None, None, "a", "b"), (6, "  ", "go", "a", "b")]
    df = spark.createDataFrame(rows, "ord int, lang string, language string, instruction string, output string")
    ids = lambda **k: [r.ord for r in P.import_scan(df, "ord", **k).collect()]
    assert ids() == [1, 2, 4] and ids(language="python") == [3] and ids(max_results=0) == [1] and ids(max_scan=0) == [1]


def test_import_clean(spark):
    long = "explain this function in simple words please"
    rows = [(1, long, "an answer by me@host.example", ""), (2, long, "an answer by me@host.example", ""), (3, " ", "x", ""), (4, "hi", "yo", None)]
    done = P.import_clean(spark.createDataFrame(rows, "ord bigint, instruction string, response string, context string"))
    got = {r.ord: (r.drop_reason, r.redactions) for r in done.collect()}
    assert got == {1: (None, 1), 2: ("exact_duplicate", 1), 4: ("length", 0)}


def test_judge(spark):
    said = ['{"correctness": 1, "idiomatic": "0.5", "completeness": 0.5, "alignment": 1}', 'so\n```json\n{"correctness": 2.0, "idiomatic": -1, "completeness": true, "alignment": "x"}\n```', None, "", "junk", "[1]", '{"correctness": "nan"}']
    raw = spark.createDataFrame([(i, x) for i, x in enumerate(said)], "k int, r string")
    got = [r.v for r in raw.select("k", J.parsed_reply(F.col("r")).alias("v")).orderBy("k").collect()]
    assert got[0].score == 0.75 and got[1].axes == {"correctness": 1.0, "idiomatic": 0.0, "completeness": 1.0, "alignment": 0.0}
    assert [v.score for v in got[2:]] == [0.0] * 5 and [v.rationale for v in got[2:]] == ["empty reply", "empty reply", "unreadable reply", "unreadable reply", ""]
    df = spark.createDataFrame([(1, "a", "b"), (2, " ", "b"), (3, None, "b"), (4, " a ", "b")], "ord int, instruction string, response string")
    s = {r.ord: r.judge_score for r in J.judge_offline(df).collect()}
    import hashlib

    h = hashlib.sha256(b"a\0b").hexdigest()
    assert s[1] == s[4] == round(sum(int(h[4 * i : 4 * i + 4], 16) / 0xFFFF for i in range(4)) / 4, 6) and s[2] == s[3] == 0.0
    ranked = J.judge_rank(spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.5), (4, 0.1)], "ord int, judge_score double"), 0.5)
    assert [r.ord for r in ranked.collect()] == [2, 1, 3]
    assert spark.createDataFrame([("{}",)], "r string").select(J.parsed_reply(F.col("r")).alias("v")).first().v.score == 0.0


def test_code_blocks_and_verify(spark):
    rows = [
        (1, "```py\nx\n```\n```go\n\nfunc A() {}\n```\n```Go v\nB\n```", "go_tester"),
        (2, "```\nplain\n```", ""),
        (3, "package main\nfunc main() {}\n", ""),
        (4, "nothing", ""),
        (5, None, None),
        (6, "```go\nfunc TestX(t *testing.T) {}\n```", "go_tester"),
    ]
    df = spark.createDataFrame(rows, "ord int, response string, role string")
    b = {r.ord: r.b for r in df.select("ord", V.code_blocks(F.col("response")).alias("b")).collect()}
    assert b == {1: ["func A() {}", "B"], 2: ["plain"], 3: ["package main\nfunc main() {}"], 4: [], 5: [], 6: ["func TestX(t *testing.T) {}"]}
    names = df.where("ord in (1, 6)").select(V.file_names(V.code_blocks(F.col("response"))).alias("n")).collect()
    assert [r.n for r in names] == [["code0.go", "code1.go"], ["code0_test.go"]]
    for strict in (True, False):
        got = {r.ord: (r.verified.status, r.verified.passed) for r in V.verify(df, available=False, strict=strict).collect()}
        assert got[4] == ("no_code", not strict) and got[1] == ("unavailable", not strict)

    def runner(cmd, cwd, env, timeout):
        return (1, " bad ") if cmd[1] == "test" else (0, "")

    got = {r.ord: (r.verified.stage, r.verified.status) for r in V.verify(df, runner=runner).collect()}
    assert got[1] == ("test", "failed") and got[2] == ("ok", "ok") and got[4] == ("extract", "no_code")


def test_generate(spark):
    with pytest.raises(ValueError, match="unknown role"):
        G.get_role("nobody")
    docs = spark.createDataFrame([(1, "package a\nfunc b() {}"), (2, " "), (3, None)], "ord bigint, content string")
    units = G.doc_roles(docs, G.role_table(spark, ["go_tester", "go_reviewer"]))
    assert [(r.ord, r.role) for r in units.orderBy("ord", "role_ord").collect()] == [(1, "go_tester"), (1, "go_reviewer")]
    made = G.offline_pairs(units, 3)
    assert made.count() == 6 and G.offline_pairs(units, 0).count() == 0
    assert made.exceptAll(G.offline_pairs(units.repartition(3), 3)).count() == 0
    said = ['x ```json\n{"pairs": [{"instruction": "a", "response": "b"}]}\n``` y', '[{"instruction": "a", "response": " "}, {"instruction": "c", "response": 1}] tail', "junk", None, '{"pairs": 3}']
    raw = spark.createDataFrame([(i, x) for i, x in enumerate(said)], "k int, r string")
    assert [[tuple(x) for x in r.p] for r in raw.select("k", G.parsed_pairs(F.col("r")).alias("p")).orderBy("k").collect()] == [[("a", "b")], [("c", "1")], [], [], []]
    cost = spark.createDataFrame([(i, 1.0) for i in range(10)], "ord int, cost double").repartition(4)
    assert sorted(r.ord for r in G.running_total_cap(cost, ["ord"], "cost", 2.5).collect()) == [0, 1, 2]
    assert G.running_total_cap(cost, ["ord"], "cost", 0.0).count() == 0 and G.capped_rows(cost, ["ord"], 0).count() == 0
    cand = spark.createDataFrame([(1, 0, 0.2), (1, 1, 0.9), (1, 2, 0.9), (2, 0, None), (2, 1, None)], "k int, sample int, score double")
    assert sorted((r.k, r["sample"]) for r in G.best_of(cand, ["k"], F.col("score")).collect()) == [(1, 1), (2, 0)]
    assert sorted((r.k, r["sample"]) for r in G.best_of(cand, ["k"], None).collect()) == [(1, 0), (2, 0)]


def test_build(spark, tmp_path):
    pairs = spark.createDataFrame([(i, f"do {i}", f"done {i} é", "ctx" if i % 2 else None) for i in range(10)], "ord bigint, instruction string, response string, context string")
    m = B.build(pairs, "set", str(tmp_path), val_ratio=0.2, seed=7, formats=("jsonl", "parquet"), stats={"a": 1})
    assert m["splits"] == {"train": 8, "validation": 2} and len(m["files"]) == 4 and m["stats"] == {"a": 1}
    assert all(len(f["sha256"]) == 64 and f["bytes"] > 0 for f in m["files"])
    back = B.read_jsonl(spark, f"{tmp_path}/set.train.jsonl").collect()
    assert len(back) == 8 and back[0].messages[0].role == "system" and back[0].messages[2].content == back[0].response
    again = B.build(pairs.repartition(5), "again", str(tmp_path), val_ratio=0.2, seed=7)
    assert [f["sha256"] for f in again["files"]] == [f["sha256"] for f in m["files"] if f["format"] == "jsonl"]
    import hashlib

    by = sorted(range(10), key=lambda i: hashlib.sha256(f"7:{i}".encode()).hexdigest())
    assert [int(r.instruction.split()[1]) for r in back] == by[2:]
    parts = B.build(pairs, "parts", str(tmp_path), val_ratio=0.2, seed=7, formats=("jsonl", "parquet"), single=False)
    assert sum(f["records"] for f in parts["files"]) == 20 and all(len(f["sha256"]) == 64 for f in parts["files"])
    assert B.build(pairs, "none", str(tmp_path), val_ratio=0.0)["splits"] == {"train": 10, "validation": 0}
    assert not (tmp_path / "none.validation.jsonl").exists()
    with pytest.raises(ValueError):
        B.build(pairs, "bad", str(tmp_path), val_ratio=1.0)
    bad = spark.createDataFrame([(1, " ", "x", "")], pairs.schema)
    with pytest.raises(Exception, match="record without"):
        B.records(bad).collect()
    assert B.records(bad, on_error="drop").count() == 0
    assert B.split(B.records(pairs, ["ord"]), "ord", 0.3, 1).where("split = 'validation'").count() == 3
    assert C.CleanOptions().near_threshold == 0.85
