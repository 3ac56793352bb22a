"""Generation under caps and a gate, with clients of the tests' own."""

import json
from decimal import Decimal

import pytest

from tamis.operators import teach as X
from tamis.plans import pipeline

DOLLAR = {"price_in": Decimal(1), "price_out": Decimal(0)}


def one_dollar(asked):
    return json.dumps({"pairs": [{"instruction": "do it", "response": "done " + str(len(asked[1]["content"]))}]}), 1_000_000, 0


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"package a{i}\nfunc f() {{}}\n" + "x" * i) for i in range(10)] + [(10, " "), (11, None)]
    return spark.createDataFrame(rows, "ord bigint, content string").repartition(3)


@pytest.mark.parametrize("wave", [1, 4, 100])
def test_spending_cap(docs, wave):
    got = X.teach(docs, X.Plan(["go_reviewer"], max_spend=2.5, wave=wave, **DOLLAR), one_dollar)
    assert [r.ord for r in got.pairs.orderBy("unit").collect()] == [0, 1, 2] and got.spend == 3 and got.stats["kept"] == 3


@pytest.mark.parametrize("wave", [1, 100])
def test_the_judge_counts_too(docs, wave):
    judge = lambda asked: ('{"correctness": 1, "idiomatic": 1, "completeness": 1, "alignment": 0}', 500_000, 0)
    half = lambda asked: (one_dollar(asked)[0], 500_000, 0)
    got = X.teach(docs, X.Plan(["go_reviewer"], max_spend=2.5, wave=wave, judge=judge, threshold=0.6, **DOLLAR), half)
    assert got.pairs.count() == 3 and got.spend == 3 and got.pairs.first().judge_score == 0.75


def test_pair_cap(docs):
    got = X.teach(docs, X.Plan(["go_reviewer", "go_tester"], max_pairs=3, wave=2), one_dollar)
    assert [(r.ord, r.role) for r in got.pairs.orderBy("unit").collect()] == [(0, "go_reviewer"), (0, "go_tester"), (1, "go_reviewer")]
    assert got.calls.count() == 3 and X.teach(docs, X.Plan(["go_reviewer"], max_pairs=0), one_dollar).pairs.count() == 0
    assert X.teach(docs, X.Plan(["go_reviewer"], pairs_per_doc=0), one_dollar).pairs.count() == 0


def test_best_of_the_samples(docs):
    score = {"a": 0.2, "b": 0.9, "c": 0.5}

    def teacher(asked):
        teacher.n = getattr(teacher, "n", -1) + 1
        return json.dumps({"pairs": [{"instruction": "i", "response": "abc"[teacher.n % 3]}]}), None, None

    def judge(asked):
        s = score[asked[1]["content"].split("----- response -----\n")[1][0]]
        return json.dumps({"correctness": s, "idiomatic": s, "completeness": s, "alignment": s}), None, None

    one = docs.where("ord = 0").coalesce(1)
    got = X.teach(one, X.Plan(["go_reviewer"], samples=3, judge=judge), teacher)
    assert [(r.response, r.judge_score) for r in got.pairs.collect()] == [("b", 0.9)] and got.stats == {"generated": 3, "verified_dropped": 0, "judged_dropped": 0, "kept": 1}
    low = X.teach(one, X.Plan(["go_reviewer"], samples=3, judge=judge, threshold=0.95), teacher)
    assert low.pairs.count() == 0 and low.stats["judged_dropped"] == 3


def test_what_fails_its_check_is_never_judged(docs):
    def judge(asked):
        raise AssertionError("judged")

    got = X.teach(docs, X.Plan(["go_reviewer"], judge=judge, verify={"available": False, "strict": True}, tries=1, **DOLLAR), one_dollar)
    assert got.pairs.count() == 0 and got.stats == {"generated": 10, "verified_dropped": 10, "judged_dropped": 0, "kept": 0} and got.spend == 10


def test_failing_and_odd_replies(docs):
    slept = []
    assert X.insist(lambda a: 1 / 0, [], 4, 1.0, slept.append) == (None, None, None, 4) and slept == [1.0, 2.0, 4.0]
    said = iter([OSError("no"), ("{}", 1, 2)])

    def flaky(asked):
        x = next(said)
        if isinstance(x, Exception):
            raise x
        return x

    assert X.insist(flaky, [], 4, 1.0, slept.append) == ("{}", 1, 2, 2)
    got = X.teach(docs, X.Plan(["go_reviewer"], pairs_per_doc=2, tries=1), lambda a: (json.dumps([{"instruction": "a", "response": "b"}, {"instruction": "c", "response": " "}, {"instruction": "d", "response": "e"}, {"instruction": "f", "response": "g"}]), None, None))
    assert sorted({(r.slot, r.instruction) for r in got.pairs.collect()}) == [(0, "a"), (1, "d")] and got.pairs.count() == 20 and got.spend == 0
    assert X.teach(docs, X.Plan(["go_reviewer"], tries=1), lambda a: 1 / 0).pairs.count() == 0


def test_settings_fall_back():
    env = {"TAMIS_TEACHER_MODEL": "t", "TAMIS_JUDGE_API_KEY": "k", "TAMIS_JUDGE_MODEL": " "}
    judge, teacher = X.ChatClient.of(["JUDGE", "TEACHER"], env, temperature=0.0), X.ChatClient.of(["TEACHER"], env)
    assert (judge.model, judge.key, teacher.model, teacher.key) == ("t", "k", "t", None) and judge.body([])["temperature"] == 0.0
    assert judge.body([])["response_format"] == {"type": "json_object"}


def test_prompts(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("do", "x" * 9000, None)], "i string, r string, c string")
    turns = df.select(X.judge_prompt(F.col("i"), F.col("r"), F.col("c")).alias("m")).first().m
    assert [t.role for t in turns] == ["system", "user"] and "[truncated]" in turns[1].content and '"idiomatic": 0.0' in turns[1].content


def test_refine_counts(spark):
    rows = [(1, "a", "no code", ""), (2, "b", "```go\nfunc x() {}\n```", ""), (3, "c", "```go\nfunc y() {}\n```", "")]
    pairs = spark.createDataFrame(rows, "ord bigint, instruction string, response string, context string")
    runner = lambda cmd, cwd, env, timeout: (0, "")
    marked = pipeline.gated(pairs, {"strict_verify": True, "runner": runner, "judge_threshold": 0.0})
    assert pipeline.refine_stats(marked).first().asDict() == {"input": 3, "verified_dropped": 1, "judged_dropped": 0, "kept": 2}
    high = pipeline.gated(pairs, {"verify": False, "judge_threshold": 1.1})
    assert pipeline.refine_stats(high).first().asDict() == {"input": 3, "verified_dropped": 0, "judged_dropped": 3, "kept": 0}
    asked = pipeline.gated(pairs, {"verify": False, "client": lambda m: ('{"correctness": 1, "idiomatic": 1, "completeness": 1, "alignment": 1}', 1, 1)})
    assert pipeline.refine_stats(asked).first().kept == 3 and pipeline.refined(pairs, None) is pairs


def test_presets_and_plugins():
    assert pipeline.configured({"preset": "review", "max_pairs": 5}).max_pairs == 5 and pipeline.configured({"preset": "curate"}).clean.min_length == 40
    with pytest.raises(ValueError, match="unknown preset"):
        pipeline.configured({"preset": "none"})
    pipeline.load_plugins(["tamis.sources.registry"])


def test_generate_route(spark, tmp_path):
    """From a folder that stands for cloned repositories to a manifest, in order of repository and file."""
    base = tmp_path / "out"
    for i in range(3):
        d = base / "raw" / f"o_r{i}"
        d.mkdir(parents=True)
        for j in range(2):
            (d / f"f{j}.go").write_text(f"package r{i}\n\n// file {j} of repository {i} is long enough to be kept\nfunc F{i}{j}() int {{ return {i}{j} }}\n")
    payload = tmp_path / "found.json"
    payload.write_text("\n".join(json.dumps({"full_name": f"o/r{i}", "html_url": "u", "clone_url": "c", "license": {"spdx_id": "MIT"}, "stargazers_count": 9 - i}) for i in range(3)))
    cfg = pipeline.configured({"source": "github", "source_options": {"path": str(payload)}, "out": str(base), "roles": ["go_reviewer"], "max_pairs": 5, "val_ratio": 0.2, "generate": {"max_spend": 100.0}})
    got = pipeline.run(spark, cfg, teacher=one_dollar)
    assert got["total_records"] == 5 and got["splits"] == {"train": 4, "validation": 1} and got["stats"]["total_out"] == 6 and got["stats"]["spend_micro_usd"] == 700_000
    off = pipeline.run(spark, pipeline.configured({"source": "github", "source_options": {"path": str(payload)}, "out": str(base), "name": "off", "refine": {"available": False, "judge_threshold": 0.0}}))
    assert off["total_records"] == 6 and off["stats"]["refine_kept"] == 6
