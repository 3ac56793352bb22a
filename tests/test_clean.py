import random
import re

import pytest
from pyspark.sql import functions as F

from tamis.operators import clean as C
from tamis.operators import minhash as M

SCHEMA = "ord bigint, content string, license string"


def reasons(spark, rows, o=C.CleanOptions(min_length=5, near_threshold=2.0), extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.withColumns({"text": F.lit("x"), "first": F.lit(1), "k": F.lit(2)})
    return {r["ord"]: r["drop_reason"] for r in C.clean(df, "ord", o).collect()}


def test_reasons_first_wins(spark):
    body = "some words that make a body"
    rows = [(1, body, "GPL-3.0"), (2, body, "MIT"), (3, body, None), (4, "abc", "MIT"), (5, "".join(map(chr, range(31))) * 9, "MIT"), (6, None, "MIT"), (7, body + "!", "")]
    assert reasons(spark, rows, extra=True) == {1: "license", 2: None, 3: "exact_duplicate", 4: "length", 5: "encoding", 6: "encoding", 7: "license"}
    assert reasons(spark, rows, C.CleanOptions(min_length=5, near_threshold=2.0, allow_unknown_license=False))[3] == "license"


def test_empty_table_and_stats(spark):
    empty = C.clean(spark.createDataFrame([], SCHEMA), "ord")
    assert empty.count() == 0 and C.clean_stats(empty).first()["total_in"] == 0
    got = C.clean_stats(C.clean(spark.createDataFrame([(1, "write to me@host.example for more of this", None), (2, "x", None)], SCHEMA), "ord", C.CleanOptions(min_length=5))).first()
    assert (got.total_in, got.total_out, got.length, got.redactions) == (2, 1, 1, 1)


def test_thresholds_out_of_range(spark):
    rows = [(i, f"body number {i} with words", None) for i in range(4)]
    assert list(reasons(spark, rows, C.CleanOptions(min_length=5, near_threshold=0.0)).values()).count("near_duplicate") == 3


def sequential(texts, threshold):
    import hashlib

    a, b = M.coefficients()

    def sig(t):
        w = re.findall(r"\w+", (t or "").lower())
        grams = {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({" ".join(w)} if w else set())
        hs = [int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "big") for g in grams]
        return [min((x * h + y) % M.PRIME for h in hs) for x, y in zip(a, b)] if hs else [0] * 64

    kept, gone = [], set()
    for o, t in texts:
        s = sig(t)
        if any(sum(x == y for x, y in zip(s, k)) / 64 >= threshold for k in kept):
            gone.add(o)
        else:
            kept.append(s)
    return gone


@pytest.mark.parametrize("threshold", [0.85, 0.6])
def test_greedy_equals_scan_in_order(spark, threshold):
    rnd = random.Random(5)
    base = [[rnd.choice("abcdefghij") * 3 + str(rnd.randrange(40)) for _ in range(60)] for _ in range(6)]
    texts = []
    for i in range(70):
        w = list(rnd.choice(base))
        for _ in range(rnd.randrange(6)):
            w[rnd.randrange(len(w))] = str(rnd.random())
        texts.append((i, " ".join(w)))
    texts += [(100, None), (101, ""), (102, "..."), (103, texts[0][1])]
    rnd.shuffle(texts)
    df = spark.createDataFrame(texts, "ord bigint, text string").repartition(3)
    got = {r["ord"] for r in M.greedy_near_duplicates(df, threshold).collect()}
    assert got == sequential(sorted(texts), threshold)


def test_bands_lose_nothing():
    for t in (0.5, 0.8, 0.85, 1.0):
        k = M.least_equal(t)
        assert k / 64 >= t > (k - 1) / 64
    assert M.coefficients()[0][:2] == [1103527590, 377401575] and M.coefficients()[1][:2] == [1223573862, 541269159]


def test_paths(spark):
    rows = [("a\\b.go",), ("vendor/x.go",), ("a_test.go",), ("b.py",), (None,)]
    got = spark.createDataFrame(rows, "p string").where(C.wanted_path(F.col("p"))).collect()
    assert [r.p for r in got] == ["a\\b.go"]
