import re
import unicodedata

from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.functions.ids import norm_id, norm_url, owner_of
from tamis.functions.redact import scrub


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["x"] for r in df.withColumn("x", f(F.col("v"))).orderBy("i").collect()]


def test_strip_and_collapse_follow_unicode(spark):
    vals = [" a b ", " x\x1c", "\x85y\r\n", "", None, "a\t\n b"]
    assert column(spark, vals, T.strip) == [v.strip() if v is not None else None for v in vals]
    assert column(spark, vals[:-2], T.collapse) == [" ".join(v.split()) for v in vals[:-2]]


def test_printable_ratio(spark):
    vals = ["".join(map(chr, range(31))) * 5, "plain text\n", "", None, "é​"]
    want = [sum(c.isprintable() or c in "\n\r\t" for c in v) / len(v) if v else 0.0 for v in vals]
    assert column(spark, vals, T.printable_ratio) == want


def test_words_and_shingles(spark):
    vals = ["One two, THREE four five six", "a b", "", "_x ä9", None]
    assert column(spark, vals[:4], T.word_list) == [re.findall(r"\w+", v.lower()) for v in vals[:4]]
    got = column(spark, vals, T.shingles)
    assert got[0] == ["one two three four five", "two three four five six"] and got[1] == ["a b"] and got[2] == []


def test_truncate(spark):
    text = "a" * 60 + "\n" + "b" * 60
    cut = column(spark, [text, "short", "c" * 200], lambda c: T.truncate_lines(c, 100))
    assert cut == ["a" * 60 + T.TRUNCATED, "short", "c" * 100 + T.TRUNCATED]
    assert column(spark, ["\n" + "d" * 200], lambda c: T.truncate_lines(c, 100)) == ["\n" + "d" * 99 + T.TRUNCATED]
    assert column(spark, ["  x ", None], T.clip) == ["x", ""]


def test_ids(spark):
    vals = [" A/B.git ", "https://host.example/a/b/", "host.example/x-labs/y_2.git/", "2301.00001v3", "https://papers.example/abs/2301.00001v2", "", None, "a/toolv2", "papers.example/2301.00001", "org.name/set"]
    assert column(spark, vals, norm_id) == ["a/b", "a/b", "x-labs/y_2", "2301.00001", "2301.00001", None, None, "a/toolv2", "2301.00001", "org.name/set"]
    assert column(spark, ["A/B", "2301.00001"], lambda c: owner_of(norm_id(c))) == ["a", None]
    assert column(spark, ["git@host.example:A/b.git", "https://u@host.example/A/b"], norm_url) == ["a/b", "a/b"]


def test_scrub_in_order(spark):
    key = "AKIA" + "A1B2" * 4
    text = f"mail me@x.example, {key}, sk-{'a1' * 12}, ghp_{'Z9' * 20}; token = {'0f' * 20} émail@x.example"
    row = scrub(spark.createDataFrame([(text,), (None,), ("",)], "c string"), "c").collect()
    assert row[0]["redactions"] == 4 and "0f0f" in row[0]["c"] and "me@x" not in row[0]["c"]
    assert [r["redactions"] for r in row[1:]] == [0, 0] and row[1]["c"] is None
    assert unicodedata.normalize("NFC", row[0]["c"]).count("REDACTED") == 4
