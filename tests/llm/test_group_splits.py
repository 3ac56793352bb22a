"""Splits with several large groups."""

from tamis.llm import groups as G


def test_two_large_groups_go_to_two_splits(spark):
    rows = [(k, "a" if k < 400 else "b" if k < 600 else f"g{k // 2}") for k in range(1000)]
    df = spark.createDataFrame(rows, "ord bigint, group_id string")
    targets = spark.createDataFrame([("train", 0.6), ("test", 0.3), ("validation", 0.1)], "split string, share double")
    got = G.grouped_splits(df, targets)
    by = {r.split: r.n for r in got.groupBy("split").count().withColumnRenamed("count", "n").collect()}
    assert got.count() == 1000 and got.groupBy("group_id").agg({"split": "approx_count_distinct"}).where("`approx_count_distinct(split)` > 1").count() == 0
    assert abs(by["train"] - 600) < 60 and abs(by["test"] - 300) < 60 and abs(by["validation"] - 100) < 60


def test_a_giant_group_and_null_ids(spark):
    rows = [(k, "github", f"o/r{k}" if k % 3 else None, None, {"authors": ["Ann Lee"]} if k < 500 else {"authors": None}) for k in range(700)]
    df = spark.createDataFrame(rows, "ord bigint, source string, id string, fetch_url string, extra struct<authors: array<string>>")
    got = {r.ord: r.group_id for r in G.related(df).collect()}
    assert len(got) == 700 and len({got[k] for k in range(500)}) == 1 and got[0] == "o/r1" and got[501] is None
