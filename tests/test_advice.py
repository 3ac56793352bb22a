"""Cases of findings outside tamis.llm: one split at every size, any number of repositories, hot keys."""

from pyspark.sql import functions as F

from tamis.operators import build as B
from tamis.operators import clean as C
from tamis.plans import runtime
from tamis.sources import fetch


def test_one_split_at_every_size(spark):
    small = spark.range(10).withColumnRenamed("id", "ord")
    large = spark.range(2000).withColumnRenamed("id", "ord")
    for n, df in ((10, small), (2000, large)):
        got = B.split(df, "ord", 0.2, 7)
        assert got.where("split = 'validation'").count() == n // 5
        want = df.orderBy(F.sha2(F.concat(F.lit("7:"), F.col("ord").cast("string")), 256), "ord").collect()
        assert [r.ord for r in got.orderBy(F.col("split").desc(), "pos").collect()] == [r.ord for r in want]
    assert B.split(small.limit(0), "ord").count() == 0


def test_repositories_are_read_in_one_scan(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"o_r{i}" / "pkg").mkdir(parents=True)
        (tmp_path / f"o_r{i}" / "pkg" / "main.go").write_text(f"package r{i}\r\n")
        (tmp_path / f"o_r{i}" / "main_test.go").write_text("package x\n")
    repos = spark.createDataFrame([(f"o/r{i}", f"{tmp_path}/o_r{i}/", "MIT" if i else None, i) for i in range(4)], "id string, local_path string, license string, ord bigint")
    got = fetch.walk_all(spark, str(tmp_path), repos).orderBy("id").collect()
    assert [(r.id, r.repo, r.content, r.license, r.repo_ord) for r in got] == [(f"o_r{i}:pkg/main.go", f"o_r{i}", f"package r{i}\n", "MIT" if i else None, i) for i in range(4)]
    assert fetch.walk_all(spark, str(tmp_path), repos.limit(0)).count() == 0 and fetch.walk_all(spark, str(tmp_path / "none"), repos).count() == 0


def test_places_of_a_hot_key(spark):
    df = spark.range(5000).select(F.col("id").alias("ord"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"))
    got = {r.ord: r.place for r in runtime.places(df, "key", ["ord"]).collect()}
    seen: dict = {}
    for r in df.orderBy("ord").collect():
        assert got[r.ord] == seen.get(r.key, 0)
        seen[r.key] = seen.get(r.key, 0) + 1


def test_first_of_each(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 3), (3, "b", 1), (4, None, 2), (5, None, 1)], "x int, k string, o int")
    assert sorted(tuple(r) for r in C.first_of_each(df, ["k"], "o").collect() if r.k) == [(2, "a", 3), (3, "b", 1)]
    assert C.first_of_each(df, ["k"], "o").count() == 3


def test_spread_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    before = len(tracker.getJobIdsForGroup(None))
    assert runtime.spread(df) is df and len(tracker.getJobIdsForGroup(None)) == before
