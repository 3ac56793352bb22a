import json

import pytest
from pyspark.sql import functions as F

from tamis.plans import pipeline
from tamis.sources import discover, fetch, get_source
from tamis.sources.records import atom_records, describe, read_atom
from tamis.streaming.dedup import clean_stream

FEED = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://papers.example/schemas">
<entry><id> http://papers.example/abs/2301.00001v1 </id><updated>2023-02-01</updated><published>2023-01-01</published><title>On
  two lines</title><summary> sum
mary </summary><author><name>A B</name></author><author><name>C</name></author><category term="cs.LG"/><category term=""/>
<link href="http://papers.example/abs/2301.00001v1" rel="alternate"/><link title="pdf" href="http://papers.example/pdf/2301.00001v1"/></entry>
<entry><id>http://papers.example/abs/2</id><title>T</title><author><name>D</name></author><category term="x"/><link href="http://papers.example/abs/2"/></entry></feed>"""


def test_feed(spark, tmp_path):
    p = tmp_path / "feed.xml"
    p.write_text(FEED)
    got = {r.id: r for r in atom_records(read_atom(spark, str(p))).collect()}
    a = got["2301.00001v1"]
    assert a.title == "On two lines" and a.extra.authors == ["A B", "C"] and a.extra.categories == ["cs.LG"] and a.fetch_url.endswith("pdf/2301.00001v1")
    assert got["2"].fetch_url == "http://papers.example/abs/2" and got["2"].extra.pdf_url is None
    (tmp_path / "none.xml").write_text("<feed></feed>")
    assert atom_records(read_atom(spark, str(tmp_path / "none.xml"))).count() == 0


def test_registry_and_replay(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown source"):
        get_source("nowhere", spark)
    p = tmp_path / "repos.json"
    rows = [{"full_name": f"o/r{i}", "html_url": "u", "description": "" if i else "d", "license": {"spdx_id": "MIT"} if i else None, "clone_url": "c", "stargazers_count": i} for i in range(4)]
    p.write_text("\n".join(map(json.dumps, rows)))
    got = discover(spark, "github", "q", 2, path=str(p)).collect()
    assert [(r.id, r.title, r.license) for r in got] == [("o/r3", "o/r3", "MIT"), ("o/r2", "o/r2", "MIT")]
    assert describe(spark, "set").first().extra.split == "train"


def test_walk_fetch_and_schedule(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "main.go").write_bytes(b"package a\r\nfunc b() {}\r")
    (tmp_path / "a_test.go").write_text("package a")
    (tmp_path / "sub/bad.go").write_bytes(b"\xff\xfe\xfa")
    (tmp_path / "sub/blank.go").write_text(" \n")
    got = fetch.walk(spark, str(tmp_path), "o_r", license_="MIT").collect()
    assert [(r.id, r.content) for r in got] == [("o_r:main.go", "package a\nfunc b() {}\n")]
    assert fetch.walk(spark, str(tmp_path / "missing"), "x").count() == 0
    items = spark.createDataFrame([("a", "http://h.example/1", None), ("b", None, None), ("c", "", "http://h.example/2"), ("d", "http://i.example/9", None)], "id string, url string, fetch_url string")

    def get(url):
        if url.endswith("9"):
            raise OSError("down")
        return "text of " + url

    res = {r.id: (r.status, r.error, r.attempts) for r in fetch.fetch(items, get, retries=2, backoff=0.0).collect()}
    assert res == {"a": ("success", None, 1), "b": ("failed", "no url", 0), "c": ("success", None, 1), "d": ("failed", "down", 2)}
    pages = spark.createDataFrame([("http://h.example/1", "x"), ("http://h.example/1", "x")], "url string, content string")
    assert {r.id: r.status for r in fetch.fetch_replay(items, pages).collect()} == {"a": "success", "b": "failed", "c": "failed", "d": "failed"}
    at = fetch.host_schedule(items.where("url <> ''").withColumn("ord", F.col("id")), 2.0, "ord").orderBy("ord").collect()
    assert [(r.host, r.start) for r in at] == [("h.example", 0.0), ("i.example", 0.0)]
    made = []
    cloned = fetch.clone(spark.createDataFrame([("o/r", "http://h.example/o/r.git")], "id string, clone_url string"), str(tmp_path), command=lambda u, t: made.append(t)).collect()
    assert cloned[0].status == "success" and cloned[0].local_path.endswith("o_r")


def test_import_route(spark, tmp_path):
    rows = [{"ord": i, "instruction": f"write function number {i} in go", "response": f"package p{i}\nfunc f() int {{ return {i * 7919} }} // words {i * 31} more {i * 17}"} for i in range(6)]
    (tmp_path / "rows.json").write_text("\n".join(map(json.dumps, rows)))
    cfg = pipeline.Config("huggingface", source_options={"path": str(tmp_path / "rows.json")}, max_results=5, out=str(tmp_path), name="r", val_ratio=0.2)
    m = pipeline.run(spark, cfg)
    assert m["total_records"] == m["stats"]["total_out"] and m["stats"]["total_in"] == 5


def test_stream_keeps_first(spark, tmp_path):
    schema = "ord bigint, content string, license string, at timestamp"
    body = "a body that is long enough to pass the length bound of the cleaner"
    batch = spark.createDataFrame([(1, body, "MIT"), (2, body, "MIT"), (3, body + " x", "GPL-3.0"), (4, "short", "MIT")], "ord bigint, content string, license string").withColumn("at", F.current_timestamp())
    batch.write.parquet(str(tmp_path / "in"))
    out = clean_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "at")
    q = out.writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("kept").count() == 1


def test_data_sources_and_sql_functions(spark, tmp_path):
    from tamis.functions import registry
    from tamis.sources import datasource

    datasource.register(spark)
    registry.register(spark)
    (tmp_path / "h").mkdir()
    page = lambda a, b: json.dumps({"items": [{"full_name": f"o/r{i}", "license": None, "stargazers_count": 9 - i} for i in range(a, b)]})
    (tmp_path / "h/1.json").write_text(page(0, 2))
    (tmp_path / "h/2.json").write_text(page(2, 3))
    read = lambda n: [r.full_name for r in spark.read.format("code_host").options(base=str(tmp_path / "h"), page_size=2, max_results=n).load().collect()]
    assert read(10) == ["o/r0", "o/r1", "o/r2"] and read(1) == ["o/r0"]
    (tmp_path / "p").mkdir()
    (tmp_path / "p/0.xml").write_text(FEED)
    assert spark.read.format("papers").options(base=str(tmp_path / "p"), max_results=5).load().count() == 2
    assert spark.read.format("papers").options(base=str(tmp_path / "none"), max_results=5).load().count() == 0
    row = spark.sql("select parse_reply('{\"correctness\": 1}').score s, size(parse_pairs('junk')) n").first()
    assert (row.s, row.n) == (0.25, 0)
    got = spark.sql("select * from extract_code('```go\nfunc TestA() {}\n```')").collect()
    assert [(r.idx, r.is_test) for r in got] == [(0, True)]


def test_command_line(spark, tmp_path):
    from tamis.cli import main

    (tmp_path / "in.json").write_text("\n".join(json.dumps({"ord": i, "instruction": f"do {i}", "response": f"done {i}", "context": ""}) for i in range(5)))
    assert main(["build", str(tmp_path / "in.json"), "set", str(tmp_path / "out"), "--val-ratio", "0.2"]) == 0
    assert json.loads((tmp_path / "out/set.manifest.json").read_text())["splits"] == {"train": 4, "validation": 1}
