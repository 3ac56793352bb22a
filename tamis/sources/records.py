"""Standard source records from replies of code hosts, paper feeds and dataset hubs."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.sources.registry import Source, register_source

EXTRA = "struct<clone_url:string,default_branch:string,stars:bigint,language:string,updated_at:string,summary:string,authors:array<string>,categories:array<string>,primary_category:string,published:string,updated:string,pdf_url:string,split:string>"
RECORD = f"source string, id string, url string, title string, license string, fetch_url string, extra {EXTRA}"
_EXTRA_FIELDS = [f.split(":")[0] for f in EXTRA[7:-1].replace("array<string>", "list").split(",")]
_KINDS = {"stars": "bigint", "authors": "array<string>", "categories": "array<string>"}
#: Fixed value: the licence that the paper feed stands for.
PAPER_LICENSE = "arXiv-nonexclusive"
PAYLOAD = "full_name string, html_url string, description string, license struct<spdx_id:string>, clone_url string, default_branch string, stargazers_count bigint, forks_count bigint, language string, updated_at string"
ENTRY = "id string, updated string, published string, title string, summary string, author array<struct<name:string>>, category array<struct<_term:string>>, link array<struct<_title:string,_href:string,_rel:string,_type:string>>, primary_category struct<_term:string>"


def _extra(**known: Column) -> Column:
    return F.struct(*[(known[f] if f in known else F.lit(None)).cast(_KINDS.get(f, "string")).alias(f) for f in _EXTRA_FIELDS])


def code_host_records(payload: DataFrame) -> DataFrame:
    """Records of repository payloads; a null or empty description gives the name as title."""
    extra = _extra(clone_url=F.col("clone_url"), default_branch=F.col("default_branch"), stars=F.col("stargazers_count"), language=F.col("language"), updated_at=F.col("updated_at"))
    title = F.coalesce(F.when(F.col("description") != "", F.col("description")), F.col("full_name"))
    return payload.select(F.lit("github").alias("source"), F.col("full_name").alias("id"), F.col("html_url").alias("url"), title.alias("title"), F.col("license.spdx_id").alias("license"), F.col("clone_url").alias("fetch_url"), extra.alias("extra"))


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    """Entries of saved feeds, with a schema that keeps single links and categories in arrays."""
    schema = ENTRY.replace("primary_category struct", "`arxiv:primary_category` struct")
    return spark.read.format("xml").schema(schema).option("rowTag", "entry").load(path).withColumnRenamed("arxiv:primary_category", "primary_category")


def atom_records(entries: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Records of feed entries: the id is the last part of the address, white space in title and
    summary is collapsed, the first link that is a PDF is fetched."""
    s = lambda c: F.coalesce(T.strip(F.col(c)), F.lit(""))
    none = F.array().cast("array<string>")
    url = s("id")
    pdf = F.try_element_at(F.filter("link", lambda x: F.coalesce(x["_title"] == "pdf", F.lit(False)) | F.coalesce(x["_type"] == "application/pdf", F.lit(False))), F.lit(1))["_href"]
    extra = _extra(
        summary=T.collapse(F.coalesce("summary", F.lit(""))),
        authors=F.coalesce(F.transform("author", lambda a: F.coalesce(T.strip(a["name"]), F.lit(""))), none),
        categories=F.coalesce(F.transform(F.filter("category", lambda c: c["_term"] != ""), lambda c: c["_term"]), none),
        primary_category=F.col("primary_category._term"),
        published=s("published"),
        updated=s("updated"),
        pdf_url=pdf,
    )
    return entries.select(*(keep or []), F.lit("arxiv").alias("source"), F.element_at(F.split(url, "/"), -1).alias("id"), url.alias("url"), T.collapse(F.coalesce("title", F.lit(""))).alias("title"), F.lit(PAPER_LICENSE).alias("license"), F.coalesce(pdf, url).alias("fetch_url"), extra.alias("extra"))


def describe(spark: SparkSession, dataset: str, split: str = "train", url: str | None = None) -> DataFrame:
    """One record that stands for a dataset of a hub."""
    row = spark.range(1).select(F.lit("huggingface").alias("source"), F.lit(dataset).alias("id"), F.lit(url or dataset).alias("url"), F.lit(dataset).alias("title"), F.lit(None).cast("string").alias("license"), F.lit(None).cast("string").alias("fetch_url"), _extra(split=F.lit(split)).alias("extra"))
    return row


def rank_repositories(rows: DataFrame, max_results: int, sort: str = "stars", order: str = "desc") -> DataFrame:
    """The first payloads as the server ranks them, missing values last, ties by name. The limit is the operator."""
    col = {"stars": "stargazers_count", "forks": "forks_count", "updated": "updated_at"}[sort]
    key = F.desc_nulls_last(col) if order == "desc" else F.asc_nulls_last(col)
    return rows.orderBy(key, "full_name").limit(max(0, max_results))


class CodeHostReplay(Source):
    """Saved repository payloads (option ``path``: JSON), ranked as the server would rank them."""

    def search(self, query: str, max_results: int = 100, *, sort: str = "stars", order: str = "desc", **kw: object) -> DataFrame:
        rows = self.spark.read.schema(PAYLOAD).json(str(self.options["path"]))
        return code_host_records(rank_repositories(rows, max_results, sort, order))

    def search_repositories(self, query: str, max_results: int = 100, **kw: object) -> DataFrame:
        """An older name of :meth:`search`."""
        warnings.warn("search_repositories is now search", DeprecationWarning, stacklevel=2)
        return self.search(query, max_results, **kw)


class PaperFeedReplay(Source):
    """Saved paper feeds (option ``path``: Atom)."""

    def search(self, query: str, max_results: int = 100, **kw: object) -> DataFrame:
        return atom_records(read_atom(self.spark, str(self.options["path"]))).limit(max(0, max_results))


class HubReplay(Source):
    """A local copy of a hub dataset (options ``path``, ``language``, ``order``), as pairs."""

    def search(self, query: str, max_results: int = 100, *, max_scan: int | None = None, **kw: object) -> DataFrame:
        from tamis.operators.pairs import import_scan

        path = str(self.options["path"])
        rows = self.spark.read.parquet(path) if path.endswith(".parquet") else self.spark.read.json(path)
        order = str(self.options.get("order", "ord"))
        if order not in rows.columns:
            rows = rows.withColumn(order, F.monotonically_increasing_id())
        return import_scan(rows, order, str(self.options.get("language", "go")), max_results, max_scan)


register_source("github", CodeHostReplay)
register_source("arxiv", PaperFeedReplay)
register_source("huggingface", HubReplay)
