"""Fetching: repository walks, replay of stored replies, host schedules, opt-in downloads."""

from __future__ import annotations

import os
import random
import subprocess
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.operators.clean import wanted_path
from tamis.plans.runtime import places

RESULT = "id string, status string, url string, local_path string, content string, error string, attempts int, elapsed double, extra map<string,string>"


DOCUMENT = "id string, repo string, file_path string, content string, license string"


def _texts(files: DataFrame, extensions: list[str] | None, excludes: list[str] | None) -> DataFrame:
    """``files`` with wanted paths and content as text: valid UTF-8, not blank, line ends as line feeds."""
    out = files.where(wanted_path(F.col("file_path"), extensions, excludes)).where(F.is_valid_utf8("content"))
    return out.withColumn("content", F.regexp_replace(F.decode("content", "UTF-8"), "\r\n?", "\n")).where(~T.is_blank(F.col("content")))


def _below(spark: SparkSession, base: str) -> DataFrame:
    """``file_path`` (below ``base``) and ``content`` of all files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    root = (os.path.abspath(base) if "://" not in base else base) + "/"
    local = F.regexp_replace("path", r"^file:/+", "/")
    return files.select(F.substring(local, F.lit(len(root) + 1), F.length(local)).alias("file_path"), "content")


def walk(spark: SparkSession, root: str, repo: str, extensions: list[str] | None = None, excludes: list[str] | None = None, license_: str | None = None) -> DataFrame:
    """Documents of a cloned repository. A missing folder gives no rows."""
    if "://" not in root and not os.path.isdir(root):
        return spark.createDataFrame([], DOCUMENT)
    out = _texts(_below(spark, root.rstrip("/")), extensions, excludes)
    return out.select(F.concat(F.lit(repo + ":"), "file_path").alias("id"), F.lit(repo).alias("repo"), "file_path", "content", F.lit(license_).cast("string").alias("license"))


def walk_all(spark: SparkSession, base: str, repos: DataFrame, extensions: list[str] | None = None, excludes: list[str] | None = None) -> DataFrame:
    """Documents of all repositories cloned below ``base``, in one scan: ``repos(id, local_path, license, ord)``, whose folders are
    told by their last part, gives each its name, licence and ``repo_ord``. Nothing of it passes the driver, however many there are."""
    if "://" not in base and not os.path.isdir(base):
        return spark.createDataFrame([], DOCUMENT + ", repo_ord bigint")
    files = _below(spark, base.rstrip("/")).withColumn("folder", F.element_at(F.split("file_path", "/"), 1)).withColumn("file_path", F.regexp_replace("file_path", "^[^/]*/", ""))
    last = F.element_at(F.split(F.regexp_replace("local_path", "/+$", ""), "/"), -1)
    named = repos.groupBy(last.alias("folder")).agg(F.min(F.struct("ord", "id", "license")).alias("r"))
    out = _texts(files, extensions, excludes).join(named, "folder")
    repo = F.replace("r.id", F.lit("/"), F.lit("_"))
    return out.select(F.concat(repo, F.lit(":"), "file_path").alias("id"), repo.alias("repo"), "file_path", "content", F.col("r.license").alias("license"), F.col("r.ord").alias("repo_ord"))


def item_url(df: DataFrame) -> Column:
    """``url``, else ``fetch_url``; empty counts as missing."""
    have = [F.when(F.col(c) != "", F.col(c)) for c in ("url", "fetch_url") if c in df.columns]
    return F.coalesce(*have)


def fetch_replay(items: DataFrame, pages: DataFrame) -> DataFrame:
    """One result per item from stored ``pages(url, content)``: without an address failed ("no url"),
    without a page failed ("not stored")."""
    asked = items.select("id", item_url(items).alias("url"))
    one = pages.groupBy("url").agg(F.min("content").alias("content"))
    got = asked.join(one, "url", "left")
    status = F.when(F.col("content").isNotNull(), "success").otherwise("failed")
    error = F.when(F.col("url").isNull(), "no url").when(F.col("content").isNull(), "not stored")
    return got.select("id", status.alias("status"), "url", "content", error.alias("error"))


def successes(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if(F.col("status").isin("success", "cached")).alias("succeeded"), F.count("*").alias("total"))


def host_schedule(items: DataFrame, interval: float, order: str, url: str = "url") -> DataFrame:
    """``items`` with ``host`` and ``start``, the earliest second at which each may be asked so that one
    host is asked once per interval. Places come from one range sort, so a host with most items stays spread."""
    placed = places(items.withColumn("host", T.host(F.col(url))), "host", [order], "__place")
    return placed.withColumn("start", F.col("__place") * F.lit(float(interval))).drop("__place")


def with_license(results: DataFrame, records: DataFrame, order: str = "found_at") -> DataFrame:
    """Download results with the licence of their record (the one found last, for repeated ids)."""
    last = records.groupBy("id").agg(F.max_by("license", F.struct(order, "ord")).alias("license"))
    return results.join(last, "id", "left")


def fetch(items: DataFrame, get: Callable[[str], str], retries: int = 3, backoff: float = 0.5, interval: float = 0.0, partitions: int = 16, jitter: float = 0.1) -> DataFrame:
    """Online fetch: a host's items stay in one task, which paces and retries them, with growing pauses of which a share
    is random. ``get`` returns the text or raises. Store the result before using it twice."""
    spaced = items.select(F.col("id").cast("string"), item_url(items).alias("url")).withColumn("host", T.host(F.col("url"))).repartition(partitions, "host")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for b in batches:
            rows = []
            for i, url, host in zip(b["id"], b["url"], b["host"]):
                row = {"id": i if i is not None else url, "status": "failed", "url": url, "local_path": None, "content": None, "error": "no url", "attempts": 0, "elapsed": 0.0, "extra": {}}
                begun = time.monotonic()
                for k in range(retries if url else 0):
                    pause = last.get(host, float("-inf")) + interval - time.monotonic()
                    if pause > 0:
                        time.sleep(pause)
                    last[host] = time.monotonic()
                    row["attempts"] = k + 1
                    try:
                        row |= {"content": get(url), "status": "success", "error": None}
                        break
                    except Exception as e:  # any client error is a failed attempt
                        row["error"] = str(e)
                        if k + 1 < retries:
                            time.sleep(backoff * 2**k * (1 + random.random() * jitter))
                row["elapsed"] = time.monotonic() - begun
                rows.append(row)
            yield pd.DataFrame(rows, columns=["id", "status", "url", "local_path", "content", "error", "attempts", "elapsed", "extra"])

    return spaced.mapInPandas(run, RESULT)


def clone(repos: DataFrame, out: str, retries: int = 3, command: Callable[[str, str], None] | None = None) -> DataFrame:
    """Shallow clones into ``out/<id with _>``; a folder that isn't empty is ``cached``."""

    def git(url: str, target: str) -> None:
        subprocess.run(["git", "clone", "--depth", "1", url, target], check=True, capture_output=True, text=True)

    do = command or git
    have = [F.when(F.col(c) != "", F.col(c)) for c in ("clone_url", "fetch_url", "url") if c in repos.columns]
    asked = repos.select(F.col("id").cast("string"), F.coalesce(*have).alias("url"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, url in zip(b["id"], b["url"]):
                target = os.path.join(out, i.replace("/", "_"))
                row = {"id": i, "status": "failed", "url": url, "local_path": None, "content": None, "error": "no clone url", "attempts": 0, "elapsed": 0.0, "extra": {}}
                begun = time.monotonic()
                if os.path.isdir(target) and os.listdir(target):
                    row |= {"status": "cached", "local_path": target, "error": None}
                elif url:
                    for k in range(retries):
                        row["attempts"] = k + 1
                        try:
                            do(url, target)
                            row |= {"status": "success", "local_path": target, "error": None}
                            break
                        except (subprocess.CalledProcessError, OSError) as e:
                            row["error"] = str(e)
                row["elapsed"] = time.monotonic() - begun
                rows.append(row)
            yield pd.DataFrame(rows, columns=["id", "status", "url", "local_path", "content", "error", "attempts", "elapsed", "extra"])

    return asked.mapInPandas(run, RESULT)
