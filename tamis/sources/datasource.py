"""Search interfaces as Spark data sources: ``spark.read.format("code_host" | "papers")``.

Options: ``query``, ``max_results``, ``page_size``, ``delay`` (seconds between pages), ``base`` (address of
the interface, or a folder of saved pages ``1.json``/``0.xml`` for replays), ``token``, ``sort``,
``order``. Without a ``token`` that of the environment is taken, or a warning says that there is none. Pages are read one after another in one task, as such interfaces ask for.
"""

from __future__ import annotations

import json
import os
import time
import warnings
from collections.abc import Iterator
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def page_plan(max_results: int, page_size: int, largest: int = 100) -> int:
    """Rows asked for per page."""
    return min(largest, page_size, max(1, max_results))


def token_of(options: dict, env: dict | None = None) -> str:
    """The token among the options, else in the environment; a live interface without one is slow, which a warning says."""
    token = options.get("token") or (os.environ if env is None else env).get("TAMIS_HOST_TOKEN", "")
    if not token and "://" in options.get("base", ""):
        warnings.warn("no token for the code host: requests are limited to few an hour", stacklevel=2)
    return token


class _Reader(DataSourceReader):
    def __init__(self, options: dict, suffix: str):
        self.o, self.suffix = dict(options), suffix
        self.most = int(self.o.get("max_results", 100))
        self.size = page_plan(self.most, int(self.o.get("page_size", 100)))
        self.o["token"] = token_of(self.o)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def get(self, key: int, params: dict) -> str | None:
        """A page's text, or None where a replay has no such page. A full rate window is waited out."""
        base = self.o["base"]
        if "://" not in base:
            path = os.path.join(base, f"{key}.{self.suffix}")
            if not os.path.exists(path):
                return None
            with open(path, encoding="utf-8") as f:
                return f.read()
        headers = {"User-Agent": "tamis"} | ({"Authorization": f"token {self.o['token']}"} if self.o.get("token") else {})
        while True:
            try:
                with urlopen(Request(f"{base}?{urlencode(params)}", headers=headers), timeout=30) as r:  # noqa: S310
                    return r.read().decode()
            except OSError as e:
                reset = getattr(e, "headers", None) and e.headers.get("X-RateLimit-Reset")
                if getattr(e, "code", 0) != 403 or not reset:
                    raise
                time.sleep(max(0.0, int(reset) - time.time()) + 5)

    def pause(self) -> None:
        if "://" in self.o["base"]:
            time.sleep(float(self.o.get("delay", 3)))


class _CodeHostReader(_Reader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        done, page = 0, 1
        while done < self.most:
            raw = self.get(page, {"q": self.o.get("query", ""), "sort": self.o.get("sort", "stars"), "order": self.o.get("order", "desc"), "per_page": self.size, "page": page})
            items = json.loads(raw).get("items", []) if raw else []
            for x in items[: self.most - done]:
                yield (x.get("full_name"), x.get("html_url"), x.get("description"), (x.get("license") or {}).get("spdx_id"), x.get("clone_url"), x.get("default_branch"), x.get("stargazers_count"), x.get("forks_count"), x.get("language"), x.get("updated_at"))
            done += len(items)
            if len(items) < self.size:
                return
            page += 1
            self.pause()


class CodeHostSource(DataSource):
    """Repositories that a code host's search finds, in its order."""

    @classmethod
    def name(cls) -> str:
        return "code_host"

    def schema(self) -> str:
        return "full_name string, html_url string, description string, spdx_id string, clone_url string, default_branch string, stargazers_count bigint, forks_count bigint, language string, updated_at string"

    def reader(self, schema) -> DataSourceReader:
        return _CodeHostReader(self.options, "json")


class _PaperReader(_Reader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import xml.etree.ElementTree as ET

        start = 0
        while start < self.most:
            want = min(self.size, self.most - start)
            raw = self.get(start, {"search_query": self.o.get("query", ""), "start": start, "max_results": want, "sortBy": self.o.get("sort", "relevance"), "sortOrder": self.o.get("order", "descending")})
            found = [x for x in ET.fromstring(raw) if x.tag.endswith("}entry") or x.tag == "entry"] if raw else []
            for x in found[: self.most - start]:
                yield (ET.tostring(x, encoding="unicode"),)
            start += len(found)
            if len(found) < want:
                return
            self.pause()


class PaperSource(DataSource):
    """Entries of a paper feed, as XML texts."""

    @classmethod
    def name(cls) -> str:
        return "papers"

    def schema(self) -> str:
        return "entry string"

    def reader(self, schema) -> DataSourceReader:
        return _PaperReader(self.options, "xml")


def register(spark: SparkSession) -> None:
    """Makes both formats known to a session."""
    for cls in (CodeHostSource, PaperSource):
        spark.dataSource.register(cls)
