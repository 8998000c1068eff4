"""Pages fetched over HTTP as a data source: a range of numbers, with a delay between requests and retries.

``spark.read.format("http_pages")`` with options ``url`` (``{n}`` stands for the number), ``low``, ``high``, ``tries`` (3), ``delay`` seconds
between a task's requests (1), ``timeout`` (30), ``tasks`` (1: more tasks ask at once). Store the result before use:
a page is fetched again whenever the plan runs again.
"""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

AGENT = "Mozilla/5.0 (compatible; page reader)"
SCHEMA = "number int, url string, text string, tries int, error string"


def decoded(raw: bytes) -> str:
    """UTF-8, else Windows-1252, else Latin-1."""
    for name in ("utf-8", "cp1252"):
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


def fetch(url: str, tries: int = 3, timeout: float = 30.0, pause: float = 2.0) -> tuple[str | None, int, str | None]:
    """(text, tries made, last error): after the k-th failure it waits ``pause`` times k seconds."""
    error = None
    for k in range(1, tries + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as r:
                return decoded(r.read()), k, None
        except (OSError, ValueError) as e:
            error = f"{type(e).__name__}: {e}"
            if k < tries:
                time.sleep(pause * k)
    return None, tries, error


class Numbers(InputPartition):
    def __init__(self, numbers: list[int]):
        super().__init__(tuple(numbers))


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.low, self.high = options["url"], int(options.get("low", 1)), int(options["high"])
        self.tries, self.delay = int(options.get("tries", 3)), float(options.get("delay", 1))
        self.timeout, self.pause, self.tasks = float(options.get("timeout", 30)), float(options.get("pause", 2)), int(options.get("tasks", 1))

    def partitions(self):
        every = list(range(self.low, self.high + 1))
        return [Numbers(every[i :: self.tasks]) for i in range(min(self.tasks, max(1, len(every))))]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        for i, n in enumerate(partition.value):
            if i:
                time.sleep(self.delay)
            url = self.url.replace("{n}", str(n))
            text, tries, error = fetch(url, self.tries, self.timeout, self.pause)
            cols = [pa.array([n], pa.int32()), pa.array([url]), pa.array([text], pa.string()), pa.array([tries], pa.int32()), pa.array([error], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["number", "url", "text", "tries", "error"])


class HttpPages(DataSource):
    @classmethod
    def name(cls):
        return "http_pages"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PageReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HttpPages)
