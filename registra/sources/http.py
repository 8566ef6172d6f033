"""HTTP blobs as a batch data source: one partition per address, with retries."""

from __future__ import annotations

import time

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def get(url: str, timeout: float, tries: int = 3, pause: float = 20.0, opener=None, sleep=time.sleep) -> bytes:
    """The body; the last failure is raised."""
    import urllib.request

    opener = opener or (lambda: urllib.request.urlopen(urllib.request.Request(url), timeout=timeout).read())
    for left in range(tries - 1, -1, -1):
        try:
            return opener()
        except OSError:
            if not left:
                raise
            sleep(pause)
    raise ValueError("tries must be positive")


class HttpBlobs(DataSource):
    """``spark.read.format("http_blobs").option("urls", "<address> <address>")`` gives url and content."""

    @classmethod
    def name(cls) -> str:
        return "http_blobs"

    def schema(self) -> str:
        return "url string, content binary"

    def reader(self, schema):
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.urls = options.get("urls", "").split()
        self.timeout = float(options.get("timeout", "90"))
        self.tries = int(options.get("tries", "3"))

    def partitions(self):
        return [InputPartition(u) for u in self.urls]

    def read(self, partition):
        yield partition.value, get(partition.value, self.timeout, self.tries)
