"""Request batches as a stream: the offset is the number of batches that are done."""

from __future__ import annotations

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader


class RequestBatches(DataSource):
    """``spark.readStream.format("request_batches").option("batches", n)`` gives batch_id 0 .. n - 1, one a
    trigger. What a batch holds stays in a table, so offsets stay small whatever the plan's size."""

    @classmethod
    def name(cls) -> str:
        return "request_batches"

    def schema(self) -> str:
        return "batch_id int"

    def simpleStreamReader(self, schema):
        return _Reader(int(self.options["batches"]))


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, batches: int):
        self.batches = batches

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def read(self, start: dict):
        end = {"batch": min(start["batch"] + 1, self.batches)}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter([(k,) for k in range(start["batch"], end["batch"])])
