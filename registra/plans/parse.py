"""Incremental parse jobs: changed snapshots are decoded, classified, written and committed together.

A job runs the same number of Spark jobs whatever the number of snapshots. What all tables derive from,
the classified lines, is written once to the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import form_layout, register_layout
from ..operators.incremental import changed_snapshots
from ..operators.lines import body_words, form_split, group_lines, register_split
from ..session import shared_folder
from ..sources import sinks, tables


class _Work:
    """Tables written once for several readers, and removed at the end."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def __enter__(self) -> _Work:
        return self

    def __exit__(self, *_) -> None:
        sinks.remove(self.spark, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")


def parse_register(spark: SparkSession, manifest: DataFrame, words: DataFrame, store: str) -> list[str]:
    """``manifest`` has date, url, file_hash, n_pages, population_count, doc_id. Gives the dates written."""
    with _Work(spark, "parse") as work:
        todo = work.keep(changed_snapshots(manifest, tables.snapshot_meta(spark, store), register_layout.PARSER_VERSION), "todo")
        dates = sorted(r[0] for r in todo.select("date").distinct().collect())  # one per publication
        if dates:
            mine = words.join(todo.select("doc_id").distinct(), "doc_id", "left_semi")
            lines = work.keep(group_lines(body_words(mine, "register")), "lines")
            split = register_split(lines)
            classified = work.keep(register_layout.classify(lines, split), "classified")
            out = register_layout.tables(classified, split, todo.select("doc_id", "date", "url", "file_hash", "n_pages"))
            parts = {n: df.withColumn("snapshot", F.col("date")) for n, df in out._asdict().items()}
            parts["documents"] = work.keep(parts["documents"], "documents")
            told = parts["documents"].select("date", "n_persons", "n_remainder_lines", "n_pages").join(todo.select("date", "url", "file_hash", "parser_version", "population_count"), "date")
            sinks.commit_snapshots(spark, store, parts, told.withColumn("snapshot", F.col("date")))
    return dates


def parse_forms(spark: SparkSession, manifest: DataFrame, words: DataFrame, store: str, source_url: str) -> list[str]:
    """``manifest`` has generated, wayback_ts, sha256, n_pages, doc_id. Gives the versions written."""
    with _Work(spark, "parse") as work:
        m = manifest.withColumn("date", F.concat_ws("_", "generated", "wayback_ts")).withColumnRenamed("sha256", "file_hash")
        todo = work.keep(changed_snapshots(m, tables.snapshot_meta(spark, store), form_layout.PARSER_VERSION), "todo")
        dates = sorted(r[0] for r in todo.select("date").distinct().collect())  # one per version
        if dates:
            meta = todo.select("doc_id", "date", "generated", "wayback_ts", F.lit(source_url).alias("source_url"), S.capture_url("wayback_ts", source_url).alias("wayback_url"), "file_hash", "n_pages")
            lines = work.keep(group_lines(body_words(words.join(todo.select("doc_id").distinct(), "doc_id", "left_semi"), "form")), "lines")
            classified = work.keep(form_layout.classify(lines, form_split(lines)), "classified")
            parts = form_layout.tables(lines, classified, meta, "date")._asdict()
            sinks.commit_snapshots(spark, store, {n: df.withColumnRenamed("date", "snapshot") for n, df in parts.items()}, todo.select("date", F.col("date").alias("snapshot"), "file_hash", "parser_version", "n_pages"))
    return dates
