"""Sinks: snapshot store, published files, cache shards, reports and markdown."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import scalars as S
from . import tables


def commit_snapshots(spark: SparkSession, store: str, parts: dict[str, DataFrame], meta: DataFrame) -> str:
    """Write the tables of any number of snapshots and then commit them together; gives the version.

    ``parts`` has the published columns and ``snapshot``; ``meta`` has snapshot and columns of META, one
    row a snapshot. Every table is one write under a version of its own, so nothing that readers use is
    touched; the commit is one file of markers, which appears whole or not at all. Without it the version's
    rows are never read. A snapshot that is committed again replaces its older version."""
    last = tables.commits(spark, store).agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]
    version = f"{last + 1:08d}-{uuid.uuid4().hex}"
    for name, df in parts.items():
        write_version(df, store, name, version)
    write_markers(meta.withColumns({"version": F.lit(version), "generation": F.lit(last + 1)}), store)
    return version


def write_version(df: DataFrame, store: str, name: str, version: str) -> None:
    """One table of all snapshots of a version, a folder a snapshot."""
    df.withColumn("version", F.lit(version)).hint("rebalance", F.col("snapshot")).write.mode("append").partitionBy("version", "snapshot").parquet(f"{store}/{name}")


def write_markers(meta: DataFrame, store: str) -> None:
    """One file of markers; a column of META that ``meta`` lacks is null."""
    schema = StructType.fromDDL(f"snapshot string, version string, generation bigint, {tables.META}")
    told = [(F.col(f.name) if f.name in meta.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    meta.select(*told).coalesce(1).write.mode("append").parquet(f"{store}/commits")


def vacuum_snapshots(spark: SparkSession, store: str) -> int:
    """Removes versions of snapshots that no commit in force names: replaced ones, and those of writes that
    were cut short. No writer may be at work, nor a reader of an earlier state."""
    keep = {(r["snapshot"], r["version"]) for r in tables.commits(spark, store).select("snapshot", "version").collect()}  # one a publication
    gone = 0
    for path in tables.listed(spark, f"{store}/*/version=*/snapshot=*"):
        version, snapshot = path.split("/")[-2:]
        if (snapshot.partition("=")[2], version.partition("=")[2]) not in keep:
            remove(spark, path)
            gone += 1
    return gone


def publish_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def publish_csv(df: DataFrame, path: str) -> None:
    """Gzipped CSV with a header and doubled quotes; null is empty, booleans read True and False.

    Rows end in a line feed: rewriting row ends would also rewrite line feeds inside quoted cells."""
    flags = [c for c, t in df.dtypes if t == "boolean"]
    out = df.withColumns({c: F.when(F.col(c), "True").when(~F.col(c), "False") for c in flags}) if flags else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("nullValue", "").option("compression", "gzip").csv(path)


def publish_jsonl(df: DataFrame, path: str) -> None:
    """Gzipped JSON Lines; nulls are kept and text beyond ASCII stays as it is."""
    df.write.mode("overwrite").option("ignoreNullFields", False).option("compression", "gzip").json(path)


def publish(df: DataFrame, out: str, name: str, **metrics: Column) -> dict[str, object]:
    """All three formats; gives the number of ``rows`` and the metrics (aggregates) of what was written. They
    are observed while the parquet file is written, in the tasks that write it, so nothing is read again."""
    seen = Observation()
    publish_parquet(df.observe(seen, F.count("*").alias("rows"), *[m.alias(k) for k, m in metrics.items()]), f"{out}/{name}.parquet")
    publish_csv(df, f"{out}/{name}.csv.gz")
    publish_jsonl(df, f"{out}/{name}.jsonl.gz")
    return seen.get


def append_cache(records: DataFrame, cache: str, run: int | None = None) -> None:
    """Appends records as JSON Lines under ``run=<n>``, those of a shard (the first two digits of the hash)
    together, in files of about the size that Spark advises. Runs are numbered, so that a record written later is known as later whatever its file is called. A ``run`` that
    is given replaces itself, so that a caller that is not sure whether it was written may write it again."""
    number = tables.last_run(records.sparkSession, cache) + 1 if run is None else run
    shard = S.shard("block_hash").alias("shard")
    out = records.select("*", shard).hint("rebalance", F.col("shard")).sortWithinPartitions("shard").drop("shard")
    out.write.mode("errorifexists" if run is None else "overwrite").option("ignoreNullFields", False).json(f"{cache}/run={number:012d}")


def compact_cache(spark: SparkSession, cache: str, buckets: int = 64) -> int:
    """Rewrites all runs as one record a hash, in files bucketed and sorted by hash; gives the generation.

    Its marker is written last: until then readers use the generation and the runs before. Runs that the
    generation holds are no longer read, and ``vacuum_cache`` removes them. Shard files of the other layout
    may be appended to elsewhere, so they stay as they are."""
    last = tables.last_run(spark, cache)
    g = (tables.generation(spark, cache) or {"generation": 0})["generation"] + 1
    name, path = f"cache_{uuid.uuid4().hex}", f"{cache}/compact/generation={g:06d}-{uuid.uuid4().hex}"
    rows = tables.cache_latest(spark, cache, shards=False).repartition(buckets, "block_hash")
    rows.write.format("parquet").bucketBy(buckets, "block_hash").sortBy("block_hash").option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    marker = {"generation": g, "last_run": last, "buckets": buckets, "folder": path.rpartition("/")[2]}
    write_text(spark, f"{cache}/compact/generation={g:06d}.json", json.dumps([marker]))
    return g


def vacuum_cache(spark: SparkSession, cache: str) -> None:
    """Removes what the last generation has made needless. No reader of an earlier state may be at work."""
    g = tables.generation(spark, cache)
    if g:
        for path in tables.listed(spark, f"{cache}/run=*"):
            if int(path.rpartition("=")[2]) <= g["last_run"]:
                remove(spark, path)
        for path in tables.listed(spark, f"{cache}/compact/*"):
            name = path.rpartition("/")[2]
            if name not in (g["folder"], f"generation={g['generation']:06d}.json"):
                remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small report or marker as one file, on any file system."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def md_line(*cells: Column, more: Column | None = None) -> Column:
    rest = [] if more is None else [F.transform(more, S.md_escape)]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[S.md_escape(c) for c in cells], *rest), F.lit(" |"))


def md_table(rows: DataFrame, headers: list[str], order: tuple[str, ...], more: DataFrame | None = None) -> DataFrame:
    """One row ``md``: the table of a snapshot (a bounded report), its lines in order. ``more`` has one row of
    further ``headers``, which the column ``cells`` of the rows follows."""
    line = md_line(*[F.col(f"`{h}`") for h in headers], more=None if more is None else F.col("cells"))
    lines = rows.select(F.struct(*order).alias("o"), line.alias("line")).groupBy().agg(F.array_sort(F.collect_list(F.struct("o", "line"))).alias("ls"))
    names = F.array(*[F.lit(h) for h in headers])
    if more is not None:
        lines, names = lines.join(F.broadcast(more), F.lit(True)), F.concat(names, "headers")
    head = F.concat(F.lit("| "), F.array_join(names, " | "), F.lit(" |\n|"), F.repeat(F.lit("---|"), F.size(names)))
    return lines.select(F.array_join(F.concat(F.array(head), F.transform("ls", lambda x: x["line"])), "\n").alias("md"))
