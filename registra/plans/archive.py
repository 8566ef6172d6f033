"""Archive manifests: what to upload under which name, and the manifest that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.incremental import archive_plan, population_plan


def mirror_entries(manifest: DataFrame, files: DataFrame, populations: DataFrame | None = None) -> DataFrame:
    """Entries of the mirror with the hash of their local file. ``files`` and ``populations`` are binary
    scans (path, content, length)."""
    m = manifest.withColumn("_name", S.basename("pdf_path"))
    have = files.select(S.basename("path").alias("_name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))
    x = m.join(have, "_name").withColumn("hash_mismatch", ~F.expr("sha256 <=> file_hash"))
    if populations is None:
        return x.withColumn("pop_sha", F.lit(None).cast("string")).drop("_name")
    pops = populations.select(S.basename("path").alias("_pop"), F.sha2("content", 256).alias("pop_sha"))
    return x.withColumn("_pop", S.basename("population_path")).join(pops, "_pop", "left").drop("_name", "_pop")


def plan(entries: DataFrame, archived: DataFrame, assets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(uploads of documents, uploads of populations, new manifest rows); the uploads themselves are
    the caller's."""
    entries = entries.withColumn("ord", F.col("date").cast("string"))
    pops = population_plan(entries.where("pop_sha is not null").select("date", "pop_sha").distinct(), archived, assets)
    docs = archive_plan(entries.select("ord", "date", "sha256", "url", "file_hash", "hash_mismatch", "size_bytes", "pop_sha"), archived, assets)
    rows = entries.join(docs, ["date", "sha256"]).join(pops.select("date", "pop_sha", "population_asset"), ["date", "pop_sha"], "left")
    rows = rows.select("date", F.col("url").alias("source_url"), "sha256", F.col("file_hash").alias("mirror_manifest_sha256"), "hash_mismatch", "size_bytes", "pdf_asset", F.col("pop_sha").alias("population_sha256"), "population_asset").dropDuplicates(["date", "sha256"])
    return docs.where("upload"), pops.where("upload"), rows


def stats(entries: DataFrame, archived: DataFrame, docs: DataFrame, pops: DataFrame) -> DataFrame:
    """One row of run figures."""
    from functools import reduce

    parts = [
        docs.agg(F.count("*").alias("pdfs_uploaded")), pops.agg(F.count("*").alias("populations_uploaded")), entries.agg(F.count_if("hash_mismatch").alias("hash_mismatches")),
        entries.join(archived.select("date", "sha256").distinct(), ["date", "sha256"], "left_semi").agg(F.count("*").alias("already_archived")),
    ]
    return reduce(lambda a, b: a.join(F.broadcast(b), F.lit(True)), parts)  # each is one row


def form_versions(manifest: DataFrame, archived: DataFrame, assets: DataFrame) -> DataFrame:
    """Names of form versions whose bytes are not archived: each version once, always uploaded."""
    new = manifest.join(archived.select("sha256"), "sha256", "left_anti").dropDuplicates(["sha256"])
    x = new.withColumn("plain", F.concat(F.lit("smk-"), "generated", F.lit(".pdf")))
    x = x.join(assets.select(F.col("name").alias("plain"), F.lit(True).alias("taken")).distinct(), "plain", "left")
    return x.select("generated", "sha256", "wayback_ts", F.when(F.col("taken").isNull(), F.col("plain")).otherwise(F.concat(F.lit("smk-"), "generated", F.lit("-"), F.substring("sha256", 1, 8), F.lit(".pdf"))).alias("asset"), F.lit("smk-wayback").alias("source"))


def manifest_after(manifest: DataFrame, new: DataFrame) -> DataFrame:
    """The form manifest with new versions, in order."""
    return manifest.unionByName(new).orderBy("generated", "wayback_ts")
