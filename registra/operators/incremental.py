"""Keyed skips: snapshots, archive entries, captures and names that are there already."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def changed_snapshots(candidates: DataFrame, stored: DataFrame, parser_version: str, key: tuple[str, ...] = ("date",)) -> DataFrame:
    """Candidates of which the store has no entry with the same hash and parser version."""
    c = candidates.withColumn("parser_version", F.lit(parser_version))
    return c.join(stored.select(*key, "file_hash", "parser_version"), [*key, "file_hash", "parser_version"], "left_anti")


def new_captures(index: DataFrame, known: DataFrame) -> DataFrame:
    """First capture of each digest that is not known, by time. ``index`` has ord, timestamp, digest."""
    first = index.groupBy("digest").agg(F.min_by("timestamp", "ord").alias("timestamp"))
    return first.join(known.select("digest"), "digest", "left_anti").orderBy("timestamp")


def is_pdf(content: str = "content"):
    return F.substring(F.col(content), 1, 4) == F.lit(b"%PDF")


def verified(files: DataFrame, content: str = "content", expected: str = "sha256") -> DataFrame:
    """The rows as they are; reading one whose bytes do not have the expected hash fails."""
    ok = F.sha2(F.col(content), 256) == F.col(expected)
    return files.withColumn(expected, F.when(F.coalesce(ok, F.lit(False)), F.col(expected)).otherwise(F.raise_error(F.concat(F.lit("sha256 mismatch, expected "), F.coalesce(F.col(expected), F.lit("none"))))))


def hash_mismatch(files: DataFrame, content: str = "content", expected: str = "file_hash") -> DataFrame:
    """Flagged, not failed."""
    return files.withColumn("local_sha", F.sha2(F.col(content), 256)).withColumn("hash_mismatch", ~F.expr(f"local_sha <=> {expected}"))


def archive_plan(entries: DataFrame, archived: DataFrame, assets: DataFrame, prefix: str = "pr-", suffix: str = ".pdf") -> DataFrame:
    """Asset name and upload flag of every entry not archived yet.

    ``entries`` has date, sha256 and ord; repeats of (date, sha256) count once. A taken name gets the
    first eight digits of the hash; where that is taken too, nothing is uploaded but the entry stands.
    Names taken earlier in the same run count: the first new entry of a date takes the plain name."""
    new = entries.join(archived.select("date", "sha256"), ["date", "sha256"], "left_anti")
    new = new.groupBy("date", "sha256").agg(F.min_by(F.struct(*[c for c in new.columns if c not in ("date", "sha256")]), "ord").alias("r")).select("date", "sha256", "r.*")
    taken = assets.select("name").distinct().withColumn("taken", F.lit(True))
    plain = F.concat(F.lit(prefix), "date", F.lit(suffix))
    hashed = F.concat(F.lit(prefix), "date", F.lit("-"), F.substring("sha256", 1, 8), F.lit(suffix))
    x = new.withColumn("plain", plain).withColumn("hashed", hashed)
    x = x.join(taken.select(F.col("name").alias("plain"), F.col("taken").alias("t1")), "plain", "left").join(taken.select(F.col("name").alias("hashed"), F.col("taken").alias("t2")), "hashed", "left")
    nth = F.row_number().over(Window.partitionBy("date").orderBy("ord", "sha256"))
    use_plain = F.col("t1").isNull() & (nth == 1)
    x = x.withColumn("use_plain", use_plain)
    same = F.row_number().over(Window.partitionBy("date", "hashed", "use_plain").orderBy("ord", "sha256"))
    return x.select("date", "sha256", F.when(F.col("use_plain"), F.col("plain")).otherwise(F.col("hashed")).alias("pdf_asset"), (F.col("use_plain") | (F.col("t2").isNull() & (same == 1))).alias("upload"))


def population_plan(entries: DataFrame, archived: DataFrame, assets: DataFrame) -> DataFrame:
    """Names of population files: hash-suffixed where the plain name is taken by other content."""
    x = entries.withColumn("plain", F.concat(F.lit("population-"), "date", F.lit(".json")))
    x = x.join(assets.select(F.col("name").alias("plain"), F.lit(True).alias("taken")).distinct(), "plain", "left")
    x = x.join(archived.select("date", F.col("population_sha256").alias("pop_sha"), F.lit(True).alias("known")).distinct(), ["date", "pop_sha"], "left")
    other = F.col("taken").isNotNull() & F.col("known").isNull()
    name = F.when(other, F.concat(F.lit("population-"), "date", F.lit("-"), F.substring("pop_sha", 1, 8), F.lit(".json"))).otherwise(F.col("plain"))
    x = x.withColumn("population_asset", name)
    x = x.join(assets.select(F.col("name").alias("population_asset"), F.lit(True).alias("there")).distinct(), "population_asset", "left")
    return x.select("date", "pop_sha", "population_asset", F.col("there").isNull().alias("upload"))


def manifest_checks(manifest: DataFrame) -> DataFrame:
    """Counts of rows that break the manifest's rules."""
    bad = lambda ok: F.count_if(~F.coalesce(ok, F.lit(False)))
    return manifest.agg(
        F.count("*").alias("entries"), F.count_if(F.col("dataset")).alias("in_dataset"), bad(F.col("sha256").rlike("^[0-9a-f]{64}$")).alias("bad_sha256"), bad(F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("bad_date"),
        bad(F.col("origin").isin("live-arkiv", "wayback")).alias("bad_origin"), (F.count("date") - F.count_distinct("date")).alias("repeated_dates"))


def basename_of(column: str):
    return S.basename(column)
