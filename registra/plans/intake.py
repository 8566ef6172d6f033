"""Verified intake: files that are what the manifest says go on, the others are listed with a reason; and
a manifest that several writers add to."""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import is_pdf
from ..sources import sinks, tables

MISSING, NOT_PDF, DIFFERS = "missing", "not a pdf", "sha256 differs"


class Intake(NamedTuple):
    good: DataFrame  # the manifest's rows whose file is there and right
    bad: DataFrame  # the others, with ``reason``


def inspect(files: DataFrame) -> DataFrame:
    """(path, local_sha, pdf) of a binary scan: contents are read once and never shuffled."""
    return files.select("path", F.sha2("content", 256).alias("local_sha"), is_pdf("content").alias("pdf"))


def verify(manifest: DataFrame, inspected: DataFrame, name: Column, expected: str = "sha256") -> Intake:
    """Manifest rows by what ``inspected`` tells of the file called ``name``. An entry without an expected
    hash is wrong as one with another is, an empty file is one that is missing; of several files of one name one that is right is enough."""
    found = inspected.select(F.element_at(F.split("path", "/"), -1).alias("_name"), "local_sha", "pdf")
    found = found.groupBy("_name", "local_sha").agg(F.max("pdf").alias("pdf"))
    seen = found.groupBy("_name").agg(F.max("pdf").alias("_any_pdf"))
    right = found.where("pdf").select("_name", F.col("local_sha").alias("_right"))
    x = manifest.withColumn("_name", name).join(seen, "_name", "left")
    x = x.join(right, (x["_name"] == right["_name"]) & (x[expected] == right["_right"]), "left").drop(right["_name"])
    reason = F.when(F.col("_any_pdf").isNull(), MISSING).when(~F.col("_any_pdf"), NOT_PDF).when(F.col("_right").isNull(), DIFFERS)
    x = x.withColumn("reason", reason).drop("_name", "_any_pdf", "_right")
    return Intake(x.where("reason is null").drop("reason"), x.where("reason is not null"))


def read_manifest(spark: SparkSession, folder: str, ddl: str) -> tuple[int, DataFrame]:
    """(generation, rows) of a manifest that ``add_to_manifest`` keeps; 0 and no rows before the first."""
    marks = sorted(tables.listed(spark, f"{folder}/generation=*.json"))
    if not marks:
        return 0, spark.createDataFrame([], ddl)
    mark = spark.read.schema("generation int, rows string").option("multiLine", True).json(marks[-1]).first()
    return mark["generation"], spark.read.schema(ddl).json(f"{folder}/{mark['rows']}")


def add_to_manifest(spark: SparkSession, folder: str, new: DataFrame, ddl: str, key: tuple[str, ...], order: tuple[str, ...], tries: int = 20) -> int:
    """Add the rows whose key is new, in order, as the next generation; gives its number.

    The rows are written aside; the generation is the marker that names them, and only one writer can
    create the marker of a number. A writer that comes second takes up what the first one added and tries
    the next number, so no entry is lost."""
    for _ in range(tries):
        n, rows = read_manifest(spark, folder, ddl)
        fresh = new.dropDuplicates(list(key)).join(rows.select(*key), list(key), "left_anti").select(*rows.columns)
        aside = f"rows-{uuid.uuid4().hex}"
        rows.unionByName(fresh).orderBy(*order).write.json(f"{folder}/{aside}")
        if _claim(spark, f"{folder}/generation={n + 1:08d}.json", json.dumps({"generation": n + 1, "rows": aside})):
            return n + 1
        sinks.remove(spark, f"{folder}/{aside}")
    raise TimeoutError(f"the manifest changed {tries} times meanwhile")


def _claim(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not be there yet; false where another writer was first."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True
