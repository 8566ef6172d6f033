"""Command line: parse, backfill, smk-parse, build, export-md, archive, smk-archive, enrich, smk-collect.

Commands that need a decoder, a model or an upload take what a caller has put there beforehand: decoded
words as a table, an extractor as ``module:function``; archive commands print their plan as JSON Lines."""

from __future__ import annotations

import argparse
import importlib
import json
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="registra")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *args: str, **options):
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(a)
        for k, v in options.items():
            flag = "--" + k.replace("_", "-")
            if isinstance(v, bool):
                s.add_argument(flag, action=argparse.BooleanOptionalAction, default=v)
            elif v is ...:
                s.add_argument(flag, required=True)
            else:
                s.add_argument(flag, default=v, type=type(v) if v is not None else str)
        return s

    add("parse", "mirror", "store", words=...)
    add("backfill", "manifest", "store", words=..., pdf_dir="")
    add("enrich", "store", "cache", max_requests=120, batch_size=6, model="extractor", extractor=...)
    add("smk-collect", "manifest", "index", captures=None)
    add("smk-parse", "manifest", "store", words=..., source_url="", pdf_dir="")
    add("smk-archive", "manifest", archived="", assets="")
    add("archive", "mirror", archived="", assets="", pdf_dir="", population_dir="")
    add("export-md", "store", "out", cache="cache/llm")
    add("build", "store", "out", cache="cache/llm", smk_store="store_smk", pool="")
    return p


def run(argv: list[str], spark) -> object:
    from pyspark.sql import functions as F

    from .plans import archive, enrich, intake, markdown, parse, publish
    from .sources import tables as T

    a = _parser().parse_args(argv)
    none = lambda ddl: spark.createDataFrame([], ddl)
    assets = lambda path: T.asset_listing(spark, path) if path else none("name string, id bigint")

    def verified(manifest, expected: str, job):
        """The job over all entries or, where the files are at hand, over those whose file is right; the
        others are listed (a report for whoever runs the command)."""
        if not a.pdf_dir:
            return job(manifest)
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(a.pdf_dir)
        good, bad = intake.verify(manifest, intake.inspect(files), F.concat("doc_id", F.lit(".pdf")), expected)
        return {"written": job(good), "refused": [r.asDict() for r in bad.select("doc_id", "reason").orderBy("doc_id").collect()]}

    if a.command == "parse":
        m = T.mirror_manifest(spark, f"{a.mirror}/manifest.parquet")
        counts = F.col("population_count") if "population_count" in m.columns else F.lit(None).cast("int")
        words = T.words(spark, a.words)
        pages = words.groupBy("doc_id").agg((F.max("page") + 1).alias("n_pages"))
        m = m.select(F.col("date").cast("string").alias("date"), "url", "file_hash", counts.alias("population_count"), F.concat(F.lit("pr-"), F.col("date").cast("string")).alias("doc_id")).join(pages, "doc_id")
        return parse.parse_register(spark, m, words, a.store)
    if a.command == "backfill":
        words = T.words(spark, a.words)
        pages = words.groupBy("doc_id").agg((F.max("page") + 1).alias("n_pages"))
        m = T.backfill_manifest(spark, a.manifest).select("date", "url", F.col("sha256").alias("file_hash"), F.lit(None).cast("int").alias("population_count"), F.concat(F.lit("pr-"), "date").alias("doc_id")).join(pages, "doc_id")
        return verified(m, "file_hash", lambda good: parse.parse_register(spark, good, words, a.store))
    if a.command == "smk-parse":
        words = T.words(spark, a.words)
        pages = words.groupBy("doc_id").agg((F.max("page") + 1).alias("n_pages"))
        m = T.form_versions(T.form_manifest(spark, a.manifest)).withColumn("doc_id", F.concat(F.lit("smk_"), "wayback_ts")).join(pages, "doc_id")
        return verified(m, "sha256", lambda good: parse.parse_forms(spark, good, words, a.store, a.source_url))
    if a.command == "enrich":
        module, _, name = a.extractor.partition(":")
        sections = T.snapshots(spark, a.store, "sections", ["date", "person_index", "section_order", "block_hash", "paragraf", "label", "text"])
        return enrich.enrich(spark, sections, a.cache, getattr(importlib.import_module(module), name), a.model, ("date", "person_index", "section_order"), a.max_requests, a.batch_size)
    if a.command == "smk-collect":
        from .operators.incremental import new_captures

        return [r.asDict() for r in new_captures(T.capture_index(spark, a.index), T.json_table(spark, a.manifest, T.SMK_MANIFEST)).collect()]
    if a.command == "smk-archive":
        known = T.archive_manifest(spark, a.archived) if a.archived else none("sha256 string")
        return [r.asDict() for r in archive.form_versions(T.form_manifest(spark, a.manifest), known, assets(a.assets)).collect()]
    if a.command == "archive":
        known = T.archive_manifest(spark, a.archived) if a.archived else none("date string, sha256 string, population_sha256 string")
        files = spark.read.format("binaryFile").load(a.pdf_dir or f"{a.mirror}/pdfs")
        pops = a.population_dir or f"{a.mirror}/population"
        populations = spark.read.format("binaryFile").load(pops) if T.exists(spark, pops) else None
        entries = archive.mirror_entries(T.mirror_manifest(spark, f"{a.mirror}/manifest.parquet"), files, populations)
        docs, populations, rows = archive.plan(entries, known, assets(a.assets))
        return {"stats": archive.stats(entries, known, docs, populations).first().asDict(), "entries": [r.asDict() for r in rows.collect()]}
    if a.command == "export-md":
        return markdown.export(spark, a.store, a.out, a.cache)
    report = publish.build(spark, a.store, a.out, a.cache, a.pool or None, a.smk_store)
    report.pop("snapshots", None)
    return report


def main() -> None:
    from .session import session

    print(json.dumps(run(sys.argv[1:], session()), ensure_ascii=False, indent=1, default=str))


if __name__ == "__main__":
    main()
