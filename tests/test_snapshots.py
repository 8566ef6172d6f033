"""The snapshot store: tables of all dates under versions, commits as markers."""

import json

import pytest
from pyspark.sql import functions as F

from registra.plans import parse
from registra.schemas import SCHEMAS, WORDS
from registra.sources import sinks
from registra.sources import tables as T

from .test_layout import register_words

MANIFEST = "date string, url string, file_hash string, n_pages int, population_count int, doc_id string"


def words(spark, n):
    rows = [(f"p{k}", *w[1:]) for k in range(n) for w in register_words()]
    return spark.createDataFrame(rows, WORDS)


def manifest(spark, n, h="h"):
    return spark.createDataFrame([(f"2026-01-{k + 1:02d}", "u", f"{h}{k}", 2, k, f"p{k}") for k in range(n)], MANIFEST)


def counts(spark, store):
    return {n: T.snapshots(spark, store, n).count() for n in ("documents", "persons", "sections", "transactions")}


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_dates(spark, tmp_path):
    w = words(spark, 9)
    few = jobs_of(spark, "few", lambda: parse.parse_register(spark, manifest(spark, 2), w, f"{tmp_path}/a"))
    many = jobs_of(spark, "many", lambda: parse.parse_register(spark, manifest(spark, 9), w, f"{tmp_path}/b"))
    assert 0 < few == many
    assert counts(spark, f"{tmp_path}/b") == {"documents": 9, "persons": 18, "sections": 18, "transactions": 9}


def test_replaced_and_unchanged_snapshots(spark, tmp_path):
    store, w = f"{tmp_path}/s", words(spark, 3)
    assert parse.parse_register(spark, manifest(spark, 2), w, store) == ["2026-01-01", "2026-01-02"]
    assert parse.parse_register(spark, manifest(spark, 3), w, store) == ["2026-01-03"]
    before = counts(spark, store)
    new = manifest(spark, 3).withColumn("file_hash", F.when(F.col("date") == "2026-01-02", "new").otherwise(F.col("file_hash")))
    assert parse.parse_register(spark, new, w, store) == ["2026-01-02"]
    assert counts(spark, store) == before and before["documents"] == 3
    meta = {r.date: r for r in T.snapshot_meta(spark, store).collect()}
    assert meta["2026-01-02"].file_hash == "new" and meta["2026-01-03"].population_count == 2 and meta["2026-01-01"].n_persons == 2
    assert T.snapshots(spark, store, "persons", ["name"], "2026-01-02").count() == 2
    assert T.snapshots(spark, store, "documents").schema == SCHEMAS["documents"]
    assert sinks.vacuum_snapshots(spark, store) == 4 and counts(spark, store) == before
    assert sinks.vacuum_snapshots(spark, store) == 0


def test_a_write_cut_short_is_not_seen(spark, tmp_path, monkeypatch):
    store, w = f"{tmp_path}/s", words(spark, 2)
    parse.parse_register(spark, manifest(spark, 1), w, store)
    before = counts(spark, store)
    write = sinks.write_markers

    def cut(*_):
        raise OSError("gone")

    monkeypatch.setattr(sinks, "write_markers", cut)  # all tables are written then
    with pytest.raises(OSError):
        parse.parse_register(spark, manifest(spark, 2, "x"), w, store)
    monkeypatch.setattr(sinks, "write_markers", write)
    assert len(T.listed(spark, f"{store}/documents/version=*")) == 2 and counts(spark, store) == before
    assert parse.parse_register(spark, manifest(spark, 2, "x"), w, store) == ["2026-01-01", "2026-01-02"]
    assert counts(spark, store)["documents"] == 2
    assert sinks.vacuum_snapshots(spark, store) == 12 and counts(spark, store)["documents"] == 2


def test_folders_by_date_are_read_until_replaced(spark, tmp_path):
    for date in ("2026-01-01", "2025-12-31", "2025-01-01"):
        (tmp_path / date).mkdir()
        spark.createDataFrame([(date, "old")], "date string, url string").withColumns({f.name: F.lit(None).cast(f.dataType) for f in SCHEMAS["documents"] if f.name not in ("date", "url")}).write.parquet(f"{tmp_path}/{date}/documents.parquet")
    for date in ("2026-01-01", "2025-12-31"):  # the third has no marker
        (tmp_path / date / "meta.json").write_text(json.dumps({"date": date, "file_hash": "old", "parser_version": "1"}))
    url = lambda: {r.date: r.url for r in T.snapshots(spark, str(tmp_path), "documents").collect()}
    assert url() == {"2026-01-01": "old", "2025-12-31": "old"}
    parse.parse_register(spark, manifest(spark, 1), words(spark, 1), str(tmp_path))
    assert url() == {"2026-01-01": "u", "2025-12-31": "old"}
    assert T.snapshots(spark, str(tmp_path), "documents", ["url"], "2025-12-31").count() == 1


def test_only_the_date_asked_for_is_read(spark, tmp_path):
    store = f"{tmp_path}/s"
    parse.parse_register(spark, manifest(spark, 3), words(spark, 3), store)
    plan = T.snapshots(spark, store, "persons", ["name"], "2026-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot" in plan and "2026-01-02" in plan


def test_form_versions(spark, tmp_path):
    b, rows = "Sans-Bold", []
    for k in range(3):
        d = f"f{k}"
        rows += [(d, 0, 800.0, "Register", 50.0, None, 60.0, "Sans", 11.0), (d, 1, 800.0, f"Name{k}", 50.0, None, 60.0, b, 16.0), (d, 1, 800.0, "Field", 50.0, None, 100.0, b, 11.0), (d, 1, 800.0, f"value{k}", 250.0, None, 100.0, "Sans", 11.0)]
    w = spark.createDataFrame(rows, WORDS)
    m = spark.createDataFrame([("2024-01-01", f"2024010{k}", f"h{k}", 2, f"f{k}") for k in range(3)], "generated string, wayback_ts string, sha256 string, n_pages int, doc_id string")
    store, keys = f"{tmp_path}/s", [f"2024-01-01_2024010{k}" for k in range(3)]
    assert parse.parse_forms(spark, m.limit(1), w, store, "src") == keys[:1]
    assert parse.parse_forms(spark, m, w, store, "src") == keys[1:]
    assert parse.parse_forms(spark, m, w, store, "src") == []
    assert sorted(r.name for r in T.snapshots(spark, store, "smk_persons").collect()) == ["Name0", "Name1", "Name2"]
    assert [r.value for r in T.snapshots(spark, store, "smk_fields", date=keys[1]).collect()] == ["value1"]
    assert T.snapshots(spark, store, "smk_documents").schema == SCHEMAS["smk_documents"] and T.snapshots(spark, store, "smk_documents").count() == 3
