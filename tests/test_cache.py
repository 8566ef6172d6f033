"""The item cache: order over split files, compaction; recoverable enrichment."""

import json
import os

import pytest
from pyspark.sql import functions as F

from registra.operators import items as I
from registra.plans import enrich
from registra.schemas import CACHE
from registra.sources import sinks
from registra.sources import tables as T

NOW = enrich.Pace(0.0, lambda s: None)


def append(spark, cache, model, *hashes, run=None):
    sinks.append_cache(spark.createDataFrame([(h, [], model, "v1") for h in hashes], CACHE), cache, run)


def models(df):
    return {r.block_hash: r.model for r in df.collect()}


def test_split_shard_reads_in_order(spark, tmp_path):
    rows = [{"block_hash": f"aa{k % 7}", "items": [], "model": f"m{k:05d}", "prompt_version": "x" * 60} for k in range(3000)]
    (tmp_path / "aa.jsonl").write_text("\n\n".join(map(json.dumps, rows)) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        r = T.cache_records(spark, str(tmp_path))
        assert r.select("line.block").distinct().count() > 5 and r.count() == 3000
        assert [x.model for x in r.orderBy("file", "line").collect()] == [x["model"] for x in rows]
        assert models(I.latest_records(r)) == {f"aa{k}": max(x["model"] for x in rows if x["block_hash"] == f"aa{k}") for k in range(7)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_compaction(spark, tmp_path):
    c = str(tmp_path)
    (tmp_path / "aa.jsonl").write_text(json.dumps({"block_hash": "aa0", "items": [], "model": "shard", "prompt_version": "v"}) + "\n" + json.dumps({"block_hash": "aa1", "items": [], "model": "shard", "prompt_version": "v"}) + "\n")
    assert T.generation(spark, c) is None and T.last_run(spark, c) == 0
    append(spark, c, "one", "aa1", "bb1", "cc1")
    append(spark, c, "two", "bb1", "dd1")
    want = {"aa0": "shard", "aa1": "one", "bb1": "two", "cc1": "one", "dd1": "two"}
    assert models(T.cache_latest(spark, c)) == want
    assert sinks.compact_cache(spark, c, 4) == 1
    assert models(T.cache_latest(spark, c)) == want and T.last_run(spark, c) == 2
    sinks.vacuum_cache(spark, c)
    assert not T.exists(spark, f"{c}/run=*") and models(T.cache_latest(spark, c)) == want
    append(spark, c, "three", "aa0", "cc1", "ee1")
    assert [p.rpartition("=")[2] for p in T.listed(spark, f"{c}/run=*")] == ["000000000003"]
    want |= {"aa0": "three", "cc1": "three", "ee1": "three"}
    assert models(T.cache_latest(spark, c)) == want
    assert sinks.compact_cache(spark, c, 4) == 2
    sinks.vacuum_cache(spark, c)
    assert models(T.cache_latest(spark, c)) == want and len(T.listed(spark, f"{c}/compact/*")) == 2


def test_unfinished_compaction_is_not_seen(spark, tmp_path):
    c = str(tmp_path)
    append(spark, c, "one", "aa1")
    (tmp_path / "compact" / "generation=000001-cut").mkdir(parents=True)
    (tmp_path / "compact" / "generation=000001-cut" / "part-0.parquet").write_text("half a file")
    assert models(T.cache_latest(spark, c)) == {"aa1": "one"}
    sinks.compact_cache(spark, c, 2)
    sinks.vacuum_cache(spark, c)
    assert models(T.cache_latest(spark, c)) == {"aa1": "one"} and len(T.listed(spark, f"{c}/compact/*")) == 2


def test_join_with_compacted_cache_shuffles_one_side(spark, tmp_path):
    c = str(tmp_path)
    append(spark, c, "one", *(f"{k:02x}" for k in range(200)))
    sinks.compact_cache(spark, c, 4)
    sections = spark.range(200).select(F.lpad(F.hex("id"), 2, "0").alias("block_hash"))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = sections.join(T.cache_latest(spark, c), "block_hash")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan


def test_run_replaces_itself(spark, tmp_path):
    c = str(tmp_path)
    append(spark, c, "one", "aa1", "bb1", run=4)
    append(spark, c, "two", "aa1", run=4)
    assert models(T.cache_latest(spark, c)) == {"aa1": "two"} and T.last_run(spark, c) == 4


def blocks(spark, n):
    return spark.createDataFrame([(f"{i:02d}", i, "§", "l", "" if i == n else f"t{i}") for i in range(n + 1)], "block_hash string, k int, paragraf string, label string, text string")


@pytest.mark.parametrize("fault", ["dies", "append"])
def test_a_run_that_is_cut_short_goes_on(spark, tmp_path, monkeypatch, fault):
    """The fourth of six batches ends the run, in the task or while its answers are appended."""
    c, log = f"{tmp_path}/c", tmp_path / "log"

    def extract(batch):
        with open(log, "a") as f:
            f.write(" ".join(b["block_hash"] for b in batch) + "\n")
        if fault == "dies" and len(log.read_text().splitlines()) == 4:
            os._exit(3)
        return {b["id"]: [{"item_text": b["text"]}] for b in batch}

    put = sinks.append_cache

    def breaks(records, cache, run=None):
        if fault == "append" and run == 1 + 1 + 3:
            raise OSError("full")
        put(records, cache, run)

    monkeypatch.setattr(sinks, "append_cache", breaks)
    with pytest.raises(Exception):
        enrich.enrich(spark, blocks(spark, 12), c, extract, "m", ("k",), batch_size=2, pace=NOW)
    assert sorted(models(T.cache_latest(spark, c))) == ["00", "01", "02", "03", "04", "05", "12"]
    monkeypatch.setattr(sinks, "append_cache", put)
    s = enrich.enrich(spark, blocks(spark, 12), c, extract, "m", ("k",), batch_size=2, pace=NOW)
    assert s == {"cached": 7, "pending": 6, "requests": 3, "resolved": 6, "failed": 0, "stopped": None}
    asked = log.read_text().splitlines()
    assert asked[:4] == ["00 01", "02 03", "04 05", "06 07"]
    # an outcome that was written is not asked for again
    assert asked[4:] == (["06 07", "08 09", "10 11"] if fault == "dies" else ["08 09", "10 11"])
    assert len(models(T.cache_latest(spark, c))) == 13 and not T.exists(spark, f"{c}/_enrich")


@pytest.mark.parametrize("error", [RuntimeError("x"), TypeError("x"), AttributeError("x"), ZeroDivisionError("x"), AssertionError("x")])
def test_any_error_fails_its_batch_only(error):
    def extract(batch):
        raise error

    assert enrich.settle([{"id": 0}], extract, NOW) == ("failed", [None])


def test_misshapen_answers_fail_the_batch():
    for answer in (None, [], {0: 5}, {0: ["x"]}, {0: {"a": 1}}):
        assert enrich.settle([{"id": 0}], lambda b, a=answer: a, NOW) == ("failed", [None])
    assert enrich.settle([{"id": 0}, {"id": 1}], lambda b: {1: [{"a": 2, "b": None}]}, NOW) == ("answered", [None, [{"a": "2", "b": None}]])
    assert enrich.settle([{"id": 0}], lambda b: enrich.Refusal(), NOW) == ("stopped", [None])
