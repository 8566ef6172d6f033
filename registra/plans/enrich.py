"""Filling the derived layer: blocks that the cache lacks are put to an extractor in batches.

An *extractor* is a function of one batch, a list of dicts (id, block_hash, paragraf, label, text). It
gives a dict of id -> items, or a ``Refusal``. It runs in a task, not on the driver.

A run is a stream over the batches of a plan. The plan, the pending blocks ranked into batches, is written
once; the stream's offset counts the batches that are done. Each trigger asks for one batch, writes what
came of it, appends the answers to the cache as a run of the batch's own number and then commits the
offset. A run that is cut short at any point has lost nothing that was answered: the next call finds the
plan and goes on at its offset; a batch whose outcome was written is not asked again, and its append
replaces itself. An error of any kind in the extractor fails its batch only: the blocks stay pending for
a later plan. A refusal ends the run, and its plan with it. One run at a time may use a cache."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import items as I
from ..schemas import CACHE
from ..sources import sinks, tables
from ..streaming.requests import RequestBatches

PROMPT_VERSION = "v1"
LONGEST_WAIT = 90.0
FIELDS = ("block_hash", "paragraf", "label", "text")
_OUTCOME = f"block_hash string, items {CACHE['items'].dataType.simpleString()}, state string"
_PLAN = "batches int, first_run bigint"


class Refusal(NamedTuple):
    """The extractor's word for "not now"; ``wait`` in seconds, where the service names a time."""

    wait: float | None = None


class Pace(NamedTuple):
    """Seconds between the starts of two requests, and how to wait."""

    interval: float = 4.5
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic


def settle(batch: list[dict], extract: Callable, pace: Pace = Pace()) -> tuple[str, list]:
    """(state, items of each block or None) of one batch: a refusal of a bearable length is waited out
    once; whatever the extractor raises or however it misshapes its answer, the batch has failed."""
    nothing = [None] * len(batch)
    try:
        answer = extract(batch)
        if isinstance(answer, Refusal) and answer.wait is not None and answer.wait <= LONGEST_WAIT:
            pace.sleep(answer.wait + 1)
            answer = extract(batch)
        if isinstance(answer, Refusal):
            return "stopped", nothing
        told = [answer.get(b["id"]) for b in batch]
        return "answered", [None if t is None else [{k: None if v is None else str(v) for k, v in i.items()} for i in t] for t in told]
    except Exception:  # noqa: BLE001 - the extractor is not ours
        return "failed", nothing


def outcomes(work: DataFrame, extract: Callable, pace: Pace = Pace()) -> DataFrame:
    """One row per block of one batch (``work`` has place and the block's columns): state is resolved or
    failed, or stopped for all where the batch was refused."""

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        rows = sorted((r for f in frames for r in f.to_dict("records")), key=lambda r: r["place"])
        if rows:
            state, told = settle([{"id": k, **{c: r[c] for c in FIELDS}} for k, r in enumerate(rows)], extract, pace)
            yield pd.DataFrame({"block_hash": [r["block_hash"] for r in rows], "items": told, "state": ["stopped" if state == "stopped" else "failed" if t is None else "resolved" for t in told]})

    return work.select("place", *FIELDS).coalesce(1).mapInPandas(run, _OUTCOME)


def blank_records(blocks: DataFrame, cache: DataFrame) -> DataFrame:
    """Records for unknown blocks without text: no items, by no model."""
    new = blocks.where(~S.non_empty("text")).select("block_hash").distinct().join(cache.select("block_hash"), "block_hash", "left_anti")
    return new.select("block_hash", F.array().cast(CACHE["items"].dataType).alias("items"), F.lit("none").alias("model"), F.lit(PROMPT_VERSION).alias("prompt_version"))


def _open_plan(spark: SparkSession, state: str):
    """(batches, first_run) of a plan that a run before left unfinished."""
    return tables.json_table(spark, f"{state}/plan.json", _PLAN).first()


def _make_plan(todo: DataFrame, blank: DataFrame, batches: int, state: str, cache_dir: str, order: tuple[str, ...], batch_size: int):
    spark = todo.sparkSession
    sinks.remove(spark, state)
    first = tables.last_run(spark, cache_dir) + 1
    work = I.batches(todo, order, batch_size, batches)
    work = work.withColumn("place", F.row_number().over(Window.partitionBy("batch_id").orderBy(*order)))
    work.select("batch_id", "place", *FIELDS).write.partitionBy("batch_id").parquet(f"{state}/work")
    sinks.append_cache(blank, cache_dir, first)
    sinks.write_text(spark, f"{state}/plan.json", f'[{{"batches": {batches}, "first_run": {first}}}]')
    return _open_plan(spark, state)


def enrich(spark: SparkSession, blocks: DataFrame, cache_dir: str, extract: Callable, model: str, order: tuple[str, ...], max_requests: int = 120, batch_size: int = 6, pace: Pace = Pace()) -> dict:
    """``blocks`` has block_hash, paragraf, label, text and the columns of ``order``. Appends what the
    extractor gives to the cache, batch by batch, and gives the run's statistics; an unfinished plan is
    finished first, and then its batches alone are this run's."""
    state = f"{cache_dir}/_enrich"
    known = tables.cache_latest(spark, cache_dir).select("block_hash")
    todo = I.pending(I.distinct_blocks(blocks, order), known)
    blank = blank_records(blocks, known)
    counted = known.agg(F.lit("cached").alias("name"), F.count("*").alias("n")).union(blank.agg(F.lit("blank"), F.count("*"))).union(todo.agg(F.lit("pending"), F.count("*")))
    n = Counter({r["name"]: r["n"] for r in counted.collect()})
    batches = min(max_requests, -(-n["pending"] // batch_size))
    plan = _open_plan(spark, state)
    if plan is None and batches + n["blank"]:
        plan = _make_plan(todo, blank, batches, state, cache_dir, order, batch_size)
    told: Counter = Counter()
    if plan is not None:
        _work_off(spark, state, plan, cache_dir, extract, model, pace, told)
    left = n["pending"] > told["resolved"] + told["failed"]
    stopped = "rate_limited" if told["stopped"] else "max_requests" if left else None
    return {"cached": n["cached"] + n["blank"], "pending": n["pending"], "requests": told["requests"], "resolved": told["resolved"], "failed": told["failed"], "stopped": stopped}


def _work_off(spark: SparkSession, state: str, plan, cache_dir: str, extract: Callable, model: str, pace: Pace, told: Counter) -> None:
    """Every batch of the plan from the stream's offset on; the plan goes when all are done."""
    work_schema = "place int, block_hash string, paragraf string, label string, text string, batch_id int"
    begun: list[float] = []

    def one(number: int) -> None:
        out = f"{state}/outcomes/batch={number}"
        if not tables.exists(spark, f"{out}/_SUCCESS"):
            if begun:
                pace.sleep(max(0.0, pace.interval - (pace.clock() - begun[-1])))
            begun[:] = [pace.clock()]
            work = spark.read.schema(work_schema).parquet(f"{state}/work").where(F.col("batch_id") == number)
            outcomes(work, extract, pace).write.mode("overwrite").parquet(out)
        done = spark.read.schema(_OUTCOME).parquet(out)
        n = {r["state"]: r["count"] for r in done.groupBy("state").count().collect()}
        if "stopped" in n:
            told["stopped"] += 1
            raise RuntimeError("the extractor refused")
        told.update(n, requests=1)
        got = done.where("state = 'resolved'").select("block_hash", "items", F.lit(model).alias("model"), F.lit(PROMPT_VERSION).alias("prompt_version"))
        sinks.append_cache(got, cache_dir, plan["first_run"] + 1 + number)

    def each(rows: DataFrame, epoch: int) -> None:
        for r in rows.collect():  # one number
            one(r["batch_id"])

    spark.dataSource.register(RequestBatches)
    stream = spark.readStream.format("request_batches").option("batches", plan["batches"]).load()
    q = stream.writeStream.option("checkpointLocation", f"{state}/checkpoint").foreachBatch(each).start()
    try:
        q.processAllAvailable()
    except StreamingQueryException:
        if not told["stopped"]:
            raise
    finally:
        q.stop()
    sinks.remove(spark, state)
