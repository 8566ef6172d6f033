"""The publish job: concatenated tables, items, roster, quality report."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import items as I
from ..operators.resolve import resolve
from ..sources import sinks, tables

REGISTER = ("documents", "persons", "sections", "transactions")
FORM = ("smk_documents", "smk_persons", "smk_fields")


def combine(spark: SparkSession, store: str, cache: str, pool: str | None = None, form_store: str | None = None) -> dict[str, DataFrame]:
    """All published tables as lazy plans; the cache is read once."""
    out = {n: tables.snapshots(spark, store, n) for n in REGISTER}
    out["items"] = I.build_items(out["sections"], tables.cache_latest(spark, cache))
    if pool and tables.exists(spark, pool):
        out["roster"] = resolve(out["persons"], tables.reference_pool(spark, pool))
    if form_store and tables.exists(spark, form_store):
        out |= {n: tables.snapshots(spark, form_store, n) for n in FORM}
    return out


def row_counts(combined: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in combined.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def quality_report(seen: dict[str, dict], sections: DataFrame, meta: DataFrame, cache: DataFrame) -> DataFrame:
    """One row: counts, date range, coverage and identity rates, and a map of the snapshots.

    ``seen`` has what was observed of every published table: its ``rows``, and of the roster those ``born``."""
    rows = F.map_from_arrays(F.lit(sorted(seen)), F.lit([seen[n]["rows"] for n in sorted(seen)]))
    roster, forms = seen.get("roster"), seen.get("smk_documents")
    rate = round(roster["born"] / roster["rows"], 4) if roster and roster["rows"] else None
    dates = meta.agg(
        F.count_distinct("date").alias("n_snapshots"), F.when(F.count("*") > 0, F.array(F.min("date"), F.max("date"))).alias("date_range"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("date", F.struct("n_persons", "population_count", "n_remainder_lines"))))).alias("snapshots"))
    one = dates.join(F.broadcast(I.coverage(sections, cache)), F.lit(True))  # each is one row
    told = one.withColumns({"rows": rows, "smk_versions": F.lit(forms and forms["rows"]).cast("long"), "roster_dob_rate": F.lit(rate).cast("double")})
    return told.select("n_snapshots", "date_range", "rows", "sections_nonempty", "sections_enriched_unique_blocks", "smk_versions", "roster_dob_rate", "enrichment_coverage", "snapshots")


def build(spark: SparkSession, store: str, out: str, cache: str, pool: str | None = None, form_store: str | None = None) -> dict:
    """Publishes every table in three formats and the quality report; gives the report. Tables are counted
    while they are written; what was published is not read."""
    combined = combine(spark, store, cache, pool, form_store)
    metrics = {"roster": {"born": F.count_if(F.coalesce(F.col("foedselsdato") != "", F.lit(False)))}}
    seen = {name: sinks.publish(df, out, name, **metrics.get(name, {})) for name, df in combined.items()}
    report = quality_report(seen, combined["sections"], tables.snapshot_meta(spark, store), tables.cache_latest(spark, cache))
    text = report.select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"})).first()[0]
    sinks.write_text(spark, f"{out}/qa_report.json", text)
    return json.loads(text)
