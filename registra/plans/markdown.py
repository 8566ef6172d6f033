"""Markdown export of the latest snapshot: five tables and an index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import items as I
from ..sources import sinks, tables

ITEM_COLUMNS = ["item_text", "organisation", "role", "remuneration", "amount_nok", "share_pct", "share_count", "org_number", "date_from", "date_to", "country"]


def dynamic_columns(transactions: DataFrame) -> DataFrame:
    """(key, first): the headers that occur, by first place in document order."""
    at = F.struct("person_index", "paragraf", "row_index")
    keys = transactions.select(at.alias("at"), F.posexplode(F.json_object_keys("cells_json")).alias("k", "key"))
    return keys.groupBy("key").agg(F.min(F.struct("at", "k")).alias("first"))


def headers(transactions: DataFrame) -> DataFrame:
    """One row: all printed headers in order; those of one snapshot are few."""
    order = F.array_sort(F.collect_list(F.struct("first", "key")))
    return dynamic_columns(transactions).agg(F.transform(order, lambda h: h["key"]).alias("headers"))


def pivot_cells(transactions: DataFrame) -> DataFrame:
    """Transactions with their cells in the order of all headers; null where a row has no such cell. The
    headers meet the rows as a row of their own and do not pass through the driver."""
    x = transactions.withColumn("v", F.try_parse_json("cells_json")).join(F.broadcast(headers(transactions)), F.lit(True))
    return x.withColumn("cells", F.transform("headers", lambda h: S.variant_cell("v", h))).drop("v", "headers")


def cell_types(transactions: DataFrame) -> DataFrame:
    """(key, n, type): of every header its number of cells and the type that holds all their values, VOID
    where all are null and VARIANT where they have none in common."""
    x = transactions.select(F.try_parse_json("cells_json").alias("v"), F.explode(F.json_object_keys("cells_json")).alias("key"))
    return x.groupBy("key").agg(F.count("*").alias("n"), F.schema_of_variant_agg(S.variant_cell("v", F.col("key"), "variant")).alias("type"))


def document_rows(docs: DataFrame, meta: DataFrame, releases: str) -> DataFrame:
    m = meta.select("date", "n_persons", "population_count", "n_remainder_lines")
    x = docs.select("date", "url", "n_pages").join(m, "date")
    link = F.concat(F.lit("["), "date", F.lit("]("), "url", F.lit(")"))
    return x.select(F.col("date").alias("_date"), link.alias("date"), F.concat(F.lit(f"[pdf]({releases}/pr-"), F.col("date"), F.lit(".pdf)")).alias("archived"), F.col("n_pages").alias("pages"), F.col("n_persons").alias("persons parsed"), F.col("population_count").alias("population roster"), F.col("n_remainder_lines").alias("remainder lines"))


def export(spark: SparkSession, store: str, out: str, cache: str, releases: str = "../releases") -> dict:
    meta = tables.snapshot_meta(spark, store)
    date = meta.agg(F.max("date")).first()[0]
    if date is None:
        raise IndexError("the store has no snapshot")
    snap = lambda name: tables.snapshots(spark, store, name, date=date)
    written = 0

    def put(file: str, title: str, rows: DataFrame, columns: list[str], order: tuple[str, ...], more: DataFrame | None = None) -> None:
        nonlocal written
        sinks.write_text(spark, f"{out}/{file}", f"# {title}\n\n" + sinks.md_table(rows, columns, order, more).first()[0] + "\n")
        written += 1

    docs = document_rows(tables.snapshots(spark, store, "documents"), meta, releases).withColumn("_new", -F.unix_date(F.col("_date").try_cast("date")))
    put("documents.md", "Publications", docs, ["date", "archived", "pages", "persons parsed", "population roster", "remainder lines"], ("_new", "_date"))
    people = snap("persons").select("person_index", F.col("person_index").alias("idx"), F.col("section_heading").alias("section"), "name", "party", "constituency", "note", F.col("n_sections").alias("sections"), F.col("n_transaction_rows").alias("tx rows"))
    put("persons.md", f"Persons, snapshot {date}", people, ["idx", "section", "name", "party", "constituency", "note", "sections", "tx rows"], ("person_index",))
    sections = snap("sections")
    put("sections.md", f"Registered interests, snapshot {date}", sections.select("person_index", "section_order", F.col("person_index").alias("idx"), F.col("person_header").alias("person"), F.col("paragraf").alias("§"), "label", "text"), ["idx", "person", "§", "label", "text"], ("person_index", "section_order"))
    tx = snap("transactions")
    put("transactions.md", f"Share transactions, snapshot {date}", pivot_cells(tx).withColumnsRenamed({"person_header": "person", "paragraf": "§"}), ["person", "§"], ("person_index", "row_index"), headers(tx))
    memo = tables.cache_latest(spark, cache)
    full = sections.where(S.non_empty("text"))
    items = I.build_items(full, memo).join(full.select("person_index", "block_hash", "section_order").distinct(), ["person_index", "block_hash"])
    cover = I.coverage(sections, memo).first()
    put("items.md", f"Derived items, snapshot {date} (coverage {cover['sections_covered']}/{cover['sections_nonempty']} blocks: {cover['enrichment_coverage']})", items.withColumnsRenamed({"person_header": "person", "paragraf": "§"}), ["person", "§", *ITEM_COLUMNS], ("person_index", "section_order", "item_index"))
    sinks.write_text(spark, f"{out}/README.md", f"# Snapshot {date} as markdown\n\n" + "".join(f"- [{f}.md]({f}.md)\n" for f in ("documents", "persons", "sections", "transactions", "items")))
    return {"date": date, "files": written + 1, "sections": sections.count(), "items": items.count()}
