"""The register layout's line rules as window passes, and the tables they give.

The rules read like a state machine, but every decision depends only on a running count or on the
last line of some kind, so six windows over a document's lines decide all of them."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import conform
from .lines import BODY_SIZE, body_words, cells, group_lines, map_row, ordered, register_split

# Fixed values of the printed layout.
PARSER_VERSION = "1.2.0"
LEFT_X0 = 110.0
HEADING_SIZE = 13.0
GRID_SIZE = 10.4

NONE = "cast(null as string)"


def classify(lines: DataFrame, split: DataFrame) -> DataFrame:
    """Every line with its ``rule`` (R1 .. R11, remainder) and the ids of what it belongs to."""
    w = ordered(lines)
    n_words = F.size("words")
    nxt = {c: F.lead(c).over(w) for c in ("bold", "size", "x0")}
    left_edge = F.col("x0") <= LEFT_X0
    big = (F.col("size") >= HEADING_SIZE) & (n_words <= 2)
    lone = F.col("bold") & (F.col("size") >= BODY_SIZE) & (n_words == 1) & ~F.col("text").contains(",") & ~F.col("text").contains("(")
    next_bold = F.coalesce(nxt["bold"] & (nxt["size"] >= BODY_SIZE) & (nxt["x0"] <= LEFT_X0), F.lit(False))
    x = lines.withColumn("r1", (F.col("page") >= 1) & left_edge & next_bold & (big | lone))
    x = x.withColumn("heading_id", F.sum(F.col("r1").cast("int")).over(w)).withColumn("heading", F.last(F.when(F.col("r1"), F.col("text")), ignorenulls=True).over(w))
    inside = (F.col("heading_id") > 0) & ~F.col("r1")
    x = x.withColumn("r4", inside & F.col("bold") & left_edge & (F.col("size") >= BODY_SIZE))
    h = Window.partitionBy("doc_id", "heading_id").orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("has_person", F.coalesce(F.max(F.col("r4")).over(h), F.lit(False)))
    x = x.withColumn("r3", inside & (F.col("size") <= GRID_SIZE) & F.col("has_person"))
    # a header goes on while the last line that is no grid row was a header line without a closing bracket
    open_line = F.when(~F.col("r3"), F.col("r4") & ~F.col("text").contains(")"))
    goes_on = F.col("r4") & F.coalesce(F.last(open_line, ignorenulls=True).over(h), F.lit(False))
    x = x.withColumn("new_person", F.col("r4") & ~goes_on)
    x = x.withColumn("person_id", F.sum(F.col("new_person").cast("int")).over(w))
    x = x.join(split, "doc_id").withColumn("cols", S.columns_at("words", "split"))
    text_of = lambda c: F.transform(F.col(c), lambda t: t["text"])
    x = x.withColumn("left", text_of("cols.left")).withColumn("right", text_of("cols.right")).drop("cols", "split")
    body = inside & ~F.col("r3") & ~F.col("r4") & F.col("has_person")
    x = x.withColumn("r7", body & S.is_marker(F.get("left", F.lit(0))))
    p = Window.partitionBy("doc_id", "person_id").orderBy("page", "line_no")
    x = x.withColumn("consumed", F.when(F.col("r7"), S.consume_marker("left")))
    x = x.withColumn("section_id", F.sum((F.col("r7") & F.col("has_person")).cast("int")).over(p))
    x = x.withColumn("marker", F.last("consumed.marker", ignorenulls=True).over(p))
    x = x.withColumn("grid_head", F.col("r3") & F.col("bold")).withColumn("table_id", F.sum(F.col("grid_head").cast("int")).over(p))
    s = Window.partitionBy("doc_id", "person_id", "section_id").orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("has_content", F.coalesce(F.max(F.when(body, F.size("right") > 0)).over(s), F.lit(False)))
    lonely_left = (F.size("left") > 0) & (F.size("right") == 0)
    rule = (
        F.when(F.col("r1"), "R1").when(F.col("heading_id") == 0, F.when(F.col("page") == 0, "R2 cover").otherwise("R2 preamble"))
        .when(F.col("r3"), F.when(F.col("bold"), "R3 head").when(F.col("table_id") > 0, "R3 row").otherwise("remainder"))
        .when(F.col("r4"), F.when(F.col("new_person"), "R4 new").otherwise("R4 more")).when(~F.col("has_person"), "remainder").when(F.col("r7"), "R7")
        .when((F.col("section_id") > 0) & lonely_left & ~F.col("has_content"), "R8").when(F.col("section_id") == 0, "R9")
        .when((F.size("right") > 0) & (F.size("left") == 0), "R10").otherwise("R11")
    )
    return x.withColumn("rule", rule).drop("r1", "r3", "r4", "r7", "grid_head", "new_person", "has_content", "has_person")


class RegisterTables(NamedTuple):
    documents: DataFrame
    persons: DataFrame
    sections: DataFrame
    transactions: DataFrame


def _joined(value, when, sep: str):
    """Texts of a group in document order, joined."""
    at = F.struct("page", "line_no", value.alias("v"))
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(when, at))), lambda e: e["v"]), sep)


def _rows(classified: DataFrame) -> DataFrame:
    p = Window.partitionBy("doc_id", "person_id").orderBy("page", "line_no")
    grid = classified.withColumn("cells", F.when(F.col("rule").startswith("R3"), cells(F.col("words"))))
    grid = grid.withColumn("headers", F.last(F.when(F.col("rule") == "R3 head", F.col("cells")), ignorenulls=True).over(p))
    grid = grid.withColumn("table_marker", F.last(F.when(F.col("rule") == "R3 head", F.when(F.col("section_id") > 0, F.col("marker")).otherwise("")), ignorenulls=True).over(p))
    t = Window.partitionBy("doc_id", "person_id", "table_id").orderBy("page", "line_no")
    rows = grid.where(F.col("rule") == "R3 row").withColumn("row_index", F.row_number().over(t))
    names = F.transform("headers", lambda h: h["text"])
    return rows.select("doc_id", "person_id", "table_id", "table_marker", "row_index", S.zip_json(names, map_row(F.col("cells"), F.col("headers"))).alias("cells_json"))


def tables(classified: DataFrame, split: DataFrame, meta: DataFrame) -> RegisterTables:
    """The four published tables. ``meta`` has doc_id, date, url, file_hash, n_pages."""
    c = classified
    of_person = c.where((F.col("person_id") > 0) & F.col("rule").isin("R4 new", "R4 more", "R7", "R8", "R9", "R10", "R11", "R3 row"))
    heads = of_person.groupBy("doc_id", "person_id").agg(
        _joined(F.col("text"), F.col("rule").startswith("R4"), " ").alias("person_header"), F.min_by("heading", F.struct("page", "line_no")).alias("section_heading"),
        _joined(F.col("text"), F.col("rule") == "R9", "\n").alias("note"), F.sum((F.col("rule") == "R7").cast("int")).alias("n_sections"), F.sum((F.col("rule") == "R3 row").cast("int")).alias("n_transaction_rows"),
    )
    heads = heads.join(meta.select("doc_id", "date"), "doc_id")
    carved = S.header_carve("person_header")
    persons = heads.select("doc_id", "date", F.col("person_id").alias("person_index"), "section_heading", "person_header", carved["name"].alias("name"), carved["party"].alias("party"), carved["constituency"].alias("constituency"), F.nullif("note", F.lit("")).alias("note"), "n_sections", "n_transaction_rows")
    sec = c.where((F.col("section_id") > 0) & F.col("rule").isin("R7", "R8", "R10", "R11"))
    right, left = F.array_join("right", " "), F.array_join("left", " ")
    label = F.when(F.col("rule") == "R7", F.array_join("consumed.rest", " ")).when(F.col("rule") == "R8", left)
    content = F.when(F.col("rule").isin("R7", "R10"), F.when(F.size("right") > 0, right)).when(F.col("rule") == "R11", F.col("text"))
    sec = sec.groupBy("doc_id", "person_id", "section_id").agg(
        F.first("marker").alias("paragraf"), _joined(label, F.coalesce(label != "", F.lit(False)), " ").alias("label"), _joined(content, content.isNotNull(), "\n").alias("text"), F.count(content).cast("int").alias("n_lines"),
    )
    sections = sec.join(persons.select("doc_id", F.col("person_index").alias("person_id"), "date", "person_header", "section_heading"), ["doc_id", "person_id"]).select(
        "date", F.col("person_id").alias("person_index"), "person_header", "section_heading", "paragraf", "label", "text", "n_lines", F.col("section_id").alias("section_order"), S.block_hash("paragraf", "label", "text").alias("block_hash"))
    tx = _rows(c).join(persons.select("doc_id", F.col("person_index").alias("person_id"), "date", "person_header"), ["doc_id", "person_id"])
    transactions = tx.select("date", F.col("person_id").alias("person_index"), "person_header", F.col("table_marker").alias("paragraf"), "row_index", "cells_json")
    left_over = c.groupBy("doc_id").agg(
        _joined(F.col("text"), F.col("rule") == "R2 cover", "\n").alias("cover_text"), _joined(F.col("text"), F.col("rule") == "R2 preamble", "\n").alias("reglement_text"),
        F.array_sort(F.collect_list(F.when(F.col("rule") == "remainder", F.struct("page", "line_no", "top", "text")))).alias("rest"), F.coalesce(F.max("person_id"), F.lit(0)).alias("n_persons"))
    docs = meta.join(left_over, "doc_id", "left").join(split, "doc_id", "left").select(
        "date", "url", "file_hash", "n_pages", F.coalesce("n_persons", F.lit(0)).alias("n_persons"), F.coalesce("cover_text", F.lit("")).alias("cover_text"), F.coalesce("reglement_text", F.lit("")).alias("reglement_text"),
        F.coalesce("split", F.lit(205.0)).alias("column_split"), F.coalesce(F.size("rest"), F.lit(0)).alias("n_remainder_lines"), F.coalesce(S.remainder_json("rest"), F.lit("[]")).alias("remainder_json"), F.lit(PARSER_VERSION).alias("parser_version"))
    return RegisterTables(conform(docs, "documents"), conform(persons, "persons"), conform(sections, "sections"), conform(transactions, "transactions"))


def parse(words: DataFrame, meta: DataFrame) -> RegisterTables:
    lines = group_lines(body_words(words, "register"))
    split = register_split(lines)
    return tables(classify(lines, split), split, meta)
