"""The form layout's line rules (S1 .. S6) as window passes, and its three tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import conform
from .lines import body_words, form_split, group_lines
from .register_layout import _joined

# Fixed values of the printed form.
PARSER_VERSION = "1.0.0"
NAME_SIZE = 14.0
FIELD_GAP = 20.0


def classify(lines: DataFrame, split: DataFrame) -> DataFrame:
    """Body lines (page 1 on) with their rule and the ids of person and field."""
    page = Window.partitionBy("doc_id", "page").orderBy("line_no")
    x = lines.where("page >= 1").join(split, "doc_id").withColumn("cols", S.columns_at("words", "split"))
    before = F.lag("top").over(page)
    # a top of exactly 0 counts as no top, as printed forms never have one
    x = x.withColumn("gap", F.when(before.isNotNull(), F.col("top") - F.when(before == 0, F.col("top")).otherwise(before)))
    text_of = lambda c: F.transform(F.col(c), lambda t: t["text"])
    bold_left = (F.size("cols.left") > 0) & F.forall("cols.left", lambda t: t["bold"])
    x = x.withColumn("left_bold", bold_left).withColumn("left", text_of("cols.left")).withColumn("right", text_of("cols.right"))
    x = x.withColumn("right_bold", (F.size("cols.right") > 0) & F.forall("cols.right", lambda t: t["bold"])).withColumn("plain_left", ~F.exists("cols.left", lambda t: t["bold"]))
    x = x.withColumn("s1", F.col("bold") & (F.get("words", F.lit(0))["size"] >= NAME_SIZE)).drop("cols")
    d = Window.partitionBy("doc_id").orderBy("page", "line_no")
    x = x.withColumn("person_id", F.sum(F.col("s1").cast("int")).over(d))
    p = Window.partitionBy("doc_id", "person_id").orderBy("page", "line_no")
    earlier = p.rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("has_field", F.coalesce(F.max(F.col("left_bold") & ~F.col("s1")).over(earlier), F.lit(False)))
    x = x.withColumn("like_s3", ~F.col("s1") & ~F.col("has_field") & (F.size("left") > 0) & (F.size("right") == 0) & F.col("plain_left") & F.col("text").startswith("("))
    x = x.withColumn("s3", F.col("like_s3") & ~F.coalesce(F.max("like_s3").over(earlier), F.lit(False)))
    x = x.withColumn("s4", ~F.col("s1") & F.col("left_bold") & (F.col("gap").isNull() | (F.col("gap") > FIELD_GAP) | ~F.col("has_field")))
    x = x.withColumn("field_id", F.sum(F.col("s4").cast("int")).over(p))
    rule = (
        F.when(F.col("s1"), "S1").when(F.col("person_id") == 0, "remainder").when(F.col("s3"), "S3").when(F.col("s4"), F.when(F.col("right_bold"), "S4 header").otherwise("S4"))
        .when(~F.col("has_field"), "remainder").when(~F.col("left_bold") & (F.size("left") > 0), "remainder").otherwise("S5")
    )
    return x.withColumn("rule", rule).drop("s1", "s3", "s4", "like_s3", "plain_left", "has_field")


class FormTables(NamedTuple):
    smk_documents: DataFrame
    smk_persons: DataFrame
    smk_fields: DataFrame


def tables(lines: DataFrame, classified: DataFrame, meta: DataFrame, *keys: str) -> FormTables:
    """``meta`` has doc_id, wayback_ts, source_url, wayback_url, file_hash, n_pages and perhaps generated;
    its columns ``keys`` ride along in all three tables."""
    c = classified
    cover = lines.where("page = 0").groupBy("doc_id").agg(_joined(F.col("text"), F.lit(True), "\n").alias("cover_text"))
    m = meta.join(cover, "doc_id", "left").withColumn("cover_text", F.coalesce("cover_text", F.lit("")))
    given = F.col("generated") if "generated" in meta.columns else F.lit(None)
    m = m.withColumn("version", F.coalesce(given, S.generated_date("cover_text"), F.substring("wayback_ts", 1, 8)))
    people = c.where("person_id > 0").groupBy("doc_id", "person_id").agg(
        F.max(F.when(F.col("rule") == "S1", F.col("text"))).alias("name"), F.max(F.when(F.col("rule") == "S3", F.col("text"))).alias("affiliation"), F.sum(F.col("rule").startswith("S4").cast("int")).alias("n_fields"))
    people = people.join(m.select("doc_id", "version", *keys), "doc_id")
    a = S.affiliation("affiliation")
    persons = people.select(*keys, F.col("version").alias("generated"), F.col("person_id").alias("person_index"), "name", "affiliation", a["parti"].alias("parti"), a["fylke"].alias("fylke"), "n_fields")
    f = c.where(F.col("rule").startswith("S4") | (F.col("rule") == "S5"))
    left, right = F.array_join("left", " "), F.array_join("right", " ")
    f = f.groupBy("doc_id", "person_id", "field_id").agg(
        _joined(left, F.col("left_bold"), " ").alias("field_label"), _joined(right, F.size("right") > 0, "\n").alias("value"), F.max(F.col("rule") == "S4 header").alias("is_header"))
    fields = f.join(people.select("doc_id", "person_id", "version", "name", *keys), ["doc_id", "person_id"]).select(*keys, F.col("version").alias("generated"), F.col("person_id").alias("person_index"), "name", "field_label", "value", F.col("field_id").alias("field_order"), "is_header")
    rest = c.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(F.col("rule") == "remainder", F.struct("page", "line_no", "top", "text")))).alias("rest"), F.coalesce(F.max("person_id"), F.lit(0)).alias("n_persons"))
    docs = m.join(rest, "doc_id", "left").select(*keys, F.col("version").alias("generated"), "wayback_ts", "source_url", "wayback_url", "file_hash", "n_pages", F.coalesce("n_persons", F.lit(0)).alias("n_persons"), "cover_text", F.coalesce(F.size("rest"), F.lit(0)).alias("n_remainder_lines"), F.coalesce(S.remainder_json("rest"), F.lit("[]")).alias("remainder_json"), F.lit(PARSER_VERSION).alias("parser_version"))
    return FormTables(conform(docs, "smk_documents", *keys), conform(persons, "smk_persons", *keys), conform(fields, "smk_fields", *keys))


def parse(words: DataFrame, meta: DataFrame) -> FormTables:
    lines = group_lines(body_words(words, "form"))
    return tables(lines, classify(lines, form_split(lines)), meta)
