"""Declared table schemas; nothing is inferred on write. Dates stay strings (their precision varies)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

# Published column names and types, in published order.
_DDL = {
    "documents": "date string, url string, file_hash string, n_pages int, n_persons int, cover_text string, reglement_text string, column_split double, n_remainder_lines int, remainder_json string, parser_version string",
    "persons": "date string, person_index int, section_heading string, person_header string, name string, party string, constituency string, note string, n_sections int, n_transaction_rows int",
    "sections": "date string, person_index int, person_header string, section_heading string, paragraf string, label string, text string, n_lines int, section_order int, block_hash string",
    "transactions": "date string, person_index int, person_header string, paragraf string, row_index int, cells_json string",
    "items": "date string, person_index int, person_header string, section_heading string, paragraf string, label string, item_index int, item_text string, organisation string, role string, remuneration string, amount_nok bigint, share_count bigint, share_pct double, org_number string, date_from string, date_to string, country string, block_hash string, model string, prompt_version string",
    "roster": "date string, person_index int, section_heading string, person_header string, name string, party string, constituency string, api_person_id string, etternavn string, fornavn string, foedselsdato string, kjoenn string, match_method string",
    "name_changes": "api_person_id string, foedselsdato string, printed_name string, first_date string, last_date string, n_snapshots int, match_methods string",
    "smk_documents": "generated string, wayback_ts string, source_url string, wayback_url string, file_hash string, n_pages int, n_persons int, cover_text string, n_remainder_lines int, remainder_json string, parser_version string",
    "smk_persons": "generated string, person_index int, name string, affiliation string, parti string, fylke string, n_fields int",
    "smk_fields": "generated string, person_index int, name string, field_label string, value string, field_order int, is_header boolean",
}
_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "boolean": BooleanType()}


def _flat(ddl: str) -> StructType:
    """A schema of plain columns; needs no session, unlike Spark's own parser."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in map(str.split, ddl.split(", "))])


SCHEMAS: dict[str, StructType] = {k: _flat(v) for k, v in _DDL.items()}
# numbers come as text from the extractor and are coerced where items are built
ITEM = _flat("item_text string, organisation string, role string, remuneration string, amount_nok string, share_count string, share_pct string, org_number string, date_from string, date_to string, country string")
CACHE = StructType([StructField("block_hash", StringType()), StructField("items", ArrayType(ITEM)), StructField("model", StringType()), StructField("prompt_version", StringType())])
WORDS = _flat("doc_id string, page int, page_height double, text string, x0 double, x1 double, top double, fontname string, size double")


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def conform(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """The columns ``keys`` and the declared ones in order and type; a missing column becomes null, an extra
    one goes."""
    have = {c.lower() for c in df.columns}
    return df.select(*keys, *[(F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]])
