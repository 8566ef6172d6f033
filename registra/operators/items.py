"""The derived layer: blocks joined to memoised items by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import conform

_TEXT = ("item_text", "organisation", "role", "remuneration", "org_number", "date_from", "date_to", "country")


def latest_records(cache: DataFrame) -> DataFrame:
    """One record per block hash: the last by file and line, as an aggregate and no window, so that no
    group is sorted. ``cache`` has block_hash, items, model, prompt_version, file, line."""
    last = F.max_by(F.struct("items", "model", "prompt_version"), F.struct("file", "line"))
    return cache.groupBy("block_hash").agg(last.alias("r")).select("block_hash", "r.*")


def build_items(sections: DataFrame, cache: DataFrame) -> DataFrame:
    """Sections with their items, numbered from 1; blocks without items give no row."""
    memo = cache.select("block_hash", "items", "model", "prompt_version")
    x = sections.join(memo, "block_hash").select("date", "person_index", "person_header", "section_heading", "paragraf", "label", "block_hash", "model", "prompt_version", F.posexplode("items").alias("k", "i"))
    cols = [S.to_text(F.col(f"i.{c}")).alias(c) for c in _TEXT]
    cols += [S.to_long(F.col("i.amount_nok")).alias("amount_nok"), S.to_long(F.col("i.share_count")).alias("share_count"), S.to_double(F.col("i.share_pct")).alias("share_pct")]
    return conform(x.select("date", "person_index", "person_header", "section_heading", "paragraf", "label", (F.col("k") + 1).alias("item_index"), *cols, "block_hash", "model", "prompt_version"), "items")


def coverage(sections: DataFrame, cache: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Non-empty sections, how many of them the cache knows (with items or without), distinct known
    blocks and the ratio of rows."""
    full = sections.where(S.non_empty("text")).join(cache.select("block_hash", F.lit(True).alias("known")).distinct(), "block_hash", "left")
    known = F.coalesce("known", F.lit(False))
    return full.groupBy(*by).agg(
        F.count("*").alias("sections_nonempty"), F.count_if(known).alias("sections_covered"), F.count_distinct(F.when(known, F.col("block_hash"))).alias("sections_enriched_unique_blocks"),
        S.round4(F.count_if(known) / F.nullif(F.count("*"), F.lit(0))).alias("enrichment_coverage"))


def distinct_blocks(sections: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """One section per block hash, the first in the given order."""
    cols = sections.columns
    first = sections.groupBy("block_hash").agg(F.min_by(F.struct(*[c for c in cols if c != "block_hash"]), F.struct(*order)).alias("r"))
    return first.select("block_hash", "r.*").select(*cols)


def pending(blocks: DataFrame, cache: DataFrame) -> DataFrame:
    """Blocks with text that the cache does not know yet."""
    return blocks.where(S.non_empty("text")).join(cache.select("block_hash"), "block_hash", "left_anti")


def batches(blocks: DataFrame, order: tuple[str, ...], batch_size: int = 6, max_requests: int = 120) -> DataFrame:
    """The blocks of the first ``max_requests`` batches. Only that many rows are ranked: the limit
    comes first, so the window sees a bounded number."""
    from pyspark.sql import Window

    first = blocks.orderBy(*order).limit(batch_size * max_requests)
    rn = F.row_number().over(Window.orderBy(*order))
    return first.withColumn("batch_id", F.floor((rn - 1) / batch_size).cast("int"))
