"""Words to lines: footer cut, anchored line grouping, column split, cells, header assignment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Layout constants of the two printed forms, in points.
FOOTER = {"register": 65.0, "form": 55.0}
TOP_TOLERANCE = 2.5
CELL_GAP = 8.0
BODY_SIZE = 10.5
REGISTER_SPLIT = {"min": 150.0, "max": 400.0, "back": 6.0, "fallback": 205.0}
FORM_SPLIT = {"min": 150.0, "max": 400.0, "back": 4.0, "fallback": 200.0, "below": 12.0}


def body_words(words: DataFrame, layout: str = "register") -> DataFrame:
    """Words above the footer band, with ``bold`` from the font's name."""
    return words.where(F.col("top") < F.col("page_height") - FOOTER[layout]).withColumn("bold", F.coalesce(F.col("fontname").contains("Bold"), F.lit(False)))


def line_starts(tops: np.ndarray, tolerance: float) -> list[int]:
    """Places at which a line begins in tops that rise (unknown ones first). A line ends before the first
    top that is over the tolerance away from the line's own first top: found by bisection, and set right
    where the sum rounds otherwise than the difference."""
    n, known = len(tops), int(np.isnan(tops).sum())
    starts, at = list(range(min(known + 1, n))), known  # a word of unknown top is a line of its own
    while at < n:
        anchor = tops[at]
        end = int(np.searchsorted(tops, anchor + tolerance, "right"))
        while end < n and not tops[end] - anchor > tolerance:
            end += 1
        while end - 1 > at and tops[end - 1] - anchor > tolerance:
            end -= 1
        if end < n:
            starts.append(end)
        at = end
    return starts


def anchored_groups(sorted_words: Column, tolerance: float = TOP_TOLERANCE) -> Column:
    """Line number of each word of an array sorted by top. A line is anchored at its first word's
    top and the anchor does not move, so this is a walk from anchor to anchor and no gap session.

    A walk has no expression in Spark but a fold, which would copy its array at every word; only the tops
    go to Python, in Arrow batches, and the work is in proportion to the words."""

    @F.pandas_udf("array<int>")
    def numbers(pages: pd.Series) -> pd.Series:
        out = []
        for tops in pages:
            lines = np.zeros(len(tops), np.int32)
            lines[line_starts(np.asarray(tops, float), tolerance)] = 1
            out.append(np.cumsum(lines, dtype=np.int32))
        return pd.Series(out, dtype=object)

    return numbers(F.transform(sorted_words, lambda w: w["top"]))


def group_lines(words: DataFrame) -> DataFrame:
    """(doc_id, page, line_no, words, text, top, x0, bold, size): one row per printed line.

    Grouping is per page, so no group grows with the corpus."""
    if "x1" not in words.columns:
        words = words.withColumn("x1", F.lit(None).cast("double"))
    w = F.struct("top", "x0", F.monotonically_increasing_id().alias("seq"), "x1", "text", "bold", "size")
    pages = words.select("doc_id", "page", w.alias("w")).groupBy("doc_id", "page").agg(F.array_sort(F.collect_list("w")).alias("ws"))
    numbered = pages.select("doc_id", "page", F.explode(F.arrays_zip("ws", anchored_groups(F.col("ws")).alias("no"))).alias("z"))
    by_x = F.struct("z.ws.x0", "z.ws.top", "z.ws.seq", "z.ws.x1", "z.ws.text", "z.ws.bold", "z.ws.size")
    lines = numbered.groupBy("doc_id", "page", F.col("z.no").alias("line_no")).agg(F.array_sort(F.collect_list(by_x)).alias("words"))
    first = F.get("words", F.lit(0))
    return lines.select(
        "doc_id", "page", "line_no", "words",
        F.array_join(F.transform("words", lambda x: x["text"]), " ").alias("text"), first["top"].alias("top"), first["x0"].alias("x0"),
        F.forall("words", lambda x: x["bold"]).alias("bold"), F.array_max(F.transform("words", lambda x: x["size"])).alias("size"),
    )


def modal_start(starts: DataFrame, back: float, fallback: float, docs: DataFrame) -> DataFrame:
    """(doc_id, split): the commonest x0 to one decimal, less ``back``; ties go to the one met first.

    ``starts`` has doc_id, x0 and pos (anything that orders as the document does)."""
    n = starts.groupBy("doc_id", F.round("x0", 1).alias("x")).agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    best = n.groupBy("doc_id").agg(F.max_by("x", F.struct("n", F.struct((-F.col("first.page")).alias("p"), (-F.col("first.line_no")).alias("l"), (-F.col("first.k")).alias("k")))).alias("x"))
    return docs.select("doc_id").distinct().join(best, "doc_id", "left").select("doc_id", F.coalesce(F.col("x") - back, F.lit(fallback)).alias("split"))


def register_split(lines: DataFrame) -> DataFrame:
    s = REGISTER_SPLIT
    hits = lines.where(~F.col("bold") & (F.col("size") >= BODY_SIZE) & (F.col("x0") > s["min"]) & (F.col("x0") < s["max"]))
    return modal_start(hits.select("doc_id", "x0", F.struct("page", "line_no", F.lit(0).alias("k")).alias("pos")), s["back"], s["fallback"], lines)


def form_split(lines: DataFrame) -> DataFrame:
    s = FORM_SPLIT
    w = lines.where("page >= 1").select("doc_id", "page", "line_no", F.posexplode("words").alias("k", "w"))
    hits = w.where(~F.col("w.bold") & (F.col("w.size") < s["below"]) & (F.col("w.x0") > s["min"]) & (F.col("w.x0") < s["max"]))
    return modal_start(hits.select("doc_id", F.col("w.x0").alias("x0"), F.struct("page", "line_no", "k").alias("pos")), s["back"], s["fallback"], lines)


def cells(words: Column, gap: float = CELL_GAP) -> Column:
    """Cells of a line: a new one begins where the distance to the word before is over ``gap``."""
    before = lambda i: F.get(words, i - 1)
    begins = lambda w, i: F.when((i == 0) | F.coalesce(w["x0"] - before(i)["x1"] > gap, F.lit(False)), i)
    starts = F.array_compact(F.transform(words, begins))

    def cell(spans, k):
        first, end = F.get(spans, k), F.coalesce(F.get(spans, k + 1), F.size(words))
        text = F.array_join(F.transform(F.slice(words, first + 1, end - first), lambda w: w["text"]), " ")
        return F.struct(F.when(end - first == 1, F.get(words, first)["text"]).otherwise(text).alias("text"), F.get(words, first)["x0"].alias("x0"), F.get(words, end - 1)["x1"].alias("x1"))

    # bound once, so that the starts are not told anew for every cell
    return F.element_at(F.transform(F.array(starts), lambda s: F.transform(s, lambda _, k: cell(s, k))), 1)


def assign_header(cell: Column, spans: Column, pad: float = CELL_GAP) -> Column:
    """Index of the header with the largest positive overlap (first of equals); without one, of the
    header whose left edge is nearest."""
    overlap = F.transform(spans, lambda s: F.least(cell["x1"], s["x1"] + pad) - F.greatest(cell["x0"], s["x0"] - pad))
    away = F.transform(spans, lambda s: F.abs(cell["x0"] - s["x0"]))
    return F.when(F.array_max(overlap) > 0, F.array_position(overlap, F.array_max(overlap))).otherwise(F.array_position(away, F.array_min(away))) - 1


def map_row(row_cells: Column, headers: Column) -> Column:
    """Cell texts in header order; cells of one header are joined by a blank, a header without is empty."""
    placed = F.transform(row_cells, lambda c: F.struct(assign_header(c, headers).alias("j"), c["text"].alias("t")))
    return F.transform(headers, lambda h, j: F.array_join(F.transform(F.filter(placed, lambda p: p["j"] == j), lambda p: p["t"]), " "))


def ordered(lines: DataFrame) -> Window:
    return Window.partitionBy("doc_id").orderBy("page", "line_no")
