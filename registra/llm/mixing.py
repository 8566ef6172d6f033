"""Mixing sources to target weights: Pareto order sampling after whole copies.

Every source gets a target in words by water filling: weights share the total, a source stops at
``MAX_COPIES`` times its size and its excess is shared again by weight. Within a source a document is
expected e times, e growing with its length class (powers of two) as ``GROWTH`` says, never above
``MAX_COPIES``, and scaled so that the expected words meet the target. The whole part of e is allocated
for certain; the broken part p, which differs by class, is the inclusion probability in a Pareto order
sample: documents stand in the order of (u / (1 - u)) / (p / (1 - p)), u being a hash of id and text, and in this order each one is taken that
still fits what is left of the source's target. Where every document that fits is in the sample (most
words of the source being in longer ones), a second and third sample give further copies, never more
than ``MAX_COPIES`` in all. A source within ``NEAR`` of its target ends; at last the one document more
that brings a source nearest to its target is taken, if any does.

The order is never laid out. A source's front is found digit by digit of the rank: sums of words by
digit give the digit in which the front ends, and only that one is divided further; documents beyond
the end which still fit make the next front. All that is kept of it is a small row a source (bounds of
fronts), from which any document's copies follow, so texts are not joined with copies.

Defined results: a null text has size 0 and gets no more than its whole copies (0 words); a null
source is a source of its own, last in order; sources without words get target 0. Rows that repeat id
and text have one rank and are taken together or not at all; they count as documents of their own.
An empty table gives an empty result. Reruns agree, since u is a hash. Columns of any name ride along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, word_count

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: A document of twice the length is expected 2 ** GROWTH times as often.
GROWTH = 0.25
SEED = 20_240_117
RANK_BITS = 48
DIGIT_BITS = 8
#: Documents of a source that are ranked one by one.
LEAF = 64
#: A source whose rest is at most this part of its target is near enough for the closing document.
NEAR = 0.001
_FRONTS = "array<struct<sample: int, most: double, low: long, high: long>>"


def source_targets(scratch: Scratch, classes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) of a table with source and words. Sources are ranked by a range
    shuffle, not in one task; the driver holds a few sums only."""
    per = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    n = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col("source").isNull(), F.col("source")
    ranged = per.repartitionByRange(min(n, 64), *key).sortWithinPartitions(*key).withColumn("part", F.spark_partition_id())
    ranged = scratch.write(ranged, "sources")
    before = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = before.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # 64 rows at most
    at = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source")) - 1 + F.col("before")
    table = ranged.join(F.broadcast(before), "part").withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(at, F.lit(len(weights))) + 1).cast("int")))
    table = scratch.write(table.select("source", "source_size", "w", (F.col("source_size") * float(max_copies)).alias("top")), "weights")
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    # the level only rises, and a source that reached its top stays there
    level, full = 0.0, -1
    while True:
        capped = F.col("w") * level >= F.col("top")
        row = table.agg(F.sum(F.when(capped, F.col("top")).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("w"))), F.sum(capped.cast("long"))).first()
        if not row[1] or row[2] == full:
            break
        level, full = (total - row[0]) / row[1], row[2]
    return table.select("source", "source_size", F.least(F.col("w") * level, F.col("top")).alias("target"))


def expected_copies(classes: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target, expect: class -> copies, rest: words beyond the certain copies).

    A source has at most 64 classes. The longest classes reach ``max_copies`` first: the level is that
    of the longest class that it leaves below."""
    c = _by_source(classes, targets).withColumn("w", F.pow(F.lit(2.0), F.col("class") * GROWTH))
    above = Window.partitionBy("source").orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, 0)
    open_words = F.sum(F.col("w") * F.col("words")).over(upto)
    c = c.withColumn("level", (F.col("target") - max_copies * F.coalesce(F.sum("words").over(above), F.lit(0))) / F.when(open_words > 0, open_words))
    fits = F.col("level") * F.col("w") <= max_copies * (1 + 1e-12)
    c = c.withColumn("level", F.max(F.when(fits, F.struct("class", "level"))).over(Window.partitionBy("source"))["level"])
    e = F.greatest(F.lit(0.0), F.least(F.lit(float(max_copies)), F.coalesce(F.col("level") * F.col("w"), F.lit(0.0))))
    c = c.withColumn("e", F.when(F.abs(e - F.round(e)) < 1e-9, F.round(e)).otherwise(e))
    sure = F.sum(F.floor("e") * F.col("words"))
    return c.groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.map_from_entries(F.collect_list(F.struct("class", "e"))).alias("expect"), (F.first("target") - sure).alias("rest"))


def size_class(size: Column) -> Column:
    return F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int")


def uniform(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """The document's u, inside (0, 1)."""
    return (F.pmod(F.xxhash64(F.lit(seed), doc_id, text), F.lit(1 << RANK_BITS)) + 0.5) / float(1 << RANK_BITS)


def rank(u: Column, p: Column) -> Column:
    """Pareto rank as a long of RANK_BITS bits; x / (1 + x) keeps the order of the odds ratio x."""
    x = (u / (1 - u)) / (p / (1 - p))
    return F.least(F.floor(x / (1 + x) * float(1 << RANK_BITS)), F.lit((1 << RANK_BITS) - 1)).cast("long")


def _ranked(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents that take part in a sample: source, size, rank, sure copies and the plan's columns."""
    d = _by_source(sized.where("size > 0").select("source", "size", "u"), plan)
    e = F.element_at("expect", size_class(F.col("size")))
    d = d.withColumn("sure", F.floor(e)).withColumn("p", e - F.floor(e)).where("p > 0")
    return d.withColumn("rank", rank(F.col("u"), F.col("p"))).drop("u", "p", "expect")


def _next_front(scratch: Scratch, sized: DataFrame, plan: DataFrame, state: DataFrame, most_sure: int, label: str) -> DataFrame:
    """``state`` (source, room, low) with ``high``: of the documents with rank > low that fit the room
    and have at most ``most_sure`` certain copies, those with rank < high are taken and leave ``left``; high is null where all fit."""
    expect = plan.select("source", "expect")
    seen = state.select("source", "low", F.col("room").alias("most"), F.col("room").alias("left"), F.lit(0).cast("long").alias("high"))
    shift, written = RANK_BITS, []
    while shift:
        above = shift
        shift = max(0, shift - DIGIT_BITS)
        if written and seen.agg(F.max("n")).first()[0] is None:
            break
        if written and seen.agg(F.max("n")).first()[0] <= LEAF:
            shift = 0
        d = _ranked(sized, expect.join(seen.withColumnRenamed("source", "s3"), F.expr("source <=> s3")).drop("s3").where("high is not null"))
        d = d.where((F.col("sure") <= most_sure) & (F.col("size") <= F.col("most")) & (F.col("rank") > F.col("low")) & (F.shiftright("rank", above) == F.col("high")))
        sums = d.groupBy("source", "left", F.shiftright("rank", shift).alias("digit")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        sums = sums.withColumn("through", F.sum("words").over(Window.partitionBy("source").orderBy("digit")))
        over = F.col("through") > F.col("left")
        ends = sums.groupBy("source").agg(F.min(F.when(over, F.struct("digit", "n"))).alias("end"), F.max(F.when(~over, F.col("through"))).alias("spent"))
        ends = ends.select(F.col("source").alias("s2"), "end", "spent")
        nxt = seen.drop("n").join(ends, F.expr("source <=> s2"), "left")
        nxt = nxt.select("source", "low", "most", (F.col("left") - F.coalesce("spent", F.lit(0))).alias("left"), F.col("end.digit").alias("high"), F.col("end.n").alias("n"))
        written.append(f"{label}-{shift}")
        seen = scratch.write(nxt, written[-1])
    scratch.drop(*written[:-1])
    return seen


def plan_mix(scratch: Scratch, sized: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """A row a source (source, source_size, target, expect, fronts, last) from which copies follow.
    ``sized`` is a written table of source, size and u."""
    classes = sized.groupBy("source", size_class(F.col("size")).alias("class")).agg(F.sum("size").alias("words"))
    classes = scratch.write(classes, "classes")
    plan = scratch.write(expected_copies(classes, source_targets(scratch, classes, weights, max_copies), max_copies), "expected")
    no_fronts, head = F.array().cast(_FRONTS), F.lit(-1).cast("long")
    done = scratch.write(plan.select("source", "rest", (F.col("target") * NEAR).alias("near"), no_fronts.alias("fronts")), "sample0")
    for sample in range(1, max_copies + 1):
        ended = [done.where("rest <= near")]
        state = done.where("rest > near").select("source", F.col("rest").alias("room"), "near", head.alias("low"), "fronts")
        k = 0
        while not state.isEmpty():
            got = _next_front(scratch, sized, plan, state.drop("fronts", "near"), max_copies - sample, f"front{sample}-{k}")
            more = state.select(F.col("source").alias("s2"), "near", "fronts")
            front = F.array(F.struct(F.lit(sample).alias("sample"), "most", "low", "high")).cast(_FRONTS)
            got = got.join(more, F.expr("source <=> s2")).withColumn("fronts", F.concat("fronts", front))
            got = scratch.write(got.select("source", F.col("left").alias("room"), "near", F.col("high").alias("low"), "fronts"), f"after{sample}-{k}")
            again = (F.col("room") > F.col("near")) & F.col("low").isNotNull()
            ended.append(got.where(~again).select("source", F.col("room").alias("rest"), "near", "fronts"))
            state, k = got.where(again), k + 1
        for e in ended[1:]:
            ended[0] = ended[0].unionByName(e)
        done = scratch.write(ended[0], f"sample{sample}")
    fronts = done.select(F.col("source").alias("s2"), F.col("rest").alias("room"), "fronts")
    plan = scratch.write(plan.drop("rest").join(fronts, F.expr("source <=> s2")).drop("s2"), "fronts")
    # the document that brings the source nearest to its target, if any brings it nearer
    spare = _ranked(sized, plan.select("source", "expect", "fronts", "room")).where((F.col("size") < 2 * F.col("room")) & (F.col("sure") + _sampled(max_copies) < max_copies))
    off = F.abs(F.col("size") - F.col("room")).alias("off")
    best = spare.groupBy("source", off, "rank").agg(F.count("*").alias("n")).groupBy("source").agg(F.min(F.struct("off", "n", "rank")).alias("m"))
    best = best.select(F.col("source").alias("s2"), F.when(F.col("m.n") == 1, F.col("m.rank")).alias("last"))
    plan = plan.join(best, F.expr("source <=> s2"), "left").drop("s2", "room")
    return scratch.write(plan, "plan")


def _sampled(max_copies: int) -> Column:
    """In how many samples a document with size, sure and rank is."""
    size, at, sure = F.col("size"), F.col("rank"), F.col("sure")
    hit = lambda f: (sure + f["sample"] <= max_copies) & (size <= f["most"]) & (at > f["low"]) & (f["high"].isNull() | (at < f["high"]))
    return F.size(F.filter("fronts", hit))


def copies(rows: DataFrame, plan: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``rows`` (source, size, u and any others) with source_size, target and copies."""
    d = _by_source(rows, plan)
    e = F.element_at("expect", size_class(F.col("size")))
    p = e - F.floor(e)
    d = d.withColumn("sure", F.floor(e)).withColumn("rank", F.when((F.col("size") > 0) & (p > 0), rank(F.col("u"), p)))
    more = _sampled(max_copies) + F.coalesce(F.col("rank") == F.col("last"), F.lit(False)).cast("int")
    n = F.col("sure") + F.when(F.col("rank").isNotNull(), more).otherwise(0)
    return d.withColumn("copies", n.cast("long")).drop("rank", "sure", "expect", "fronts", "last")


def mix(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights=WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    scratch = Scratch(spark, "mixing")
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), uniform(F.col(doc_id), F.col(text), seed).alias("u"))
    sized = scratch.write(sized, "sizes")
    out = copies(sized, plan_mix(scratch, sized, weights, max_copies), max_copies)
    out = out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    out = scratch.write(out, "result")
    scratch.keep("result")
    return out


def _by_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Join a table with one row per source; null is a source. The hint-free join lets Spark send the
    table whole only where it is small."""
    t = table.withColumnRenamed("source", "s2")
    return rows.join(t, F.expr("source <=> s2")).drop("s2")


def apply_mix(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The documents with the input's columns, each as many times as the mix takes it."""
    scratch = Scratch(spark, "mixing")
    size, u = word_count(F.col(text)), uniform(F.col(doc_id), F.col(text))
    sized = scratch.write(docs.select(F.col(source).alias("source"), size.alias("size"), u.alias("u")), "sizes")
    plan = plan_mix(scratch, sized)
    scratch.keep("plan")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source).alias("source"), size.alias("size"), u.alias("u"))
    times = copies(whole, plan).where("copies > 0").withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return times.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
