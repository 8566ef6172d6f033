"""Candidate file names of publications: date sequence, periods, tokens and their cross product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Month names as printed in file names, and the short forms in use.
FULL = ("januar", "februar", "mars", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "desember")
SHORT = (("jan",), ("feb",), ("mar",), ("apr",), (), ("jun",), ("jul",), ("aug",), ("sep", "sept"), ("okt",), ("nov",), ("des",))


def dates(spark: SparkSession, first: str = "2017-10-01", last: str | None = None) -> DataFrame:
    end = F.lit(last).cast("date") if last else F.current_date()
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), end)).alias("d"))


def with_periods(df: DataFrame) -> DataFrame:
    """(…, period, rank): the parliamentary year of the date, then its neighbour; it flips after September."""
    y = F.year("d")
    before, after = F.format_string("%d-%d", y - 1, y), F.format_string("%d-%d", y, y + 1)
    early = F.month("d") <= 9
    both = F.when(early, F.array(before, after)).otherwise(F.array(after, before))
    return df.select("*", F.posexplode(both).alias("rank", "period"))


def month_tokens(spark: SparkSession, dots: bool = True) -> DataFrame:
    rows = [(m + 1, t + d) for m in range(12) for t in (FULL[m], *SHORT[m]) for d in (("", ".") if dots else ("",))]
    return spark.createDataFrame(rows, "month int, month_token string")


def day_tokens(df: DataFrame, extended: bool = False) -> DataFrame:
    d = F.dayofmonth("d").cast("string")
    forms = [d, F.concat(d, F.lit("."))]
    if extended:
        two = F.lpad(d, 2, "0")
        forms += [two, F.concat(two, F.lit("."))]
    return df.select("*", F.explode(F.array_distinct(F.array(*forms))).alias("day_token"))


def dated(spark: SparkSession, days: DataFrame, base: str, extended: bool = False) -> DataFrame:
    """(d, url): every spelling of every date; all factors but the dates are a few literals."""
    prefixes = ["pr-", "pr.-"] + (["pr..-"] if extended else [])
    x = day_tokens(with_periods(days), extended).withColumn("prefix", F.explode(F.array(*map(F.lit, prefixes)))).withColumn("month", F.month("d"))
    x = x.join(F.broadcast(month_tokens(spark)), "month")
    return x.select("d", F.concat(F.lit(f"{base}/arkiv_"), "period", F.lit("/"), "prefix", "day_token", F.lit("-"), "month_token", F.lit("-"), F.year("d").cast("string"), F.lit(".pdf")).alias("url"))


def coded(days: DataFrame, base: str, other: str) -> DataFrame:
    """(d, url): the numeric spellings, in the other folder and in both periods' folders."""
    y, m, d = (F.date_format("d", p) for p in ("yyyy", "MM", "dd"))
    codes = F.array(F.concat(y, F.lit("-"), d, m), F.concat(y, F.lit("-"), m, d), F.concat(y, F.lit("-"), d, F.lit("-"), m), F.concat(d, m, F.lit("-"), y))
    x = with_periods(days).withColumn("code", F.explode(codes))
    here = x.select("d", F.concat(F.lit(f"{base}/arkiv_"), "period", F.lit("/"), "code", F.lit(".pdf")).alias("url"))
    there = x.where("rank = 0").select("d", F.concat(F.lit(f"{other}/"), "code", F.lit(".pdf")).alias("url"))
    return here.unionByName(there)


def worklist(*parts: DataFrame) -> DataFrame:
    """All candidates once, in order."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("url").distinct().orderBy("url")


class Limiter:
    """Starts per second: halved on a refusal, not below ``floor``, raised a little on success up to ``top``."""

    def __init__(self, rate: float = 18.0, floor: float = 4.0, top: float = 24.0):
        self.rate, self.floor, self.top = rate, floor, top
        self.last = 0.0

    def wait(self, clock=None, sleep=None) -> None:
        import time

        clock, sleep = clock or time.monotonic, sleep or time.sleep
        pause = self.last + 1 / self.rate - clock()
        if pause > 0:
            sleep(pause)
        self.last = clock()

    def penalize(self) -> None:
        self.rate = max(self.floor, self.rate / 2)

    def reward(self) -> None:
        self.rate = min(self.top, self.rate + 0.02)


def probe(urls, head, hit, start: int = 0, save=None, every: int = 5000, limiter: Limiter | None = None, max_blocks: int = 12, cool_down: float = 30.0, sleep=None) -> dict:
    """Walks a sorted worklist from ``start`` with ``head(url) -> status`` and tells the outcome.

    200 goes to ``hit``; 403, 429 and 503 slow the walk down and pause it, and ``max_blocks`` of them
    without a 404 between end it. ``save(index)`` keeps the place to go on from."""
    import time

    sleep, limiter, blocks, hits = sleep or time.sleep, limiter or Limiter(), 0, 0
    save = save or (lambda index: None)
    for index, url in enumerate(urls):
        if index < start:
            continue
        limiter.wait(sleep=sleep)
        status = head(url)
        if status == 200:
            hits += 1
            hit(url)
        elif status == 404:
            blocks = 0
            limiter.reward()
        elif status in (403, 429, 503):
            blocks += 1
            limiter.penalize()
            sleep(cool_down)
            if blocks >= max_blocks:
                save(index)
                return {"index": index, "hits": hits, "aborted": True}
        if index % every == 0:
            save(index)
    save(len(urls))
    return {"index": len(urls), "hits": hits, "aborted": False}
