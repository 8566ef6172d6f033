"""Quality rules: a threshold table compiled into one native Spark projection.

Every metric is a built-in expression over the text, so no row leaves the JVM. The table ``RULES``
is data: ``verdict`` folds it into one boolean column.

Defined results: a null text counts as the empty text (0 words, base rule fails, not kept). Any
other null column passes through. Very long texts cost n log n. Rows are judged one by one, so
repeated rows, ties and empty tables need no special case, and the input's own columns are kept as
they are: the metrics are named ``q_*``, or ``qq_*`` and so on where the input has such a column
(``prefix`` tells).
Three-word windows are compared by a 64-bit hash within one text; a clash inside one text of n
windows has a chance of about n*n / 2**65.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RE

# Frequent function words of the four corpus languages, plain lower case.
STOP_WORDS = (
    "the of and to in is that it for was on are with as be by this from at or an not have which you "
    "der die und das in den von zu mit ist des auf für im dem nicht ein eine als auch "
    "le la les de des et un une du en est que qui dans pour pas sur au avec il elle "
    "el los las del y en que se por con una su al lo no como más o"
).split()


class Rule(NamedTuple):
    """A document passes when low <= metric <= high."""

    metric: str
    low: float
    high: float


#: Length, symbol, stop-word and line ratios. Production thresholds.
RULES = (
    Rule("mean_word_chars", 1.5, 20.0),
    Rule("symbol_ratio", 0.0, 0.1),
    Rule("stop_ratio", 0.03, 1.0),
    Rule("shout_ratio", 0.0, 0.5),
    Rule("bar_line_ratio", 0.0, 0.75),
    Rule("dup_line_ratio", 0.0, 0.5),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _expr(text: str, p: str) -> dict[str, list[tuple[str, str]]]:
    space = SPACE_RE.replace("\\", "\\\\")
    word = "[^ \\\\t-\\\\r]"
    stops = ",".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return {
        "a": [
            ("q_words", f"filter(split(coalesce(`{text}`, ''), '{space}'), w -> w <> '')"),
            ("q_lines", f"filter(split(coalesce(`{text}`, ''), '\\n'), l -> l rlike '{word}')"),
            ("q_n_symbols", f"cast(octet_length(regexp_replace(coalesce(`{text}`, ''), '[^#*$%&|<>]+', '')) as bigint)"),
        ],
        "b": [
            ("q_n_words", f"cast(size({p}words) as bigint)"),
            ("q_word_chars", f"cast(length(array_join({p}words, '')) as bigint)"),
            ("q_n_lines", f"cast(size({p}lines) as bigint)"),
            ("q_n_dup_lines", f"cast(size({p}lines) - size(array_distinct({p}lines)) as bigint)"),
            ("q_n_bar_lines", f"cast(size(filter({p}lines, l -> l like '% | %')) as bigint)"),
            ("q_n_stop", f"cast(size(filter({p}words, w -> lower(w) in ({stops}))) as bigint)"),
            ("q_n_shout", f"cast(size(filter({p}words, w -> endswith(w, '!!'))) as bigint)"),
            ("q_h", f"if(size({p}words) < 3, cast(array() as array<bigint>), transform(sequence(0, size({p}words) - 3), i -> xxhash64(get({p}words, i), get({p}words, i + 1), get({p}words, i + 2))))"),
        ],
        "c": [
            # positions of windows that occur more than once, in order; mostly none
            ("q_at", f"if(size(array_distinct({p}h)) = size({p}h), cast(array() as array<int>), transform(array(sort_array(transform({p}h, (x, i) -> struct(x, i)))), s -> sort_array(transform(filter(s, (e, k) -> get(s, k - 1).x <=> e.x or get(s, k + 1).x <=> e.x), e -> e.i)))[0])"),
        ],
        "d": [
            ("q_n_repeat_words", f"cast(aggregate(transform({p}at, (p, k) -> least(3, coalesce(get({p}at, k + 1) - p, 3))), 0, (a, b) -> a + b) as bigint)"),
        ],
    }


def prefix(docs: DataFrame) -> str:
    """What the metrics' names begin with: no column of the input does."""
    p = "q_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p = "q" + p
    return p


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns and the metrics, each named with the prefix."""
    p = prefix(docs)
    own = [F.col(f"`{c}`") for c in docs.columns]
    steps = {k: [(n.replace("q_", p, 1), e) for n, e in v] for k, v in _expr(text, p).items()}
    metrics = [F.col(p + n) for n in ("n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines", "n_bar_lines", "n_stop", "n_shout")]
    out = docs.select(*own, *[F.expr(e).alias(n) for n, e in steps["a"]])
    out = out.select(*own, metrics[0], *[F.expr(e).alias(n) for n, e in steps["b"]])
    out = out.select(*own, *metrics, *[F.expr(e).alias(n) for n, e in steps["c"]])
    return out.select(*own, *metrics, *[F.expr(e).alias(n) for n, e in steps["d"]])


_METRICS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "stop_ratio": ("n_stop", "n_words"),
    "shout_ratio": ("n_shout", "n_words"),
    "bar_line_ratio": ("n_bar_lines", "n_lines"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def base_failed(p: str = "q_") -> Column:
    words, repeated = F.col(p + "n_words"), F.col(p + "n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def verdict(rules=RULES, p: str = "q_") -> Column:
    """One boolean column from the threshold table."""
    ok = F.lit(True)
    for r in rules:
        top, bottom = (F.col(p + c).cast("double") for c in _METRICS[r.metric])
        ok = ok & F.coalesce((top >= r.low * bottom) & (top <= r.high * bottom), F.lit(False))
    return ok & ~base_failed(p)


def quality(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The input's columns, the metrics, base_failed and kept, the new ones named with the prefix."""
    p = prefix(docs)
    return measure(docs, text).withColumn(p + "base_failed", base_failed(p)).withColumn(p + "kept", verdict(rules, p))


def filter_kept(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Only the rows that the rules keep, with the input's columns.

    The filter also reads a row number that is made with the metrics: it keeps the optimiser from
    pushing the condition below them, which would copy every metric's expression into it many times."""
    p = prefix(docs)
    m = measure(docs, text).withColumn(p + "row", F.monotonically_increasing_id())
    kept = m.where((F.col(p + "row") >= 0) & verdict(rules, p))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
