"""Scalar functions as Column expressions; Python only where Spark has no equal (NFC, case folding)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Trim Unicode white space at both ends, no-break space included."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def non_empty(x) -> Column:
    """True where the text holds something beside white space; null counts as empty."""
    return F.coalesce(F.regexp_replace(_c(x), r"(?U)\s", "") != "", F.lit(False))


def header_carve(x) -> Column:
    """``Name (Party, Region)`` as a struct of name, party, constituency.

    Without a bracket pair the whole header is the name. Three or more parts that start with a
    number give the second part as party and the rest as region."""
    h = _c(x)
    bracketed = F.coalesce(h.contains("(") & h.contains(")"), F.lit(False))
    name = F.regexp_replace(strip(F.substring_index(h, "(", 1)), ",+$", "")
    inside = F.regexp_extract(h, r"(?s)^[^(]*\((.*)\)", 1)
    parts = F.transform(F.split(inside, ","), strip)
    numbered = (F.size(parts) >= 3) & F.get(parts, F.lit(0)).rlike(r"^\d+$")
    comma = inside.contains(",")
    party = F.when(numbered, F.get(parts, F.lit(1))).when(comma, F.get(parts, F.lit(0))).otherwise(F.nullif(strip(inside), F.lit("")))
    region = F.when(numbered, F.array_join(F.slice(parts, 3, F.greatest(F.size(parts), F.lit(1))), ", ")).when(comma, strip(F.regexp_replace(inside, r"(?s)^[^,]*,", "")))
    none = F.lit(None).cast("string")
    return F.struct(
        F.when(bracketed, name).otherwise(strip(h)).alias("name"),
        F.when(bracketed, party).otherwise(none).alias("party"),
        F.when(bracketed, region).otherwise(none).alias("constituency"),
    )


def block_hash(marker, label, text) -> Column:
    """sha256 of the three parts with line feeds between; null where a part is null."""
    return F.sha2(F.concat(_c(marker), F.lit("\n"), _c(label), F.lit("\n"), _c(text)), 256)


def file_hash(content) -> Column:
    return F.sha2(_c(content), 256)


@F.pandas_udf(StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else unicodedata.normalize("NFC", " ".join(v.split())).casefold())


def norm(x, known_nfc: bool = False) -> Column:
    """White space collapsed, NFC, case folded. With ``known_nfc`` the built-in form is used, which
    agrees for composed text whose only folding beyond lower case is the sharp s. Otherwise ASCII text is
    folded by Spark, and only the rest goes to Python (as nulls where it need not)."""
    if known_nfc:
        return F.replace(F.lower(F.regexp_replace(strip(x), r"(?U)\s+", " ")), F.lit("ß"), F.lit("ss"))
    c = _c(x)
    plain = F.when(~c.rlike(r"[^\x00-\x7f]"), F.lower(F.trim(F.regexp_replace(c, r"[\t-\r\x1c-\x20]+", " "))))
    return F.coalesce(plain, _fold(F.when(c.rlike(r"[^\x00-\x7f]"), c)))


def tokens(x, known_nfc: bool = False) -> Column:
    """Normalised name tokens; commas and hyphens part tokens."""
    return parted(norm(x, known_nfc))


def parted(normed) -> Column:
    """Tokens of a normalised name."""
    return F.filter(F.split(F.translate(_c(normed), ",-", "  "), " +"), lambda t: t != "")


def token_set_key(toks) -> Column:
    """A set of tokens as one comparable string."""
    return F.array_join(F.array_sort(F.array_distinct(_c(toks))), " ")


def name_parts(x) -> Column:
    """``Surname, Given`` as a struct; a name without a comma is all surname."""
    n = _c(x)
    return F.struct(strip(F.substring_index(n, ",", 1)).alias("surname"), F.when(n.contains(","), strip(F.regexp_replace(n, r"(?s)^[^,]*,", ""))).otherwise("").alias("given"))


def dotnet_date(x) -> Column:
    """``/Date(ms+zone)/`` as an ISO date in UTC; the zone does not count, no match gives null."""
    ms = F.regexp_extract(_c(x), r"^/Date\((-?\d+)", 1)
    return F.date_format(F.timestamp_millis(ms.try_cast("bigint")), "yyyy-MM-dd")


_NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"


def to_double(x) -> Column:
    """Spaces dropped, comma as point; null where that is no number."""
    t = strip(F.replace(F.replace(_c(x).cast("string"), F.lit(" "), F.lit("")), F.lit(","), F.lit(".")))
    return F.when(t.rlike(_NUMBER), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


def to_long(x) -> Column:
    """Like to_double, cut towards zero; null beyond the range of long."""
    d = to_double(x)
    return F.when(F.abs(d) < 9.2e18, d.try_cast("bigint"))


def to_text(x) -> Column:
    """Stripped; empty becomes null."""
    return F.nullif(strip(_c(x).cast("string")), F.lit(""))


def round4(x) -> Column:
    return F.round(_c(x), 4)


def is_marker(token) -> Column:
    """Does this token open a section: it begins with a paragraph sign, or is one or two digits and a point."""
    t = _c(token)
    return F.coalesce(t.startswith("§") | t.rlike(r"^\d{1,2}\.$"), F.lit(False))


def consume_marker(toks) -> Column:
    """(marker, rest) of the left column's tokens; a lone paragraph sign takes the next token along."""
    t = _c(toks)
    lone = (F.get(t, F.lit(0)) == "§") & (F.size(t) > 1)
    rest = lambda k: F.slice(t, k, F.greatest(F.size(t), F.lit(1)))
    return F.struct(F.when(lone, F.concat(F.lit("§"), F.get(t, F.lit(1)))).otherwise(F.get(t, F.lit(0))).alias("marker"), F.when(lone, rest(3)).otherwise(rest(2)).alias("rest"))


def columns_at(words, threshold) -> Column:
    """Words left and right of a column split; each word is a struct with x0."""
    w, t = _c(words), _c(threshold)
    return F.struct(F.filter(w, lambda x: x["x0"] < t).alias("left"), F.filter(w, lambda x: x["x0"] >= t).alias("right"))


def generated_date(text) -> Column:
    """ISO date after the word that says when a form was generated; null without one."""
    p = r"(?i)generert\s+(\d{2})-(\d{2})-(\d{4})"
    g = lambda k: F.regexp_extract(_c(text), p, k)
    return F.when(_c(text).rlike(p), F.concat_ws("-", g(3), g(2), g(1)))


def affiliation(text) -> Column:
    """``(Party, County)`` as a struct of parti, fylke."""
    inside = F.regexp_replace(_c(text), r"^[()]+|[()]+$", "")
    comma = inside.contains(",")
    return F.struct(
        F.when(comma, strip(F.substring_index(inside, ",", 1))).otherwise(F.nullif(strip(inside), F.lit(""))).alias("parti"),
        F.when(comma, strip(F.regexp_replace(inside, r"(?s)^[^,]*,", ""))).alias("fylke"),
    )


def zip_json(headers, row) -> Column:
    """JSON object of headers and cells: of equal headers the last cell wins at the first one's place,
    the shorter side cuts the longer."""
    h, r = _c(headers), _c(row)
    n = F.least(F.size(h), F.size(r))
    pairs = F.arrays_zip(F.slice(h, 1, n).alias("h"), F.slice(r, 1, n).alias("r"))
    names = F.array_distinct(F.slice(h, 1, n))
    return F.to_json(F.map_from_arrays(names, F.transform(names, lambda k: F.element_at(F.filter(pairs, lambda p: p["h"] == k), -1)["r"])), {"ignoreNullFields": "false"})


def json_cell(cells, key: str) -> Column:
    return variant_cell(F.try_parse_json(_c(cells)), F.lit(key))


def variant_cell(cells, key: Column, kind: str = "string") -> Column:
    """The value of a key of a VARIANT object; null where there is no object or it lacks the key. A path names
    a key between quotes of one sort, so a key with both sorts is looked up in the object as a map."""
    v, get = _c(cells), lambda q: F.try_variant_get(_c(cells), F.concat(F.lit(f"$[{q}"), key, F.lit(f"{q}]")), kind)
    whole = F.try_element_at(F.try_variant_get(v, "$", f"map<string,{kind}>"), key)
    return F.when(~F.contains(key, F.lit("'")), get("'")).when(~F.contains(key, F.lit('"')), get('"')).otherwise(whole)


def md_escape(x) -> Column:
    """Cell of a markdown table: null is empty, bars are escaped, line feeds become breaks."""
    v = F.coalesce(_c(x).cast("string"), F.lit(""))
    return F.replace(F.replace(v, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("<br>"))


def shard(x) -> Column:
    """First two characters of a hash."""
    return F.substring(_c(x), 1, 2)


def capture_url(ts, source: str) -> Column:
    """Address of an archived capture."""
    return F.concat(F.lit("https://web.archive.org/web/"), _c(ts), F.lit("id_/"), F.lit(source))


def basename(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def remainder_json(entries) -> Column:
    """Unclassified lines as JSON: page, top to one decimal, text, in order."""
    return F.to_json(F.transform(_c(entries), lambda e: F.struct(e["page"].alias("page"), F.round(e["top"], 1).alias("top"), e["text"].alias("text"))))
