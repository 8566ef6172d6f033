"""Entity resolution: three equi-joins in order of priority, each with a uniqueness and a context test.

Of the people that share a key only summaries are kept: for all of them, those of a region, those of a
party and those of both, how many there are, whether they are one identity and who comes first. A summary
is of constant size and merges, so a key that millions share costs no more state than there are regions
and parties. What is found hangs on the printed name, party and region alone, so each of these that differs
is normalised and asked for once, with its three keys in one join, however many snapshots print it; the
person rows meet the answers by them. Identity means the same date of birth and the same normalised names;
several ids of one identity count as one, the first one wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import conform

METHODS = ("exact", "surname_first_token", "token_set")


def _keys(surname: str = "surname", given: str = "given", full: str = "full") -> dict[str, Column]:
    """The keys of normalised names."""
    first = F.coalesce(F.get(S.parted(given), F.lit(0)), F.lit(""))
    return {
        "exact": F.col(full),
        "surname_first_token": F.concat(F.col(surname), F.lit("\x00"), first),
        "token_set": S.token_set_key(S.parted(full)),
    }


def pools(pool: DataFrame, nfc: bool = False) -> DataFrame:
    """(method, key, groups): of the pool's people by method and key the summaries (n, one, who) of every
    group, which ``_group`` names.

    ``pool`` has ord, api_person_id, etternavn, fornavn, foedselsdato, kjoenn, partier, fylker (normalised)."""
    sur, giv = F.coalesce("etternavn", F.lit("")), F.coalesce("fornavn", F.lit(""))
    named = pool.select("*", S.norm(sur, nfc).alias("surname"), S.norm(giv, nfc).alias("given"), S.norm(F.concat(sur, F.lit(", "), giv), nfc).alias("full"))
    keys = _keys()
    ident = F.concat_ws("\x00", F.coalesce("foedselsdato", F.lit("\x01")), "surname", "given")
    who = F.struct("ord", "api_person_id", "etternavn", "fornavn", "foedselsdato", "kjoenn")
    regions = F.array_distinct(F.coalesce("fylker", F.array().cast("array<string>")))
    parties = F.array_distinct(F.coalesce("partier", F.array().cast("array<string>")))
    both = F.flatten(F.transform(regions, lambda r: F.transform(parties, lambda p: _group(r, p))))
    names = F.concat(F.array(_group()), F.transform(regions, lambda r: _group(r)), F.transform(parties, lambda p: _group(None, p)), both)
    base = named.select(who.alias("who"), ident.alias("ident"), names.alias("names"), F.array(*[F.struct(F.lit(m).alias("method"), keys[m].alias("key")) for m in METHODS]).alias("keys"))
    # outer, though no array is empty: the filter that Spark adds before an explode would fold the names again
    long = base.select("who", "ident", "names", F.explode_outer("keys").alias("k")).select("who", "ident", "k.*", F.explode(F.array_compact("names")).alias("name"))
    each = long.groupBy("method", "key", "name").agg(F.count("*").alias("n"), (F.min("ident") == F.max("ident")).alias("one"), F.min("who").alias("who"))
    return each.groupBy("method", "key").agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct("n", "one", "who")))).alias("groups"))


def _group(region: Column | None = None, party: Column | None = None) -> Column:
    """Name of a group of candidates; null where the region or party asked for is null."""
    told = [F.concat(F.lit(mark), v) for mark, v in (("r", region), ("p", party)) if v is not None]
    return F.concat(*told[:1], *[F.concat(F.lit("\x00"), t) for t in told[1:]]) if told else F.lit("")


def _found(groups: Column, region: Column, party: Column) -> tuple[Column, Column]:
    """Who is found without and with the context: candidates are narrowed by region, then by party where
    several are left; a narrowing to none is dropped."""
    every = F.element_at(groups, F.lit(""))
    of_region = F.when(F.coalesce(region != "", F.lit(False)), F.element_at(groups, _group(region)))
    base = F.coalesce(of_region, every)
    of_party = F.when(of_region.isNotNull(), F.element_at(groups, _group(region, party))).otherwise(F.element_at(groups, _group(None, party)))
    narrow = F.coalesce(F.when(F.coalesce(party != "", F.lit(False)) & (base["n"] > 1), of_party), base)
    return F.when(every["one"], every["who"]), F.when(narrow["one"], narrow["who"])


def resolve(persons: DataFrame, pool: DataFrame, nfc: bool = False) -> DataFrame:
    """Roster rows: every person row once, with an identity where exactly one fits and how it was found."""
    n, text = S.name_parts("name"), lambda c: F.coalesce(c, F.lit(""))
    asked = persons.select("name", "party", "constituency").distinct()
    asked = asked.select(F.struct("*").alias("ask"), S.norm("name", nfc).alias("full"), S.norm(n["surname"], nfc).alias("surname"), S.norm(n["given"], nfc).alias("given"), S.norm(text("party"), nfc).alias("p"), S.norm(text("constituency"), nfc).alias("r"))
    keys = _keys()
    turns = F.array(*[F.struct(F.lit(k).alias("turn"), F.lit(m).alias("method"), keys[m].alias("key")) for k, m in enumerate(METHODS)])
    x = asked.select("ask", "p", "r", F.explode(turns).alias("k")).select("ask", "p", "r", "k.*").join(pools(pool, nfc), ["method", "key"], "left")
    alone, narrowed = _found(F.col("groups"), F.col("r"), F.col("p"))
    hit = F.coalesce(F.when(alone.isNotNull(), F.struct(alone.alias("who"), F.col("method").alias("how"))), F.when(narrowed.isNotNull(), F.struct(narrowed.alias("who"), F.concat("method", F.lit("+context")).alias("how"))))
    x = x.select("ask", "turn", F.col("groups").isNotNull().alias("some"), hit.alias("hit"))
    x = x.groupBy("ask").agg(F.min_by("hit", F.when(F.col("hit").isNotNull(), F.col("turn"))).alias("hit"), F.max("some").alias("some"))
    told = ["date", "person_index", "section_heading", "person_header", "name", "party", "constituency"]
    met = persons.select(*told).join(x, F.expr("name <=> ask.name and party <=> ask.party and constituency <=> ask.constituency"))
    got = [F.col(f"hit.who.{k}").alias(k) for k in ("api_person_id", "etternavn", "fornavn", "foedselsdato", "kjoenn")]
    return conform(met.select(*told, *got, F.coalesce("hit.how", F.when(F.col("some"), F.lit("ambiguous")).otherwise("unmatched")).alias("match_method")), "roster")


def name_changes(roster: DataFrame) -> DataFrame:
    """Printed names of people who were printed under two names or more, with the dates of each, by id and
    first date."""
    known = roster.where(F.coalesce(F.col("api_person_id") != "", F.lit(False)))
    per = known.groupBy("api_person_id", F.col("name").alias("printed_name")).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").cast("int").alias("n_snapshots"), F.array_join(F.array_sort(F.collect_set("match_method")), ",").alias("match_methods"))
    born = known.groupBy("api_person_id").agg(F.max_by("foedselsdato", F.struct("date", "person_index")).alias("foedselsdato"), F.countDistinct("name").alias("names")).where("names >= 2")
    return conform(per.join(born, "api_person_id"), "name_changes").orderBy("api_person_id", "first_date", "printed_name")
