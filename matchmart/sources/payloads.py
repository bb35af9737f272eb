"""Nested API payloads -> flat raw rows.

A payload row carries one API response (``body``: a JSON array of items) and
its call context (league, season, fixture, load time, sequence number).  Each
flattener parses ``body`` with a declared schema (``from_json``), explodes the
nested arrays and selects struct paths; a missing path yields NULL.  Payloads
are independent rows, so the work is spread over all partitions; nothing is
grouped except the team de-duplication, which is keyed by team id.

``build_*_payloads`` turn raw tables into payload rows of the same shape as the
API (used to feed the flatteners from the driver tables); documents are paged
so that no document grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import FIXTURE_ITEM, ODDS_ITEM, STANDINGS_ITEM, TEAM_ITEM

PAGE_SIZE = 50  # items per generated document


def _items(payloads: DataFrame, schema) -> DataFrame:
    """One row per item; payloads of :func:`parsed` are not parsed again."""
    items = F.col("items") if "items" in payloads.columns else F.from_json(F.col("body"), T.ArrayType(schema))
    return payloads.select("*", F.posexplode(items).alias("_pos", "item"))


# --- rows and rejects of one parse --------------------------------------------------------------

def parsed(payloads: DataFrame, kind: str) -> DataFrame:
    """Payloads with their ``items`` and the ``reason`` why a document is rejected (null when it is not)."""
    out = payloads.withColumn("items", F.from_json(F.col("body"), T.ArrayType(_SCHEMAS[kind])))
    return out.withColumn("reason", F.when(F.col("body").isNull(), "no document")
                          .when(F.col("items").isNull(), "document does not parse"))


def split(payloads: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the documents, and the rejects: one per document that does not parse and per dropped price.

    The parse runs once: its result is written to the shared checkpoint folder, and rows and
    rejects are read from it."""
    p = parsed(payloads, kind).checkpoint()
    good = p.where("reason is null")
    context = ["payload_seq", "league_id", "season", "fixture_id", "loaded_at"]
    rejects = p.where("reason is not null").select(
        F.lit(kind).alias("kind"), *context, F.lit(None).cast("long").alias("bookmaker_id"), "reason")
    if kind == "odds":
        priced = _prices(good)
        bad = priced.where("bad").select(
            F.lit(kind).alias("kind"), *[F.lit(None).cast("long").alias(c) for c in context[:3]], "fixture_id", "loaded_at",
            "bookmaker_id", F.lit("price is not a number").alias("reason"))
        rejects = rejects.unionByName(bad)
    return _FLATTEN[kind](good), rejects


def damaged_payloads(raw) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Payloads of all kinds, some cut off in the middle and some odds with a text for a price."""
    def cut(payloads: DataFrame, where: Column) -> DataFrame:
        half = F.substring("body", F.lit(1), F.floor(F.length("body") / 2).cast("int"))
        return payloads.withColumn("body", F.when(where, half).otherwise(F.col("body")))

    odds = build_odds_payloads(raw.odds)
    no_number = F.regexp_replace("body", '"value":"Home","odd":"[^"]*"', '"value":"Home","odd":"n/a"')
    odds = odds.withColumn("body", F.when(F.col("fixture_id") % 29 == 5, no_number).otherwise(F.col("body")))
    return (cut(build_fixture_payloads(raw.fixtures), F.col("payload_seq") % 7 == 3),
            cut(build_standings_payloads(raw.standings), (F.col("season") + F.col("league_id")) % 7 == 3),
            cut(build_team_payloads(raw.teams_football, raw.fixtures), F.col("payload_seq") % 7 == 3),
            cut(odds, F.col("fixture_id") % 23 == 7))


# --- S05 fixtures -------------------------------------------------------------------------

def flatten_fixtures(payloads: DataFrame) -> DataFrame:
    """Fixture documents -> 18 raw fixture columns (status = short code)."""
    it = _items(payloads, FIXTURE_ITEM)
    i = F.col("item")
    return it.select(
        i["fixture"]["id"].alias("fixture_id"),
        F.col("league_id"), F.col("league_name"), F.col("season"),
        i["league"]["round"].alias("round"),
        F.to_timestamp_ntz(i["fixture"]["date"]).alias("match_date"),
        i["fixture"]["status"]["short"].alias("status"),
        i["teams"]["home"]["id"].alias("home_team_id"),
        i["teams"]["home"]["name"].alias("home_team_name"),
        i["teams"]["away"]["id"].alias("away_team_id"),
        i["teams"]["away"]["name"].alias("away_team_name"),
        i["goals"]["home"].alias("home_goals"),
        i["goals"]["away"].alias("away_goals"),
        i["score"]["halftime"]["home"].alias("home_goals_ht"),
        i["score"]["halftime"]["away"].alias("away_goals_ht"),
        i["fixture"]["venue"]["name"].alias("venue_name"),
        i["fixture"]["referee"].alias("referee"),
        F.col("loaded_at"),
    )


def build_fixture_payloads(raw_fixtures: DataFrame) -> DataFrame:
    """Raw fixtures -> paged fixture documents per (league, season)."""
    f = raw_fixtures
    item = F.struct(
        F.struct(F.col("fixture_id").alias("id"),
                 F.regexp_replace(F.col("match_date").cast("timestamp_ntz").cast("string"), " ", "T")
                 .alias("date"),  # zone-free text of the wall time
                 F.col("referee").alias("referee"),
                 F.struct(F.col("status").alias("long"), F.col("status").alias("short")).alias("status"),
                 F.struct(F.col("venue_name").alias("name")).alias("venue")).alias("fixture"),
        F.struct(F.col("round").alias("round")).alias("league"),
        F.struct(F.struct(F.col("home_team_id").alias("id"), F.col("home_team_name").alias("name")).alias("home"),
                 F.struct(F.col("away_team_id").alias("id"), F.col("away_team_name").alias("name")).alias("away"))
        .alias("teams"),
        F.struct(F.col("home_goals").alias("home"), F.col("away_goals").alias("away")).alias("goals"),
        F.struct(F.struct(F.col("home_goals_ht").alias("home"),
                          F.col("away_goals_ht").alias("away")).alias("halftime")).alias("score"))
    page = F.floor(F.col("fixture_id") / PAGE_SIZE)
    docs = f.groupBy("league_id", "league_name", "season", page.alias("page")).agg(
        F.max("loaded_at").alias("loaded_at"), F.to_json(F.collect_list(item)).alias("body"))
    return docs.select(F.col("page").alias("payload_seq"), "league_id", "league_name", "season",
                       F.lit(None).cast("long").alias("fixture_id"), "loaded_at", "body")


# --- S06 standings + S09 surrogate ids ---------------------------------------------------------

def standing_id(league_id, season, rank) -> Column:
    """League * 10_000_000 + season * 1_000 + rank, in LONG."""
    return (F.col(league_id).cast("long") * 10_000_000 + F.col(season).cast("long") * 1_000
            + F.coalesce(F.col(rank).cast("long"), F.lit(0)))


def odds_id(fixture_id, bookmaker_id) -> Column:
    """Fixture * 1000 + bookmaker, in LONG."""
    return F.col(fixture_id).cast("long") * 1000 + F.col(bookmaker_id).cast("long")


def flatten_standings(payloads: DataFrame) -> DataFrame:
    """League -> groups (array of arrays) -> one row per table entry."""
    it = _items(payloads, STANDINGS_ITEM)
    e = it.select("league_id", "league_name", "season", "loaded_at",
                  F.explode(F.flatten(F.col("item")["league"]["standings"])).alias("e"))
    x = F.col("e")
    return e.select(
        standing_id("league_id", "season", "e.rank").alias("standing_id"),
        "league_id", "league_name", "season",
        x["team"]["id"].alias("team_id"), x["team"]["name"].alias("team_name"),
        x["rank"].alias("rank"), x["points"].alias("points"),
        x["all"]["played"].alias("played"), x["all"]["win"].alias("win"),
        x["all"]["draw"].alias("draw"), x["all"]["lose"].alias("lose"),
        x["all"]["goals"]["for"].alias("goals_for"),
        x["all"]["goals"]["against"].alias("goals_against"),
        x["goalsDiff"].alias("goal_diff"), x["form"].alias("form"),
        F.col("loaded_at").alias("updated_at"), "loaded_at")


def build_standings_payloads(raw_standings: DataFrame) -> DataFrame:
    """Raw standings snapshots -> one document per (league, season, snapshot)
    with two groups (odd and even ranks)."""
    s = raw_standings
    entry = F.struct(
        F.col("rank").alias("rank"), F.col("points").alias("points"),
        (F.col("goals_for") - F.col("goals_against")).alias("goalsDiff"),
        F.col("form").alias("form"),
        F.struct(F.col("team_id").alias("id"), F.col("team_name").alias("name")).alias("team"),
        F.struct(F.col("played").alias("played"), F.col("win").alias("win"),
                 F.col("draw").alias("draw"), F.col("lose").alias("lose"),
                 F.struct(F.col("goals_for").alias("for"),
                          F.col("goals_against").alias("against")).alias("goals")).alias("all"))
    groups = s.groupBy("league_id", "league_name", "season", "updated_at",
                       (F.col("rank") % 2).alias("grp")).agg(F.collect_list(entry).alias("g"))
    docs = groups.groupBy("league_id", "league_name", "season", "updated_at").agg(
        F.collect_list("g").alias("standings"))
    body = F.to_json(F.array(F.struct(F.struct(F.col("standings").alias("standings")).alias("league"))))
    return docs.select(F.lit(None).cast("long").alias("payload_seq"), "league_id", "league_name",
                       "season", F.lit(None).cast("long").alias("fixture_id"),
                       F.col("updated_at").alias("loaded_at"), body.alias("body"))


# --- S07 teams ---------------------------------------------------------------------------------

def flatten_teams(payloads: DataFrame) -> DataFrame:
    """Team documents -> one row per team.

    Items without id are skipped, ``national`` defaults to false.  Duplicates:
    inside one payload the last item wins, across payloads the first payload
    (lowest ``payload_seq``) wins.
    """
    it = _items(payloads, TEAM_ITEM)
    t, v = F.col("item")["team"], F.col("item")["venue"]
    rows = it.filter(t["id"].isNotNull()).select(
        t["id"].alias("team_id"), t["name"].alias("team_name"), t["code"].alias("team_code"),
        t["country"].alias("country"), t["founded"].alias("founded"),
        F.coalesce(t["national"], F.lit(False)).alias("is_national"),
        t["logo"].alias("logo_url"), v["name"].alias("venue_name"),
        v["capacity"].alias("venue_capacity"), F.col("loaded_at").alias("updated_at"),
        "payload_seq", "_pos")
    # row_number() = 1 is limited map-side (WindowGroupLimit) before the shuffle
    w = Window.partitionBy("team_id").orderBy(F.col("payload_seq").asc(), F.col("_pos").desc())
    return (rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .drop("_rn", "payload_seq", "_pos"))


def build_team_payloads(raw_teams_football: DataFrame, raw_fixtures: DataFrame) -> DataFrame:
    """One document per (league, season) listing the teams that played in it;
    a team appears in the documents of every league it played."""
    part = raw_fixtures.select("league_id", "season", F.explode(
        F.array("home_team_id", "away_team_id")).alias("team_id")).distinct()
    t = raw_teams_football
    item = F.struct(
        F.struct(F.col("team_id").alias("id"), F.col("team_name").alias("name"),
                 F.col("team_code").alias("code"), F.col("country").alias("country"),
                 F.col("founded").alias("founded"),
                 F.when(F.col("is_national"), F.lit(True)).alias("national"),
                 F.col("logo_url").alias("logo")).alias("team"),
        F.struct(F.col("venue_name").alias("name"),
                 F.col("venue_capacity").alias("capacity")).alias("venue"))
    j = part.join(t, "team_id", "inner")
    docs = j.groupBy("league_id", "season").agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(F.col("team_id").alias("k"), item.alias("v"))))
                  .getField("v")).alias("body"))
    seq = (F.col("season") * 100 + F.col("league_id")).cast("long")
    return docs.select(seq.alias("payload_seq"), "league_id", F.lit(None).cast("string").alias("league_name"),
                       "season", F.lit(None).cast("long").alias("fixture_id"),
                       F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"), "body")


# --- S08 odds ------------------------------------------------------------------------------------

def flatten_odds(payloads: DataFrame, market: str = "match winner") -> DataFrame:
    """Bookmakers -> bets -> the 1X2 market (case-insensitive) pivoted into
    home/draw/away.  A duplicate outcome label keeps its last value; rows with
    all three prices missing are dropped, and so are rows where a present price
    is not a number."""
    p = _prices(payloads, market).where("not bad")
    return p.select(
        odds_id("fixture_id", "bookmaker_id").alias("odds_id"), "fixture_id", "bookmaker_id",
        "bookmaker_name", F.lit("Match Winner").alias("market_name"),
        F.col("num_h").alias("odd_home"), F.col("num_d").alias("odd_draw"), F.col("num_a").alias("odd_away"), "loaded_at")


def _prices(payloads: DataFrame, market: str = "match winner") -> DataFrame:
    """The three prices of each quote of the market, and ``bad``: one that is present is not a number."""
    it = _items(payloads, ODDS_ITEM)
    bm = it.select("fixture_id", "loaded_at", F.explode(F.col("item")["bookmakers"]).alias("bm"))
    bets = bm.select("fixture_id", "loaded_at", F.col("bm")["id"].alias("bookmaker_id"),
                     F.coalesce(F.col("bm")["name"], F.lit("")).alias("bookmaker_name"),
                     F.explode(F.col("bm")["bets"]).alias("bet"))
    bets = bets.filter(F.lower(F.coalesce(F.col("bet")["name"], F.lit(""))) == market)

    def price(label):
        vals = F.filter(F.col("bet")["values"], lambda v: v["value"] == label)
        return F.when(F.size(vals) > 0, F.element_at(vals, -1)["odd"])

    p = bets.select("fixture_id", "loaded_at", "bookmaker_id", "bookmaker_name",
                    price("Home").alias("h"), price("Draw").alias("d"), price("Away").alias("a"))
    p = p.filter(F.col("h").isNotNull() | F.col("d").isNotNull() | F.col("a").isNotNull())
    # text -> double -> decimal: a price that does not fit counts as not a number
    num = {c: F.expr(f"try_cast(try_cast({c} AS DOUBLE) AS DECIMAL(10,4))") for c in ("h", "d", "a")}
    bad = None
    for c in ("h", "d", "a"):
        cond = F.col(c).isNotNull() & num[c].isNull()
        bad = cond if bad is None else (bad | cond)
    return p.withColumns({**{f"num_{c}": num[c] for c in ("h", "d", "a")}, "bad": bad})


def build_odds_payloads(raw_odds: DataFrame) -> DataFrame:
    """One document per fixture: its bookmakers with the 1X2 market (title
    case, or upper case for odd bookmakers) and a second market."""
    o = raw_odds
    mw = F.struct(
        F.when(F.col("bookmaker_id") % 2 == 1, F.lit("MATCH WINNER")).otherwise(F.lit("Match Winner")).alias("name"),
        F.array(F.struct(F.lit("Home").alias("value"), F.col("odd_home").cast("string").alias("odd")),
                F.struct(F.lit("Draw").alias("value"), F.col("odd_draw").cast("string").alias("odd")),
                F.struct(F.lit("Away").alias("value"), F.col("odd_away").cast("string").alias("odd"))).alias("values"))
    other = F.struct(F.lit("Goals Over/Under").alias("name"),
                     F.array(F.struct(F.lit("Over 2.5").alias("value"), F.lit("1.90").alias("odd"))).alias("values"))
    bm = F.struct(F.col("bookmaker_id").alias("id"), F.col("bookmaker_name").alias("name"),
                  F.when(F.col("market_name") == "Match Winner", F.array(mw, other))
                  .otherwise(F.array(other)).alias("bets"))
    docs = o.groupBy("fixture_id", "loaded_at").agg(F.collect_list(bm).alias("bookmakers"))
    body = F.to_json(F.array(F.struct(F.col("bookmakers").alias("bookmakers"))))
    return docs.select(F.lit(None).cast("long").alias("payload_seq"),
                       F.lit(None).cast("long").alias("league_id"),
                       F.lit(None).cast("string").alias("league_name"),
                       F.lit(None).cast("long").alias("season"), "fixture_id", "loaded_at",
                       body.alias("body"))


_SCHEMAS = {"fixtures": FIXTURE_ITEM, "standings": STANDINGS_ITEM, "teams": TEAM_ITEM, "odds": ODDS_ITEM}
_FLATTEN = {"fixtures": flatten_fixtures, "standings": flatten_standings, "teams": flatten_teams, "odds": flatten_odds}
