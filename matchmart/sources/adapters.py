"""Driver tables -> canonical raw inputs.

The test bed ships TPC-H-like tables, not match data.  Every raw table the
library consumes is derived here from them with plain column arithmetic, so the
raw inputs grow with the driver tables and every downstream job does real work
at every scale factor.  The same formulas are written as SQL in
``oracle.adapters`` for the DuckDB oracle.

All integer columns are LONG (ids at 100 TB scale do not fit INT).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

# League names by orderkey % 6 (cover all three league types).
LEAGUE_NAMES = ["Alpha League", "Bravo Cup", "Copa Norte", "Champions Series",
                "Nations Trophy", "Delta League"]
N_TEAMS = 40
N_BOOKMAKERS = 3
FINISHED = ("FT", "AET", "PEN")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _str(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _pick(index: Column, values: list[str]) -> Column:
    out = None
    for i, v in enumerate(values):
        out = F.when(index == i, F.lit(v)) if out is None else out.when(index == i, F.lit(v))
    return out


def raw_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    hk = F.col("o_custkey") % N_TEAMS
    p1 = F.floor(F.col("o_totalprice")).cast("long")
    p2 = F.floor(F.col("o_totalprice") / 7).cast("long")
    status = (F.when(F.col("o_orderstatus") == "F", "FT")
              .when((F.col("o_orderstatus") == "P") & (k % 2 == 0), "AET")
              .when(F.col("o_orderstatus") == "P", "PEN")
              .otherwise("NS"))
    no_goals = (status == "NS") | (k % 97 == 0)
    hg, ag = p1 % 5, p2 % 4
    home_id = (hk + 1).cast("long")
    away_id = ((hk + 1 + k % 39) % N_TEAMS + 1).cast("long")
    return o.select(
        k.cast("long").alias("fixture_id"),
        (k % 6 + 1).cast("long").alias("league_id"),
        _pick(k % 6, LEAGUE_NAMES).alias("league_name"),
        F.year("o_orderdate").cast("long").alias("season"),
        _str("Round ", F.month("o_orderdate")).alias("round"),
        F.col("o_orderdate").alias("match_date"),
        status.alias("status"),
        home_id.alias("home_team_id"),
        _str("Team ", home_id).alias("home_team_name"),
        away_id.alias("away_team_id"),
        _str("Team ", away_id).alias("away_team_name"),
        F.when(~no_goals, hg).alias("home_goals"),
        F.when(~no_goals, ag).alias("away_goals"),
        F.when(~no_goals, hg - hg % 2).alias("home_goals_ht"),
        F.when(~no_goals, ag % 2).alias("away_goals_ht"),
        F.when(k % 17 != 0, _str("Stadium ", hk % 25)).alias("venue_name"),
        _str("Ref ", k % 31).alias("referee"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("loaded_at"),
    )


def raw_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture x bookmaker 1..3 -> one 1X2 quote row; every fifth fixture has no quote
    (missing odds are what ``has_odds`` and ``null_default`` are about).

    The bookmaker fan-out is an ``explode`` of a literal array, not a join.
    """
    fx = raw_fixtures(spark, sf_dir).select("fixture_id", "loaded_at")
    fx = fx.filter(F.col("fixture_id") % 5 != 0)
    fx = fx.withColumn("b", F.explode(F.array(*[F.lit(i) for i in range(1, N_BOOKMAKERS + 1)]).cast("array<long>")))
    f, b = F.col("fixture_id"), F.col("b")

    def price(base, a, c, m):
        return ((base + (f * a + b * c) % m) / 100.0).cast("decimal(10,4)")

    return fx.select(
        (f * 1000 + b).alias("odds_id"),
        f.alias("fixture_id"),
        b.alias("bookmaker_id"),
        _str("Book ", b).alias("bookmaker_name"),
        F.when(f % 11 == 0, "Goals Over/Under").otherwise("Match Winner").alias("market_name"),
        price(90, 7, 13, 400).alias("odd_home"),
        price(250, 3, 7, 200).alias("odd_draw"),
        price(110, 11, 5, 600).alias("odd_away"),
        F.col("loaded_at"),
    )


def raw_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly standings snapshots built from finished fixtures with goals.

    Pre-aggregated per (team, league, season, month) with map-side partial
    aggregation; the rank window is partitioned by (league, season, month),
    whose size is bounded by the number of teams in a league.
    """
    fx = raw_fixtures(spark, sf_dir).filter(
        F.col("status").isin(*FINISHED) & F.col("home_goals").isNotNull()
        & F.col("away_goals").isNotNull())
    side = F.explode(F.array(
        F.struct(F.col("home_team_id").alias("team_id"),
                 F.col("home_goals").alias("gf"), F.col("away_goals").alias("ga")),
        F.struct(F.col("away_team_id").alias("team_id"),
                 F.col("away_goals").alias("gf"), F.col("home_goals").alias("ga")),
    )).alias("s")
    app = fx.select("league_id", "league_name", "season",
                    F.date_trunc("month", "match_date").cast("timestamp_ntz").alias("updated_at"), side)
    app = app.select("league_id", "league_name", "season", "updated_at", "s.*")
    gf, ga = F.col("gf"), F.col("ga")
    agg = app.groupBy("team_id", "league_id", "season", "updated_at").agg(
        F.max("league_name").alias("league_name"),
        F.sum(F.when(gf > ga, 3).when(gf == ga, 1).otherwise(0)).cast("long").alias("points"),
        F.count(F.lit(1)).alias("played"),
        F.sum(F.when(gf > ga, 1).otherwise(0)).cast("long").alias("win"),
        F.sum(F.when(gf == ga, 1).otherwise(0)).cast("long").alias("draw"),
        F.sum(F.when(gf < ga, 1).otherwise(0)).cast("long").alias("lose"),
        F.sum(gf).cast("long").alias("goals_for"),
        F.sum(ga).cast("long").alias("goals_against"),
    )
    from pyspark.sql import Window
    w = Window.partitionBy("league_id", "season", "updated_at").orderBy(
        F.col("points").desc(), (F.col("goals_for") - F.col("goals_against")).desc(),
        F.col("team_id").asc())
    agg = agg.withColumn("rank", F.row_number().over(w).cast("long"))
    month = F.month("updated_at")
    return agg.select(
        (F.col("league_id") * 10_000_000 + F.col("season") * 1_000 + F.col("rank")).alias("standing_id"),
        "league_id", "league_name", "season", "team_id",
        _str("Team ", F.col("team_id")).alias("team_name"),
        "rank", "points", "played", "win", "draw", "lose", "goals_for", "goals_against",
        F.when(month % 2 == 1, _str("M", month)).alias("form"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("description"),
        "updated_at",
        (F.col("updated_at") + F.expr("INTERVAL 1 DAY")).alias("loaded_at"),
    )


def raw_teams_football(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    c = F.col("c_custkey")
    tid = (c + 1).cast("long")
    # nation is a fixed 25-row reference table: broadcast is size-bounded.
    j = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
    return j.select(
        tid.alias("team_id"),
        _str("Team ", tid).alias("team_name"),
        F.when(c % 4 != 0, _str("T", tid)).alias("team_code"),
        F.col("n_name").alias("country"),
        F.when(c % 9 != 0, 1880 + 3 * (c % N_TEAMS)).cast("long").alias("founded"),
        (c % 13 == 0).alias("is_national"),
        F.lit("https://img.example/logo.png").alias("logo_url"),
        (c % 25).cast("long").alias("venue_id"),
        _str("Stadium ", c % 25).alias("venue_name"),
        F.lit("Capital").alias("venue_city"),
        F.col("n_name").alias("venue_country"),
        (10000 + 500 * c).cast("long").alias("venue_capacity"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )


def raw_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = raw_fixtures(spark, sf_dir)
    f = F.col("fixture_id")
    x = (f * 7 % 50 + 1).cast("double")
    y = (f * 11 % 40 + 1).cast("double")
    z = (f * 13 % 45 + 1).cast("double")
    s = x + y + z
    return fx.select(
        f.alias("fixture_id"),
        (z / s).alias("poisson_home_prob"), (x / s).alias("poisson_draw_prob"),
        (y / s).alias("poisson_away_prob"),
        (y / s).alias("gb_home_prob"), (z / s).alias("gb_draw_prob"),
        (x / s).alias("gb_away_prob"),
        (x / s).alias("hybrid_home_prob"), (y / s).alias("hybrid_draw_prob"),
        (z / s).alias("hybrid_away_prob"),
        ((f * 7 % 30) / 10.0).alias("expected_home_goals"),
        ((f * 11 % 25) / 10.0).alias("expected_away_goals"),
        (F.greatest(x, y, z) / s).alias("confidence_score"),
        _str("v", f % 2 + 1).alias("model_version"),
        F.col("loaded_at").alias("predicted_at"),
    )


def raw_team_roster(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    c = F.col("c_custkey")
    if version == 1:
        rows = cust.filter(c % 26 != 25)  # the others sign before the second load
        team = c % N_TEAMS + 1
        upd = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    else:
        rows = cust.filter(c % 25 != 7)  # those have left
        moved = c % 10 == 0
        team = F.when(moved, (c + 1) % N_TEAMS + 1).otherwise(c % N_TEAMS + 1)
        upd = F.when(moved, F.lit("2024-02-01 00:00:00")).otherwise(
            F.lit("2024-01-01 00:00:00")).cast("timestamp_ntz")
    return rows.select(
        c.cast("string").alias("player_id"),
        _str("t", team).alias("team_id"),
        F.col("c_name").alias("player_name"),
        F.col("c_mktsegment").alias("position"),
        upd.alias("updated_at"),
    )


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy match table: finished fixtures with string ids."""
    fx = raw_fixtures(spark, sf_dir).filter(F.col("status").isin(*FINISHED))
    f = F.col("fixture_id")
    return fx.select(
        _str("m", f).alias("match_id"),
        F.to_date("match_date").alias("match_date"),
        _str("t", F.col("home_team_id")).alias("home_team_id"),
        _str("t", F.col("away_team_id")).alias("away_team_id"),
        "home_goals", "away_goals",
        F.when(f % 13 != 0, F.concat(F.lit("c"), F.lpad(F.col("league_id").cast("string"), 3, "0")))
        .alias("competition_id"),
        "loaded_at",
    )


def raw_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy team table with padded names and missing countries."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    c = F.col("c_custkey")
    tid = c + 1
    name = _str("Team ", tid)
    j = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
    return j.select(
        _str("t", tid).alias("team_id"),
        F.when(c % 3 == 0, F.concat(F.lit("  "), name, F.lit(" "))).otherwise(name).alias("team_name"),
        F.when(c % 7 != 0, F.col("n_name")).alias("country"),
        F.when(c % 9 != 0, 1880 + 3 * (c % N_TEAMS)).cast("long").alias("founded_year"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )


class Raw:
    """Lazy accessor for all raw inputs of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name):
        fn = {
            "fixtures": raw_fixtures, "odds": raw_odds, "standings": raw_standings,
            "teams_football": raw_teams_football, "predictions": raw_predictions,
            "matches": raw_matches, "teams": raw_teams,
        }.get(name)
        if fn is None:
            raise AttributeError(name)
        return fn(self.spark, self.sf_dir)

    def roster(self, version: int) -> DataFrame:
        return raw_team_roster(self.spark, self.sf_dir, version)

