"""Staging models: typed, cleaned views over the raw inputs.

Each function is ``raw DataFrame -> DataFrame`` and lazy; filters are written
first so Catalyst pushes them into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.windows import lag_by


def stg_fixtures(raw: DataFrame) -> DataFrame:
    """Finished fixtures with date parts, null goals -> 0 and a result that
    stays NULL when goals were missing (no ELSE branch)."""
    hg, ag = F.col("home_goals"), F.col("away_goals")
    return raw.filter(F.col("status").isin(*C.FINISHED_STATUSES)).select(
        "fixture_id", "league_id", "league_name", "season", "round",
        F.col("match_date").cast("timestamp_ntz").alias("match_date"),
        F.to_date("match_date").alias("match_day"),
        F.year("match_date").cast("long").alias("match_year"),
        F.month("match_date").cast("long").alias("match_month"),
        C.dow_sunday0("match_date").cast("long").alias("day_of_week"),
        "status", "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        F.coalesce(hg, F.lit(0)).alias("home_goals"),
        F.coalesce(ag, F.lit(0)).alias("away_goals"),
        F.coalesce("home_goals_ht", F.lit(0)).alias("home_goals_ht"),
        F.coalesce("away_goals_ht", F.lit(0)).alias("away_goals_ht"),
        (F.coalesce(hg, F.lit(0)) + F.coalesce(ag, F.lit(0))).alias("total_goals"),
        C.match_result(hg, ag).alias("match_result"),
        "venue_name", "referee", "loaded_at",
    )


def stg_odds(raw: DataFrame) -> DataFrame:
    """Valid 1X2 quotes (all odds > 1) with margin-free implied probabilities.

    Probabilities are computed in DECIMAL and rounded to 6 places at every
    step, as in the reference; the division never sees a zero because odds > 1.
    """
    src = raw.filter(F.col("fixture_id").isNotNull() & (F.col("odd_home") > 1)
                     & (F.col("odd_draw") > 1) & (F.col("odd_away") > 1))
    src = src.select(
        "odds_id", "fixture_id", "bookmaker_id", "bookmaker_name", "market_name",
        *[F.col(c).cast("decimal(10,4)").alias(c) for c in ("odd_home", "odd_draw", "odd_away")],
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"))
    probs = C.remove_overround("odd_home", "odd_draw", "odd_away")
    src = src.withColumns({
        "raw_prob_home": probs["raw"][0], "raw_prob_draw": probs["raw"][1],
        "raw_prob_away": probs["raw"][2], "overround": probs["overround"]})
    # probabilities < 1 and the overround (~1.1) fit decimal(12,6): the compact
    # (long-backed) representation keeps later aggregates off BigDecimal
    src = src.withColumn("overround", F.col("overround").cast("decimal(12,6)"))
    src = src.withColumns({
        f"implied_prob_{s}": F.round(F.col(f"raw_prob_{s}") / F.col("overround"), 6).cast("decimal(12,6)")
        for s in ("home", "draw", "away")})
    return src.select(
        "odds_id", "fixture_id", "bookmaker_id", "bookmaker_name", "market_name",
        "odd_home", "odd_draw", "odd_away", "raw_prob_home", "raw_prob_draw",
        "raw_prob_away", "overround", "implied_prob_home", "implied_prob_draw",
        "implied_prob_away", "loaded_at")


def stg_standings(raw: DataFrame, strategy: str = "window") -> DataFrame:
    """Typed standings snapshots plus previous rank and rank change.

    The lag runs per (team, league, season) ordered by ``updated_at``.  A key
    holds one row per snapshot of one season -- at most one per day, so at most
    366 rows whatever the data volume -- hence the plain window is safe here
    (``strategy="auto"``/``"chunked"`` remain available).
    """
    src = raw.filter(F.col("team_id").isNotNull() & F.col("league_id").isNotNull()
                     & F.col("season").isNotNull())
    src = src.select(
        "standing_id", "league_id", "league_name", "season", "team_id", "team_name",
        *[F.col(c).cast("long").alias(c) for c in
          ("rank", "points", "played", "win", "draw", "lose", "goals_for", "goals_against")],
        (F.col("goals_for").cast("long") - F.col("goals_against").cast("long")).alias("goal_difference"),
        F.coalesce("form", F.lit("")).alias("form"),
        "status", "description",
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        "loaded_at")
    out = lag_by(src, {"prev_rank": "rank"}, ["team_id", "league_id", "season"],
                 ["updated_at", "standing_id"], strategy=strategy)
    return out.withColumn("rank_change", F.col("rank") - F.col("prev_rank"))


def stg_teams_football(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("team_id").isNotNull() & F.col("team_name").isNotNull()).select(
        "team_id", "team_name",
        F.coalesce("team_code", F.lit("")).alias("team_code"),
        "country",
        F.col("founded").alias("founded_year"),
        F.col("is_national").cast("boolean").alias("is_national"),
        "logo_url", "venue_id", "venue_name", "venue_city", "venue_country",
        F.col("venue_capacity").cast("long").alias("venue_capacity"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))


def stg_matches(raw: DataFrame) -> DataFrame:
    """Legacy matches: result with ELSE DRAW, total stays NULL on null goals."""
    hg, ag = F.col("home_goals").cast("long"), F.col("away_goals").cast("long")
    return raw.filter(F.col("match_id").isNotNull() & F.col("match_date").isNotNull()).select(
        "match_id",
        F.col("match_date").cast("date").alias("match_date"),
        "home_team_id", "away_team_id",
        hg.alias("home_goals"), ag.alias("away_goals"),
        F.coalesce("competition_id", F.lit("UNKNOWN")).alias("competition_id"),
        (hg + ag).alias("total_goals"),
        C.match_result(hg, ag, else_draw=True).alias("match_result"),
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"))


def stg_teams(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("team_id").isNotNull() & F.col("team_name").isNotNull()).select(
        "team_id",
        F.trim("team_name").alias("team_name"),
        F.coalesce(F.trim("country"), F.lit("UNKNOWN")).alias("country"),
        F.col("founded_year").cast("long").alias("founded_year"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"))
