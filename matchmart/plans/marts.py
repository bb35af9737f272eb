"""Mart models: dimensions and facts (A01, A06-A08, U02-U06, W05, W07,
J04, J05, J08, J09).

Dimension joins: ``dim_league`` and ``dim_team_football`` are aggregates whose
size follows the number of leagues / teams, not the number of matches.  They
are joined with plain ``join`` calls; AQE turns those into broadcast joins only
after measuring the materialised dimension below the configured byte limit,
and keeps a sort-merge join (with skew splitting) otherwise.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.joins import Lookup
from ..operators.windows import top_n
from . import intermediate as I

# Fixed audit timestamp used when the caller gives none (keeps reruns equal).
DEFAULT_RUN_TS = _dt.datetime(2024, 6, 1, 0, 0, 0)


def _ts(run_ts) -> F.Column:
    """Audit timestamp literal, built from text so the session time zone
    cannot shift it."""
    return C.ts_lit(run_ts or DEFAULT_RUN_TS)


def _rate(c) -> F.Column:
    return F.avg(F.when(c, 1.0).otherwise(0.0))


# --- league dimension ------------------------------------------------------------

def all_leagues(stg_fixtures: DataFrame, stg_standings: DataFrame) -> DataFrame:
    """UNION (distinct) of the leagues seen in fixtures and standings."""
    a = stg_fixtures.filter(F.col("league_id").isNotNull()).select("league_id", "league_name").distinct()
    b = stg_standings.filter(F.col("league_id").isNotNull()).select("league_id", "league_name").distinct()
    return a.union(b).distinct()


def league_seasons(stg_fixtures: DataFrame) -> DataFrame:
    """first/last/count of seasons and the sorted distinct season list."""
    s = F.col("season")
    # the season set per league is bounded by the calendar
    out = stg_fixtures.groupBy("league_id").agg(
        F.min(s).alias("first_season"), F.max(s).alias("last_season"),
        F.sort_array(F.collect_set(s)).alias("available_seasons"))
    return out.withColumn("total_seasons", F.size("available_seasons").cast("long")).select(
        "league_id", "first_season", "last_season", "total_seasons", "available_seasons")


def league_stats(stg_fixtures: DataFrame) -> DataFrame:
    """Matches, average goals and home/draw/away rates per league."""
    r = F.col("match_result")
    return stg_fixtures.groupBy("league_id").agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.round(F.avg("total_goals"), 3).alias("avg_goals_per_match"),
        F.round(_rate(r == C.HOME_WIN), 4).alias("home_win_rate"),
        F.round(_rate(r == C.DRAW), 4).alias("draw_rate"),
        F.round(_rate(r == C.AWAY_WIN), 4).alias("away_win_rate"))


def dim_league(stg_fixtures: DataFrame, stg_standings: DataFrame) -> DataFrame:
    """The league dimension."""
    al = all_leagues(stg_fixtures, stg_standings)
    sp = league_seasons(stg_fixtures)
    ls = league_stats(stg_fixtures)
    j = al.join(sp, "league_id", "left").join(ls, "league_id", "left")
    return j.select(
        "league_id", "league_name",
        C.league_type("league_name").alias("league_type"),
        "first_season", "last_season",
        F.coalesce("total_seasons", F.lit(0)).alias("total_seasons"),
        "available_seasons",
        F.coalesce("total_matches", F.lit(0)).alias("total_matches"),
        "avg_goals_per_match", "home_win_rate", "draw_rate", "away_win_rate")


# --- team dimension --------------------------------------------------------------

def side_participation(stg_fixtures: DataFrame) -> DataFrame:
    """UNION ALL of the home-side and away-side aggregates."""
    def per_side(team_col):
        # league and season sets per team are small and bounded
        return stg_fixtures.groupBy(F.col(team_col).alias("team_id")).agg(
            F.size(F.collect_set("league_id")).cast("long").alias("leagues_played"),
            F.size(F.collect_set("season")).cast("long").alias("seasons_played"),
            F.count(F.lit(1)).alias("total_home_matches"))
    return per_side("home_team_id").unionByName(per_side("away_team_id"))


def team_participation(stg_fixtures: DataFrame) -> DataFrame:
    """Max of per-side distinct counts, sum of matches (reference rule)."""
    return side_participation(stg_fixtures).groupBy("team_id").agg(
        F.max("leagues_played").alias("leagues_played"),
        F.max("seasons_played").alias("seasons_played"),
        F.sum("total_home_matches").alias("total_matches"))


def team_enrich(stg_teams_football: DataFrame, stg_fixtures: DataFrame) -> DataFrame:
    """Team rows left-joined to their participation aggregates."""
    s = team_participation(stg_fixtures)
    j = stg_teams_football.join(s, "team_id", "left")
    return j.withColumns({c: F.coalesce(c, F.lit(0)) for c in
                          ("leagues_played", "seasons_played", "total_matches")})


def dim_team_football(stg_teams_football: DataFrame, stg_fixtures: DataFrame,
                      run_ts=None) -> DataFrame:
    """Team dimension with surrogate key and participation."""
    j = team_enrich(stg_teams_football, stg_fixtures)
    return j.select(
        C.surrogate_key("team_id").alias("team_sk"),
        "team_id", "team_name", "team_code", "country", "founded_year", "is_national",
        "logo_url", "venue_id", "venue_name", "venue_city", "venue_country", "venue_capacity",
        "leagues_played", "seasons_played", "total_matches", "updated_at",
        _ts(run_ts).alias("dbt_loaded_at"))


def dim_team(stg_teams: DataFrame) -> DataFrame:
    """Legacy team dimension with surrogate key."""
    return stg_teams.select(C.surrogate_key("team_id").alias("team_sk"), "team_id",
                            "team_name", "country", "founded_year", "updated_at")


# --- standings fact ----------------------------------------------------------------

def latest_standings(stg_standings: DataFrame) -> DataFrame:
    """The latest snapshot per (team, league, season)."""
    return top_n(stg_standings, ["team_id", "league_id", "season"],
                 [F.col("updated_at").desc(), F.col("standing_id").desc()], 1)


def fct_standings(stg_standings: DataFrame, dim_team_fb: DataFrame,
                  dim_lg: DataFrame) -> DataFrame:
    """Current table with per-game ratios, movement and dimensions."""
    cs = latest_standings(stg_standings)
    dt = dim_team_fb.select("team_id", "team_sk")
    dl = dim_lg.select("league_id", "league_type",
                       F.col("avg_goals_per_match").alias("league_avg_goals"),
                       F.col("home_win_rate").alias("league_home_win_rate"))
    j = cs.join(dt, "team_id", "left").join(dl, "league_id", "left")

    def ratio(c, places):
        return F.round(C.safe_div(F.col(c), F.col("played")), places)

    return j.select(
        C.surrogate_key("league_id", "season", "team_id").alias("standing_sk"),
        "league_id", "league_name", "season", "team_id", "team_name", "team_sk",
        "rank", "prev_rank",
        F.coalesce("rank_change", F.lit(0)).alias("rank_change"),
        C.rank_movement("rank_change").alias("rank_movement"),
        "points", "played", "win", "draw", "lose", "goals_for", "goals_against",
        "goal_difference",
        ratio("goals_for", 3).alias("avg_goals_scored"),
        ratio("goals_against", 3).alias("avg_goals_conceded"),
        ratio("points", 3).alias("avg_points_per_game"),
        ratio("win", 4).alias("win_rate"),
        ratio("draw", 4).alias("draw_rate"),
        ratio("lose", 4).alias("loss_rate"),
        "form", "status", "description", "updated_at",
        "league_type", "league_avg_goals", "league_home_win_rate")


# --- match feature fact --------------------------------------------------------------

def role_playing_dims(features: DataFrame, dim_team_fb: DataFrame,
                      dim_lg: DataFrame) -> DataFrame:
    """The team dimension joined twice (home, away) plus the league."""
    team = Lookup(dim_team_fb.select("team_id", "team_sk"))
    league = Lookup(dim_lg.select("league_id", "league_type"))
    j = team.join(features, {"home_team_id": "team_id"}, {"home_team_sk": "team_sk"}, "fixture_id")
    j = team.join(j, {"away_team_id": "team_id"}, {"away_team_sk": "team_sk"}, "fixture_id")
    return league.join(j, {"league_id": "league_id"}, {"league_type": "league_type"}, "fixture_id")


def fct_match_features(features: DataFrame, dim_team_fb: DataFrame, dim_lg: DataFrame,
                       run_ts=None) -> DataFrame:
    """The feature fact (keys, encoded target, derived features)."""
    j = role_playing_dims(features, dim_team_fb, dim_lg)
    form_home = [F.col(f"home_{c}") for c in I.FORM_COLUMNS]
    form_away = [F.col(f"away_{c}") for c in I.FORM_COLUMNS]
    return j.select(
        "fixture_id", "home_team_sk", "away_team_sk", "league_type",
        "league_id", "league_name", "season", "round", "match_date", "match_day",
        "match_year", "match_month", "day_of_week",
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        "match_result",
        C.encode_target("match_result").alias("match_result_encoded"),
        "home_goals", "away_goals", "total_goals", "home_goals_ht", "away_goals_ht",
        *form_home, *form_away,
        "form_diff_points_l5", "form_diff_points_l10",
        (F.col("home_avg_goals_scored_l5") - F.col("away_avg_goals_conceded_l5"))
        .alias("home_attack_vs_away_defense_l5"),
        (F.col("away_avg_goals_scored_l5") - F.col("home_avg_goals_conceded_l5"))
        .alias("away_attack_vs_home_defense_l5"),
        "h2h_total_matches", "h2h_home_wins", "h2h_draws", "h2h_away_wins",
        "h2h_avg_goals", "h2h_home_win_rate", "h2h_draw_rate",
        "venue_name", "venue_total_matches", "venue_home_win_rate",
        "venue_avg_home_goals", "venue_avg_away_goals",
        "odds_implied_prob_home", "odds_implied_prob_draw", "odds_implied_prob_away",
        "avg_odd_home", "avg_odd_draw", "avg_odd_away", "bookmaker_count",
        C.has_odds("bookmaker_count").alias("has_odds"),
        "loaded_at", _ts(run_ts).alias("dbt_loaded_at"))


# --- legacy marts ------------------------------------------------------------------------

def season_stats(team_perf: DataFrame, run_ts=None) -> DataFrame:
    """Per team and calendar year.  The season is derived before the key
    (the reference refers to the alias in the same SELECT)."""
    p = F.col("points")
    tp = team_perf.withColumn("season", F.year("match_date").cast("long"))
    agg = tp.groupBy("team_id", "team_name", "season").agg(
        F.count("match_id").alias("total_matches"),
        F.sum(p).cast("long").alias("total_points"),
        F.sum("goals_scored").cast("long").alias("total_goals_scored"),
        F.sum("goals_conceded").cast("long").alias("total_goals_conceded"),
        F.sum("goal_diff").cast("long").alias("total_goal_diff"),
        F.sum(F.when(p == 3, 1).otherwise(0)).cast("long").alias("wins"),
        F.sum(F.when(p == 1, 1).otherwise(0)).cast("long").alias("draws"),
        F.sum(F.when(p == 0, 1).otherwise(0)).cast("long").alias("losses"),
        F.round(C.safe_div(F.sum(F.when(p == 3, 1).otherwise(0)), F.count("match_id")), 3)
        .alias("win_rate"),
        # exact (DECIMAL) sums: the mean is independent of summation order
        F.round(F.avg(F.col("rolling_points_avg").cast("decimal(18,12)")), 3).alias("avg_rolling_form"),
        F.round(F.avg(F.col("rolling_goals_avg").cast("decimal(18,12)")), 3).alias("avg_rolling_goals"))
    return agg.select(C.surrogate_key("team_id", "season").alias("stat_sk"), "team_id",
                      "team_name", "season", "total_matches", "total_points",
                      "total_goals_scored", "total_goals_conceded", "total_goal_diff",
                      "wins", "draws", "losses", "win_rate", "avg_rolling_form",
                      "avg_rolling_goals", _ts(run_ts).alias("updated_at"))


def match_facts_legacy(stg_matches: DataFrame, team_perf_with_side: DataFrame) -> DataFrame:
    """Legacy match fact with form indices (first, full load).

    The two perspective rows of a match are pivoted into one row by
    ``groupBy(match_id)`` instead of joining the form table twice.
    """
    tp = team_perf_with_side
    aggs = []
    for side in ("home", "away"):
        is_s = F.col("perspective") == side.upper()
        aggs += [F.max(F.when(is_s, F.col("team_id"))).alias(f"_{side}_tid"),
                 F.max(F.when(is_s, F.col("rolling_points_avg"))).alias(f"_{side}_form"),
                 F.max(F.when(is_s, F.col("rolling_goals_avg"))).alias(f"_{side}_goals"),
                 F.max(F.when(is_s, F.col("team_name"))).alias(f"{side}_team_name")]
    pv = tp.groupBy("match_id").agg(*aggs)
    m = stg_matches.join(pv, "match_id", "left")

    def side_val(side, c):
        return F.when(F.col(f"_{side}_tid") == F.col(f"{side}_team_id"), F.col(c))

    hf = F.coalesce(side_val("home", "_home_form"), F.lit(0.0))
    af = F.coalesce(side_val("away", "_away_form"), F.lit(0.0))
    return m.select(
        "match_id", "match_date", "competition_id",
        "home_team_id", side_val("home", "home_team_name").alias("home_team_name"),
        "away_team_id", side_val("away", "away_team_name").alias("away_team_name"),
        "home_goals", "away_goals", "total_goals", "match_result",
        hf.alias("home_form_index"), af.alias("away_form_index"),
        F.coalesce(side_val("home", "_home_goals"), F.lit(0.0)).alias("home_rolling_goals"),
        F.coalesce(side_val("away", "_away_goals"), F.lit(0.0)).alias("away_rolling_goals"),
        (hf - af).alias("home_advantage_index"),
        "loaded_at")
