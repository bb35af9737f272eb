"""Intermediate models: appearances, team form, head-to-head, odds consensus,
venue advantage and the per-match feature vector (U01, W01, W02, W04, W06,
A03, A04, A05, J01-J03, J07).

Plan notes
* Appearances are an unpivot of one fixture scan (``explode`` of a two-element
  array), never a union of two scans.
* Team form runs the rolling window with the ``auto`` strategy (see
  ``operators.windows``): keys above the hot-key threshold take the chunked
  window, whose only full shuffle is on (team, league, season, day).
* The feature join pivots the two form rows of a fixture back into one row
  with a ``groupBy(fixture_id)`` instead of joining the form table twice; the
  pivot, the odds consensus and the fixtures then meet on ``fixture_id`` with
  one exchange per side.  H2H and venue tables are per pair / per venue and are
  broadcast by AQE only when their measured size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.joins import Lookup
from ..operators.windows import rolling_avg, top_n

FORM_METRICS = [("avg_points", "points"), ("avg_goals_scored", "goals_scored"),
                ("avg_goals_conceded", "goals_conceded"), ("win_rate", "is_win")]
FORM_WINDOWS = (5, 10)
FORM_COLUMNS = [f"{m}_l{n}" for n in FORM_WINDOWS for m, _ in FORM_METRICS]


def appearances(stg_fixtures: DataFrame) -> DataFrame:
    """One row per team per fixture (U01), points 3/1/0 and win flag (P10)."""
    r = F.col("match_result")

    def side(team, scored, conceded, win_value, label):
        return F.struct(
            F.col(team).alias("team_id"),
            F.col(scored).alias("goals_scored"),
            F.col(conceded).alias("goals_conceded"),
            C.points(r, win_value).alias("points"),
            C.win_flag(r, win_value).alias("is_win"),
            F.lit(label).alias("perspective"))

    sides = F.explode(F.array(
        side("home_team_id", "home_goals", "away_goals", C.HOME_WIN, "HOME"),
        side("away_team_id", "away_goals", "home_goals", C.AWAY_WIN, "AWAY"))).alias("a")
    return (stg_fixtures.select("league_id", "season", "match_date", "fixture_id", sides)
            .select(F.col("a.team_id").alias("team_id"), "league_id", "season",
                    "match_date", "fixture_id", "a.goals_scored", "a.goals_conceded",
                    "a.points", "a.is_win", "a.perspective"))


def team_form(stg_fixtures: DataFrame, strategy: str = "auto",
              include_current: bool = True) -> DataFrame:
    """Rolling 5- and 10-match form per (team, league, season)."""
    app = appearances(stg_fixtures)
    specs = {f"{m}_l{n}": (src, n) for n in FORM_WINDOWS for m, src in FORM_METRICS}
    return rolling_avg(app, specs, ["team_id", "league_id", "season"],
                       ["match_date", "fixture_id"], strategy=strategy,
                       include_current=include_current)


def h2h_last_n(stg_fixtures: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` meetings of every unordered pair (most recent first)."""
    fx = stg_fixtures.select(
        "fixture_id", "match_date", "league_id", "season", "home_team_id", "away_team_id",
        "home_goals", "away_goals", "total_goals", "match_result",
        C.pair_low("home_team_id", "away_team_id").alias("team_a_id"),
        C.pair_high("home_team_id", "away_team_id").alias("team_b_id"))
    return top_n(fx, ["team_a_id", "team_b_id"],
                 [F.col("match_date").desc(), F.col("fixture_id").desc()], n,
                 rank_col="h2h_rank")


def head_to_head(stg_fixtures: DataFrame, n: int = 5) -> DataFrame:
    """Per-pair statistics over the last ``n`` meetings."""
    last = h2h_last_n(stg_fixtures, n)
    r = F.col("match_result")
    agg = last.groupBy("team_a_id", "team_b_id").agg(
        F.count(F.lit(1)).alias("h2h_total_matches"),
        F.sum(F.when(r == C.HOME_WIN, 1).otherwise(0)).cast("long").alias("h2h_home_wins"),
        F.sum(F.when(r == C.DRAW, 1).otherwise(0)).cast("long").alias("h2h_draws"),
        F.sum(F.when(r == C.AWAY_WIN, 1).otherwise(0)).cast("long").alias("h2h_away_wins"),
        F.round(F.avg("total_goals"), 3).alias("h2h_avg_goals"),
        F.round(F.avg("home_goals"), 3).alias("h2h_avg_home_goals"),
        F.round(F.avg("away_goals"), 3).alias("h2h_avg_away_goals"),
        F.max("match_date").alias("h2h_last_match_date"),
        F.min("match_date").alias("h2h_first_match_date"))
    return agg.withColumns({
        "h2h_home_win_rate": F.round(C.safe_div("h2h_home_wins", "h2h_total_matches"), 3),
        "h2h_draw_rate": F.round(C.safe_div("h2h_draws", "h2h_total_matches"), 3)})


def odds_consensus(stg_odds: DataFrame, market: str = "Match Winner") -> DataFrame:
    """Bookmaker-average implied probabilities and prices per fixture."""
    o = stg_odds.filter(F.col("market_name") == market)
    return o.groupBy("fixture_id").agg(
        *[F.round(F.avg(f"implied_prob_{s}"), 4).cast("double").alias(f"odds_implied_prob_{s}")
          for s in ("home", "draw", "away")],
        *[F.round(F.avg(f"odd_{s}"), 4).cast("double").alias(f"avg_odd_{s}")
          for s in ("home", "draw", "away")],
        # bounded by bookmakers per fixture; one aggregation level, no Expand
        F.size(F.collect_set("bookmaker_name")).cast("long").alias("bookmaker_count"))


def venue_advantage(stg_fixtures: DataFrame) -> DataFrame:
    """Home record of each home team at each venue (all history)."""
    f = stg_fixtures.filter(F.col("venue_name").isNotNull())
    return f.groupBy("venue_name", "home_team_id").agg(
        F.count(F.lit(1)).alias("venue_total_matches"),
        F.round(F.avg(F.when(F.col("match_result") == C.HOME_WIN, 1.0).otherwise(0.0)), 4)
        .alias("venue_home_win_rate"),
        F.round(F.avg("home_goals"), 4).alias("venue_avg_home_goals"),
        F.round(F.avg("away_goals"), 4).alias("venue_avg_away_goals"))


def form_by_fixture(form: DataFrame) -> DataFrame:
    """Pivot the HOME and AWAY form rows of each fixture into one row."""
    aggs = []
    for p, prefix in (("HOME", "home"), ("AWAY", "away")):
        is_p = F.col("perspective") == p
        aggs.append(F.max(F.when(is_p, F.col("team_id"))).alias(f"_{prefix}_form_team"))
        aggs += [F.max(F.when(is_p, F.col(c))).alias(f"{prefix}_{c}") for c in FORM_COLUMNS]
    return form.groupBy("fixture_id").agg(*aggs)


def match_features(stg_fixtures: DataFrame, stg_odds: DataFrame,
                   form: DataFrame | None = None, strategy: str = "auto") -> DataFrame:
    """One feature row per finished fixture."""
    form = form if form is not None else team_form(stg_fixtures, strategy=strategy)
    fb = form_by_fixture(form)
    h2h = head_to_head(stg_fixtures).drop("h2h_avg_home_goals", "h2h_avg_away_goals",
                                          "h2h_last_match_date", "h2h_first_match_date")
    odds = odds_consensus(stg_odds)
    venue = venue_advantage(stg_fixtures)

    f = stg_fixtures.withColumns({
        "_pair_a": C.pair_low("home_team_id", "away_team_id"),
        "_pair_b": C.pair_high("home_team_id", "away_team_id")})
    j = f.join(fb, "fixture_id", "left").join(odds, "fixture_id", "left")
    # Pair and venue tables are aggregates of the fixtures: measured, then broadcast or salted.
    j = Lookup(h2h).join(j, {"_pair_a": "team_a_id", "_pair_b": "team_b_id"},
                         {c: c for c in h2h.columns if not c.startswith("team_")}, "fixture_id")
    j = Lookup(venue).join(j, {"venue_name": "venue_name", "home_team_id": "home_team_id"},
                           {c: c for c in venue.columns if c.startswith("venue_") and c != "venue_name"}, "fixture_id")

    def z(c):
        return F.coalesce(F.col(c), F.lit(0))

    def form_col(prefix, c, team_col):
        # the pivoted row belongs to this side's team (join on fixture and team)
        return F.when(F.col(f"_{prefix}_form_team") == F.col(team_col), F.col(f"{prefix}_{c}"))

    form_cols = {}
    for prefix, team_col in (("home", "home_team_id"), ("away", "away_team_id")):
        for c in FORM_COLUMNS:
            form_cols[f"{prefix}_{c}"] = F.coalesce(form_col(prefix, c, team_col), F.lit(0.0))
    j = j.withColumns(form_cols)
    h2h_cols = ["h2h_total_matches", "h2h_home_wins", "h2h_draws", "h2h_away_wins",
                "h2h_avg_goals", "h2h_home_win_rate", "h2h_draw_rate"]
    venue_cols = ["venue_total_matches", "venue_home_win_rate", "venue_avg_home_goals",
                  "venue_avg_away_goals"]
    return j.select(
        "fixture_id", "league_id", "league_name", "season", "round", "match_date",
        "match_day", "match_year", "match_month", "day_of_week",
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        "match_result", "home_goals", "away_goals", "total_goals", "home_goals_ht",
        "away_goals_ht", "venue_name",
        *[F.col(f"home_{c}") for c in FORM_COLUMNS],
        *[F.col(f"away_{c}") for c in FORM_COLUMNS],
        (F.col("home_avg_points_l5") - F.col("away_avg_points_l5")).alias("form_diff_points_l5"),
        (F.col("home_avg_points_l10") - F.col("away_avg_points_l10")).alias("form_diff_points_l10"),
        *[z(c).alias(c) for c in h2h_cols],
        *[z(c).alias(c) for c in venue_cols],
        "odds_implied_prob_home", "odds_implied_prob_draw", "odds_implied_prob_away",
        "avg_odd_home", "avg_odd_draw", "avg_odd_away", "bookmaker_count",
        "loaded_at")


def team_performance(stg_matches: DataFrame, stg_teams: DataFrame,
                     strategy: str = "auto", keep_side: bool = False) -> DataFrame:
    """W06 (legacy): rolling 5-match points and goals per team over all
    competitions and seasons, plus the team name.  ``keep_side`` keeps the
    HOME/AWAY perspective column for the match-level pivot."""
    r = F.col("match_result")

    def side(team, scored, conceded, win_value, label):
        return F.struct(F.col(team).alias("team_id"), F.col(scored).alias("goals_scored"),
                        F.col(conceded).alias("goals_conceded"),
                        C.points(r, win_value).alias("points"),
                        F.lit(label).alias("perspective"))

    app = stg_matches.select("match_date", "match_id", F.explode(F.array(
        side("home_team_id", "home_goals", "away_goals", C.HOME_WIN, "HOME"),
        side("away_team_id", "away_goals", "home_goals", C.AWAY_WIN, "AWAY"))).alias("a"))
    app = app.select("a.team_id", "match_id", "match_date", "a.goals_scored",
                     "a.goals_conceded", "a.points", "a.perspective")
    app = app.withColumn("goal_diff", F.col("goals_scored") - F.col("goals_conceded"))
    app = rolling_avg(app, {"rolling_points_avg": ("points", 5),
                            "rolling_goals_avg": ("goals_scored", 5)},
                      ["team_id"], ["match_date", "match_id"], strategy=strategy)
    teams = stg_teams.select("team_id", "team_name")
    out = ["team_id", "match_id", "match_date", "goals_scored", "goals_conceded", "goal_diff",
           "points", "rolling_points_avg", "rolling_goals_avg", "team_name"]
    return app.join(teams, "team_id", "left").select(*out, *(["perspective"] if keep_side else []))
