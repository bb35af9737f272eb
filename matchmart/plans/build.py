"""Materialise the models in dependency order (the daily refresh).

Each model is computed from the *written* tables of its parents, so every
stage reads parquet (filters and projections pushed into the scan) instead of
re-running its parents' lineage, and a failed or lost stage is retried from the
last written table.  Tables are versioned by ``operators.sinks.TableStore``
under the shared checkpoint folder (or ``root``).

Order: raw -> staging -> intermediate -> marts -> predictions -> history -> checks
(all declared tests of ``plans.declared``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..functions import columns as C
from ..ml import hybrid as HY
from ..operators import quality as Q
from ..operators import sinks as K
from ..operators.manifest import ManifestStore
from ..sources.adapters import Raw
from . import declared as D
from . import intermediate as I
from . import marts as M
from . import staging as S


def materialize_all(spark: SparkSession, sf_dir: str, root: str | None = None,
                    run_ts: _dt.datetime | None = None) -> dict[str, str]:
    """Write every model once; returns ``{model: table version path}``."""
    store = K.TableStore(spark, root)
    raw = Raw(spark, sf_dir)
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame, by_season: bool = False) -> DataFrame:
        paths[name] = store.write(df, name, partition_by=["season"] if by_season else None)
        return store.read(name)

    fixtures = put("raw_fixtures", raw.fixtures, by_season=True)
    odds = put("raw_odds", raw.odds)
    standings = put("raw_standings", raw.standings, by_season=True)
    teams_fb = put("raw_teams_football", raw.teams_football)
    matches, teams = put("raw_matches", raw.matches), put("raw_teams", raw.teams)
    roster = put("raw_team_roster", raw.roster(1))
    predictions = put("raw_predictions", raw.predictions)

    stg_fixtures = put("stg_fixtures", S.stg_fixtures(fixtures), by_season=True)
    stg_odds = put("stg_odds", S.stg_odds(odds))
    stg_standings = put("stg_standings", S.stg_standings(standings), by_season=True)
    stg_teams_fb = put("stg_teams_football", S.stg_teams_football(teams_fb))
    stg_matches, stg_teams = put("stg_matches", S.stg_matches(matches)), put("stg_teams", S.stg_teams(teams))

    form = put("int_team_form", I.team_form(stg_fixtures), by_season=True)
    put("int_head_to_head", I.head_to_head(stg_fixtures))
    features = put("int_match_features", I.match_features(stg_fixtures, stg_odds, form=form),
                   by_season=True)
    performance = put("int_team_performance", I.team_performance(stg_matches, stg_teams, keep_side=True))

    dim_league = put("dim_league", M.dim_league(stg_fixtures, stg_standings))
    dim_team = put("dim_team_football", M.dim_team_football(stg_teams_fb, stg_fixtures, run_ts))
    put("dim_team", M.dim_team(stg_teams))
    put("fct_standings", M.fct_standings(stg_standings, dim_team, dim_league), by_season=True)
    fct = put("fct_match_features", M.fct_match_features(features, dim_team, dim_league, run_ts),
              by_season=True)
    put("fct_team_season_stats", M.season_stats(performance.drop("perspective"), run_ts))
    put("fct_match_predictions", M.match_facts_legacy(stg_matches, performance))
    put("fct_predictions", HY.fct_predictions(predictions, stg_fixtures, run_ts))

    history = ManifestStore(spark, f"{store.root}/history")
    history.snapshot(roster, "snp_team_roster", "player_id", "updated_at", run_ts or M.DEFAULT_RUN_TS)
    paths["snp_team_roster"] = f"{history.root}/snp_team_roster"

    # The failing rows of the feature fact, and the counts of all declared tests.
    failures = Q.run_checks(fct, "fct_match_features", "fixture_id", [
        Q.not_null("fixture_id"), Q.unique("fixture_id"),
        Q.accepted_values("match_result", ["HOME_WIN", "DRAW", "AWAY_WIN"]),
        Q.relationships("home_team_id", "dim_team_football", "team_id"),
        Q.relationships("league_id", "dim_league", "league_id")],
        {"dim_team_football": dim_team, "dim_league": dim_league})
    put("dq_failures", failures.withColumn("run_ts", C.ts_lit(run_ts or M.DEFAULT_RUN_TS)))
    put("dq_summary", D.summary({m: store.read(m) for m in D.MODELS}).withColumn(
        "run_ts", C.ts_lit(run_ts or M.DEFAULT_RUN_TS)))
    return paths
