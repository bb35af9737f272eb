"""Scans and source-side filters."""

from __future__ import annotations

import csv
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from .schemas import RAW, SEED_COMPETITIONS

SEED_DIR = os.path.join(os.path.dirname(os.path.abspath(__file__)), "seeds")

# The 16 model features (odds features use the mart's names).
FEATURE_COLUMNS = [
    "home_avg_points_l5", "home_avg_goals_scored_l5", "home_avg_goals_conceded_l5",
    "home_win_rate_l5", "home_avg_points_l10",
    "away_avg_points_l5", "away_avg_goals_scored_l5", "away_avg_goals_conceded_l5",
    "away_win_rate_l5", "away_avg_points_l10",
    "h2h_home_wins", "h2h_draws", "h2h_avg_goals",
    "odds_implied_prob_home", "odds_implied_prob_draw", "odds_implied_prob_away",
]
TARGET_COLUMN = "match_result"

# Requestable leagues (name -> API league id).
LEAGUES = {
    "Brasileirao Serie A": 71, "Premier League": 39, "La Liga": 140, "Serie A Italy": 135,
    "Bundesliga": 78, "Ligue 1": 61, "Eredivisie": 88, "Primeira Liga": 94,
    "Liga Profesional Argentina": 128, "Liga MX": 262, "MLS": 253,
    "UEFA Champions League": 2, "UEFA Europa League": 3, "Copa Libertadores": 13,
    "Copa Sulamericana": 11, "FIFA World Cup": 1, "Copa America": 9, "UEFA Euro": 4,
}


def scan_raw(spark: SparkSession, path: str, table: str, filters: list[Column] | None = None,
             columns: list[str] | None = None) -> DataFrame:
    """Typed parquet scan with the declared raw schema.

    Filters and the projection are applied right on the scan so Catalyst
    pushes them into the reader (``PushedFilters`` / pruned ``ReadSchema``).
    The JDBC form is ``spark.read.jdbc(url, table, column=<key>,
    lowerBound=..., upperBound=..., numPartitions=...)`` with the same schema.
    """
    df = spark.read.schema(RAW[table]).parquet(path)
    for f in filters or []:
        df = df.filter(f)
    return df.select(*columns) if columns else df


def read_seed(spark: SparkSession, name: str = "competition_mapping") -> DataFrame:
    """CSV seed with header, every column as text.

    A seed is a few rows inside the package, so the driver parses it; executors
    elsewhere could not open the file.
    """
    with open(os.path.join(SEED_DIR, f"{name}.csv"), encoding="UTF-8", newline="") as lines:
        rows = [[x or None for x in row] for row in csv.reader(lines)][1:]
    return spark.createDataFrame(rows, SEED_COMPETITIONS)


def load_features(fct_match_features: DataFrame, league_id=None, season=None,
                  ordered: bool = False) -> DataFrame:
    """Optional conjunctive league/season filters, known target, rows
    with a null feature dropped.  Global ordering only on request."""
    df = fct_match_features.filter(F.col(TARGET_COLUMN).isNotNull())
    if league_id is not None:
        df = df.filter(F.col("league_id") == F.lit(league_id))
    if season is not None:
        df = df.filter(F.col("season") == F.lit(season))
    df = df.dropna(subset=FEATURE_COLUMNS + [TARGET_COLUMN])
    return df.orderBy("match_date", "fixture_id") if ordered else df


def upcoming_fixtures(raw_fixtures: DataFrame, now, days: int = 7,
                      half_open: bool = False) -> DataFrame:
    """Fixtures in ``[now, now + days]`` whose status is not terminal.

    ``half_open=True`` is the ML variant ``[now, now + days)``.  ``now`` is a
    parameter, never the wall clock.
    """
    start = C.ts_lit(now)
    end = start + F.expr(f"INTERVAL {int(days)} DAYS")
    d = F.col("match_date")
    in_range = (d >= start) & ((d < end) if half_open else (d <= end))
    return raw_fixtures.filter(in_range & ~F.col("status").isin(*C.TERMINAL_STATUSES))


def league_mapping(spark: SparkSession) -> DataFrame:
    """The fixed league name -> id table (18 rows)."""
    return spark.createDataFrame(sorted(LEAGUES.items()), "league_name string, api_league_id long")


def league_filter(spark: SparkSession, requested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Resolve requested league names against the mapping.

    Returns (resolved, unknown).  The mapping is a fixed 18-row table, so the
    broadcast is size-bounded.
    """
    m = F.broadcast(league_mapping(spark))
    resolved = requested.join(m, "league_name", "inner")
    unknown = requested.join(m, "league_name", "left_anti")
    return resolved, unknown
