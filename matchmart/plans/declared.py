"""The declared data tests of all models, as data, and their summary (Q01-Q06).

A model declares which columns must not be null, be unique, lie in a range, come
from a list, or refer to another model; ranges and lists follow from the column
(:func:`range_of`, :func:`values_of`).  ``summary`` runs them on written tables:

* all row-level tests of a model are one aggregate pass over its table;
* unique columns are counted with map-side merging;
* foreign keys are counted by value first, and all that refer to the same parent
  meet it in one anti-join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q

# The declared lists.
RESULTS = ("HOME_WIN", "DRAW", "AWAY_WIN")
LEAGUE_TYPES = ("DOMESTIC_LEAGUE", "CUP", "INTERNATIONAL")
PLAYED = ("FT", "AET", "PEN")
MOVEMENTS = ("UP", "DOWN", "SAME")


def values_of(column: str) -> tuple:
    """The declared list of a column."""
    if column in ("match_result", "predicted_result"):
        return RESULTS
    return {"league_type": LEAGUE_TYPES, "status": PLAYED, "rank_movement": MOVEMENTS, "points": (0, 1, 3),
            "match_result_encoded": (0, 1, 2)}[column]


def range_of(column: str) -> tuple[float | None, float | None]:
    """The declared inclusive range of a column; None where it is open."""
    if column in ("home_goals", "away_goals"):
        return 0, 30
    if column.startswith("win_rate") or "_win_rate_" in column or "prob" in column or column == "confidence_score":
        return 0, 1
    return {"total_goals": (0, 60), "rank": (1, 30), "h2h_total_matches": (1, 5), "odd_home": (1.01, None)}.get(
        column, (0, None))


@dataclass(frozen=True)
class Declared:
    not_null: str = ""
    unique: str = ""
    ranged: str = ""
    listed: str = ""
    parents: dict = field(default_factory=dict)

    def checks(self) -> list[Q.Check]:
        return ([Q.not_null(c) for c in self.not_null.split()] + [Q.unique(c) for c in self.unique.split()]
                + [Q.between(c, *range_of(c)) for c in self.ranged.split()]
                + [Q.accepted_values(c, values_of(c)) for c in self.listed.split()]
                + [Q.relationships(c, *p.split(".")) for c, p in self.parents.items()])


_SIDES = ("home_team_id", "away_team_id")
_GOALS = "home_goals away_goals"
_MODEL_PROBS = " ".join(f"{m}_{s}_prob" for m in ("poisson", "hybrid") for s in ("home", "draw", "away"))


def _sides(parent: str) -> dict:
    return dict.fromkeys(_SIDES, parent)


MODELS: dict[str, Declared] = {
    "raw_matches": Declared(f"match_id match_date home_team_id away_team_id {_GOALS}", "match_id", _GOALS),
    "raw_teams": Declared("team_id team_name", "team_id"),
    "raw_team_roster": Declared("player_id", "player_id"),
    "raw_fixtures": Declared("fixture_id league_id match_date home_team_id away_team_id status", "fixture_id"),
    "raw_standings": Declared("standing_id league_id season team_id", "standing_id"),
    "raw_teams_football": Declared("team_id team_name", "team_id"),
    "raw_odds": Declared("odds_id fixture_id bookmaker_name", "odds_id"),
    "stg_matches": Declared(f"match_id match_date {_GOALS} match_result", "match_id", _GOALS, "match_result"),
    "stg_teams": Declared("team_id team_name", "team_id"),
    "stg_fixtures": Declared(
        f"fixture_id league_id season match_date match_day status home_team_id away_team_id {_GOALS} match_result total_goals",
        "fixture_id", f"{_GOALS} total_goals", "status match_result"),
    "stg_standings": Declared("standing_id league_id season team_id rank points", "standing_id", "rank points"),
    "stg_teams_football": Declared("team_id team_name is_national", "team_id"),
    "stg_odds": Declared(
        "odds_id fixture_id bookmaker_name odd_home implied_prob_home implied_prob_draw implied_prob_away", "odds_id",
        "odd_home implied_prob_home implied_prob_draw implied_prob_away"),
    "int_team_form": Declared("fixture_id team_id league_id season points", "", "win_rate_l5 win_rate_l10", "points"),
    "int_head_to_head": Declared("team_a_id team_b_id h2h_total_matches h2h_avg_goals", "", "h2h_total_matches"),
    "int_match_features": Declared(
        f"fixture_id league_id home_team_id away_team_id match_result {_GOALS}", "fixture_id", _GOALS, "match_result",
        _sides("stg_teams_football.team_id")),
    "dim_league": Declared("league_id league_name league_type total_seasons total_matches", "league_id",
                           "total_seasons total_matches", "league_type"),
    "dim_team_football": Declared("team_sk team_id team_name is_national total_matches", "team_sk team_id", "total_matches"),
    "dim_team": Declared("team_sk team_id team_name", "team_sk team_id"),
    "fct_standings": Declared("standing_sk league_id season team_id rank points", "standing_sk", "rank points win_rate",
                              "rank_movement", {"team_id": "dim_team_football.team_id", "league_id": "dim_league.league_id"}),
    "fct_match_features": Declared(
        f"fixture_id league_id home_team_id away_team_id match_result match_result_encoded {_GOALS}", "fixture_id",
        f"{_GOALS} home_win_rate_l5 away_win_rate_l5 home_win_rate_l10 away_win_rate_l10 odds_implied_prob_home",
        "match_result match_result_encoded", {**_sides("dim_team_football.team_id"), "league_id": "dim_league.league_id"}),
    "fct_predictions": Declared(
        f"fixture_id league_id home_team_id away_team_id predicted_result confidence_score {_MODEL_PROBS} model_version",
        "fixture_id", f"confidence_score {_MODEL_PROBS}", "predicted_result",
        {**_sides("dim_team_football.team_id"), "league_id": "dim_league.league_id"}),
    "fct_team_season_stats": Declared("stat_sk team_id total_matches win_rate", "stat_sk", "total_matches win_rate", "",
                                      {"team_id": "dim_team.team_id"}),
    "fct_match_predictions": Declared("match_id match_date home_team_id away_team_id match_result", "match_id", _GOALS,
                                      "match_result", _sides("dim_team.team_id")),
}

#: Q06: sources and the column that tells when a row was loaded.
SOURCES = {"raw_matches": "loaded_at", "raw_teams": "updated_at", "raw_team_roster": "updated_at",
           "raw_fixtures": "loaded_at", "raw_standings": "loaded_at", "raw_teams_football": "updated_at",
           "raw_odds": "loaded_at"}


def _row_level(df: DataFrame, model: str, checks: list[Q.Check]) -> DataFrame:
    counts = df.agg(*[F.count_if(Q._row_condition(c)).alias(f"n{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(model).alias("model"), F.lit(c.column).alias("column"), F.lit(c.kind).alias("check"),
                              F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("failures")) for i, c in enumerate(checks)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def _line(model: str, column: str, check: str, failures: Column) -> list[Column]:
    return [F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit(check).alias("check"),
            failures.cast("long").alias("failures")]


def summary(tables: dict[str, DataFrame], declared: dict[str, Declared] = MODELS) -> DataFrame:
    """One row per declared test: model, column, check, failures (rows; for unique: repeated values), status."""
    parts, children = [], {}
    for model, d in declared.items():
        df = tables[model]
        by_kind: dict[str, list[Q.Check]] = {}
        for c in d.checks():
            by_kind.setdefault(c.kind, []).append(c)
        rows = [c for kind in ("not_null", "between", "accepted_values") for c in by_kind.get(kind, [])]
        if rows:
            parts.append(_row_level(df, model, rows))
        for c in by_kind.get("unique", []):
            repeated = df.where(F.col(c.column).isNotNull()).groupBy(c.column).count().where("count > 1")
            parts.append(repeated.agg(F.count(F.lit(1)).alias("n")).select(*_line(model, c.column, "unique", F.col("n"))))
        for c in by_kind.get("relationships", []):
            values = df.groupBy(F.col(c.column).alias("value")).count().where("value is not null").select(
                F.lit(f"{model}.{c.column}").alias("child"), "value", "count")
            children.setdefault((c.parent, c.parent_column), []).append((model, c.column, values))
    for (parent, column), own in children.items():
        values = reduce(DataFrame.unionByName, [v for _, _, v in own])
        known = tables[parent].select(F.col(column).alias("value")).distinct()
        orphans = values.join(known, "value", "left_anti")
        counts = orphans.agg(*[F.sum(F.when(F.col("child") == f"{m}.{c}", F.col("count"))).alias(f"n{i}")
                               for i, (m, c, _) in enumerate(own)])
        lines = F.array(*[F.struct(*_line(m, c, "relationships", F.coalesce(F.col(f"n{i}"), F.lit(0))))
                          for i, (m, c, _) in enumerate(own)])
        parts.append(counts.select(F.explode(lines).alias("r")).select("r.*"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def freshness(tables: dict[str, DataFrame], now) -> DataFrame:
    """Q06 for every source."""
    return reduce(DataFrame.unionByName, [
        Q.source_freshness(tables[s], s.removeprefix("raw_"), column, now) for s, column in SOURCES.items()])
