"""Build context: the raw inputs of one data directory and the models derived
from them, created lazily and shared by every query of one run."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.adapters import Raw
from . import staging


def normalize(df: DataFrame) -> DataFrame:
    """Output types for comparison and export: DECIMAL/FLOAT -> DOUBLE and
    every integral type -> LONG (one cast per column, no data movement)."""
    cols = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.DecimalType, T.FloatType)):
            cols.append(df[f.name].cast("double").alias(f.name))
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(df[f.name].cast("long").alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str, strategy: str = "auto"):
        self.spark, self.sf_dir, self.strategy = spark, sf_dir, strategy
        self.raw = Raw(spark, sf_dir)

    @cached_property
    def stg_fixtures(self) -> DataFrame:
        return staging.stg_fixtures(self.raw.fixtures)

    @cached_property
    def stg_odds(self) -> DataFrame:
        return staging.stg_odds(self.raw.odds)

    @cached_property
    def stg_standings(self) -> DataFrame:
        return staging.stg_standings(self.raw.standings)

    @cached_property
    def stg_teams_football(self) -> DataFrame:
        return staging.stg_teams_football(self.raw.teams_football)

    @cached_property
    def stg_matches(self) -> DataFrame:
        return staging.stg_matches(self.raw.matches)

    @cached_property
    def stg_teams(self) -> DataFrame:
        return staging.stg_teams(self.raw.teams)

    # --- derived models, shared by the queries of one run ----------------------

    @cached_property
    def team_form(self) -> DataFrame:
        from . import intermediate
        return intermediate.team_form(self.stg_fixtures, strategy=self.strategy)

    @cached_property
    def match_features(self) -> DataFrame:
        from . import intermediate
        return intermediate.match_features(self.stg_fixtures, self.stg_odds, form=self.team_form)

    @cached_property
    def dim_league(self) -> DataFrame:
        from . import marts
        return marts.dim_league(self.stg_fixtures, self.stg_standings)

    @cached_property
    def dim_team_football(self) -> DataFrame:
        from . import marts
        return marts.dim_team_football(self.stg_teams_football, self.stg_fixtures)

    @cached_property
    def fct_match_features(self) -> DataFrame:
        from . import marts
        return marts.fct_match_features(self.match_features, self.dim_team_football,
                                        self.dim_league)

    @cached_property
    def team_performance(self) -> DataFrame:
        from . import intermediate
        return intermediate.team_performance(self.stg_matches, self.stg_teams,
                                             strategy=self.strategy, keep_side=True)
