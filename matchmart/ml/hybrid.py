"""Hybrid blend and batch prediction.

Everything is a column pipeline over a fixture DataFrame: expected goals ->
Poisson outcome probabilities -> boosted-model probabilities -> blend ->
class and confidence.  The reference's per-row loop becomes one distributed
projection; predictions are then upserted by fixture id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

# Fixed values
POISSON_WEIGHT = 0.3
GB_WEIGHT = 0.7
SIDES = ("home", "draw", "away")


def blend(df: DataFrame, poisson_weight: float = POISSON_WEIGHT, gb_weight: float = GB_WEIGHT,
          poisson_prefix: str | None = "poisson", gb_prefix: str = "gb",
          out_prefix: str = "hybrid") -> DataFrame:
    """``w_p * poisson + w_g * gb`` normalised per row (zero sum -> 1).

    A missing model (all three probabilities null) counts as 1/3 each; the
    weights must sum to 1.  Without a goal model (``poisson_prefix=None``) the
    booster's probabilities are the result as they are.
    """
    if poisson_prefix is None:
        return df.withColumns({f"{out_prefix}_{s}_prob": F.col(f"{gb_prefix}_{s}_prob") for s in SIDES})
    if abs(poisson_weight + gb_weight - 1.0) > 1e-6:
        raise ValueError("poisson_weight + gb_weight must equal 1.0")

    def p(prefix, s) -> Column:
        cols = [F.col(f"{prefix}_{x}_prob") for x in SIDES]
        missing = cols[0].isNull() & cols[1].isNull() & cols[2].isNull()
        return F.when(missing, F.lit(1.0 / 3.0)).otherwise(F.col(f"{prefix}_{s}_prob"))

    raw = {s: F.lit(poisson_weight) * p(poisson_prefix, s) + F.lit(gb_weight) * p(gb_prefix, s)
           for s in SIDES}
    tmp = df.withColumns({f"_h_{s}": raw[s] for s in SIDES})
    tot = sum((F.col(f"_h_{s}") for s in SIDES), F.lit(0.0))
    tot = F.when(tot == 0, F.lit(1.0)).otherwise(tot)
    return tmp.withColumns({f"{out_prefix}_{s}_prob": F.col(f"_h_{s}") / tot for s in SIDES}) \
        .drop(*[f"_h_{s}" for s in SIDES])


def decide(df: DataFrame, prefix: str = "hybrid") -> DataFrame:
    """Class by the argmax rule (first maximum over home, draw, away) and
    confidence = the maximum probability."""
    h, d, a = (f"{prefix}_{s}_prob" for s in SIDES)
    return df.withColumns({
        "predicted_result": C.predicted_result_argmax(h, d, a),
        "confidence_score": F.greatest(F.col(h), F.col(d), F.col(a)),
    })


def fct_predictions(predictions: DataFrame, stg_fixtures: DataFrame, run_ts=None) -> DataFrame:
    """Predictions joined to finished fixtures with the SQL tie rule,
    three-valued correctness and the reference's decimal precision."""
    from ..plans.marts import _ts
    d64 = "decimal(6,4)"
    p = predictions.select(
        "fixture_id",
        *[F.col(f"{m}_{s}_prob").cast(d64).alias(f"{m}_{s}_prob")
          for m in ("poisson", "gb", "hybrid") for s in SIDES],
        F.col("expected_home_goals").cast("decimal(6,3)").alias("expected_home_goals"),
        F.col("expected_away_goals").cast("decimal(6,3)").alias("expected_away_goals"),
        F.col("confidence_score").cast(d64).alias("confidence_score"),
        "model_version", F.col("predicted_at").cast("timestamp_ntz").alias("predicted_at"))
    f = stg_fixtures.select("fixture_id", "league_id", "match_date", "home_team_id", "away_team_id",
                            F.col("match_result").alias("actual_result"),
                            F.col("home_goals").alias("actual_home_goals"),
                            F.col("away_goals").alias("actual_away_goals"))
    j = p.join(f, "fixture_id", "inner")
    pred = C.predicted_result_sql("hybrid_home_prob", "hybrid_draw_prob", "hybrid_away_prob")
    return j.select(
        "fixture_id", "league_id", "match_date", "home_team_id", "away_team_id",
        *[f"{m}_{s}_prob" for m in ("poisson", "gb", "hybrid") for s in SIDES],
        pred.alias("predicted_result"), "confidence_score",
        "expected_home_goals", "expected_away_goals",
        "actual_result", "actual_home_goals", "actual_away_goals",
        C.is_correct(pred, F.col("actual_result")).alias("is_correct"),
        "model_version", "predicted_at", _ts(run_ts).alias("dbt_loaded_at"))
