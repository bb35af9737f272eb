"""Training, evaluation and batch prediction flows (M02-M17 wired together).

``train`` : features -> temporal split -> Poisson fit on training matches ->
three-class booster on training rows -> isotonic calibration on the last
slice of the training period -> test-set evaluation of the booster and the
hybrid -> champion gate.

``save_model`` / ``load_model`` : the fitted model as tables of the store (tree
nodes, calibration steps, team parameters, scalars); another session scores
from them.  The version is a digest of these tables, so a model fitted on other
data is another version, and the same data give the same one.

``predict_batch`` : not-yet-played fixtures -> last known form per team before
kick-off (as-of join) + pair history + odds -> Poisson and booster
probabilities -> blend -> class and confidence -> keyed upsert by fixture.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.asof import asof_join
from ..operators.joins import Lookup
from ..operators.sinks import TableStore
from ..plans import intermediate as I
from ..sources.scan import FEATURE_COLUMNS, load_features
from . import boosting as B
from . import features as FE
from . import hybrid as HY
from . import metrics as ME
from . import poisson as PO

CALIBRATION_FRACTION = 0.8  # of the training period: the rest calibrates


@dataclass
class TrainResult:
    poisson: PO.PoissonParams
    booster: B.Booster
    test_scored: DataFrame        # test rows with gb_* and hybrid_* probabilities
    metrics: DataFrame            # one row per model (gb, hybrid)
    model_version: str


def score(df: DataFrame, poisson: PO.PoissonParams, booster: B.Booster) -> DataFrame:
    """Poisson + booster + blend + decision on any frame with team ids and features."""
    x = PO.outcome_probs(PO.expected_goals(df, poisson))
    x = B.predict_booster(booster, x)
    return HY.decide(HY.blend(x))


def train(fct_match_features: DataFrame, settings: B.Settings = B.Settings(),
          model_version: str | None = None, calibrate: bool = True) -> TrainResult:
    # Read several times below: written once.
    feats = load_features(fct_match_features).select(
        "fixture_id", "match_date", "home_team_id", "away_team_id", "home_goals", "away_goals", "league_id",
        *FEATURE_COLUMNS, "match_result").checkpoint()
    fm = FE.feature_matrix(feats).join(
        feats.select("fixture_id", "home_team_id", "away_team_id", "home_goals", "away_goals",
                     "league_id", "match_result"), "fixture_id")
    fm = FE.temporal_split(fm).checkpoint()
    train_rows = fm.filter("is_train")
    test_rows = fm.filter(~F.col("is_train"))
    poisson = PO.fit_mle(train_rows)
    if calibrate:
        fit_part = FE.temporal_split(train_rows.drop("is_train"), CALIBRATION_FRACTION)
        booster = B.fit_booster(fit_part.filter("is_train"), settings=settings)
        booster = B.calibrate(booster, fit_part.filter(~F.col("is_train")))
    else:
        booster = B.fit_booster(train_rows, settings=settings)
    scored = score(test_rows, poisson, booster).withColumn(
        "actual_result", F.col("match_result")).checkpoint()
    gb = HY.decide(scored.drop("predicted_result", "confidence_score"), prefix="gb")
    m_gb = ME.classification_metrics(gb, ("gb_home_prob", "gb_draw_prob", "gb_away_prob")) \
        .withColumn("model", F.lit("gb"))
    m_h = ME.classification_metrics(scored).withColumn("model", F.lit("hybrid"))
    return TrainResult(poisson, booster, scored, m_gb.unionByName(m_h),
                       model_version or version_of(booster, poisson))


def version_of(booster: B.Booster, poisson: PO.PoissonParams) -> str:
    """A version named by the fitted model itself."""
    digest = hashlib.sha256()
    for part in (booster.nodes, booster.steps):
        if part is not None:
            digest.update(part.round(9).to_csv(index=False).encode())
    # one order-free number for the team table
    teams = poisson.teams.agg(F.bit_xor(F.xxhash64("team_id", F.round("attack", 6), F.round("defence", 6)))).first()[0]
    digest.update(repr((teams, round(poisson.home_advantage, 6), round(poisson.intercept, 6))).encode())
    return f"hybrid-{digest.hexdigest()[:12]}"


def save_model(store: TableStore, result: TrainResult, name: str = "model") -> None:
    """The whole fitted model as table versions; the scalars last, they complete the model."""
    spark = store.spark
    store.write(B.node_table(spark, result.booster), f"{name}_nodes")
    steps = result.booster.steps
    store.write(spark.createDataFrame([] if steps is None else steps.values.tolist(), "class double, boundary double, "
                                      "probability double").withColumn("class", F.col("class").cast("int")), f"{name}_steps")
    store.write(result.poisson.teams.select("team_id", "attack", "defence"), f"{name}_teams")
    store.write(result.test_scored, f"{name}_test_scored")
    store.write(result.metrics, f"{name}_metrics")
    p = result.poisson
    store.write(spark.createDataFrame(
        [(result.model_version, result.booster.features, steps is not None, p.home_advantage, p.intercept, p.converged,
          p.iterations, p.method)],
        "model_version string, features array<string>, calibrated boolean, home_advantage double, intercept double, "
        "converged boolean, iterations int, method string"), f"{name}_scalars")


def load_model(store: TableStore, name: str = "model") -> TrainResult | None:
    """The model that :func:`save_model` stored, or None."""
    scalars = store.read(f"{name}_scalars")
    if scalars is None:
        return None
    r = scalars.first()
    nodes = B.as_grown(pd.DataFrame(store.read(f"{name}_nodes").collect(), columns=[x.split()[0] for x in B.NODE_SCHEMA.split(", ")]))
    steps = None
    if r.calibrated:
        steps = pd.DataFrame(store.read(f"{name}_steps").collect(), columns=["class", "boundary", "probability"]) \
            .sort_values(["class", "boundary", "probability"], ignore_index=True)
    return TrainResult(
        PO.PoissonParams(store.read(f"{name}_teams"), r.home_advantage, r.intercept, r.converged, r.iterations, r.method),
        B.Booster(nodes, list(r.features), steps), store.read(f"{name}_test_scored"), store.read(f"{name}_metrics"),
        r.model_version)


def upcoming_features(raw_fixtures: DataFrame, team_form: DataFrame, stg_fixtures: DataFrame,
                      stg_odds: DataFrame, now=None, days: int | None = None) -> DataFrame:
    """Feature rows for fixtures that are not finished: the last
    form row of each team strictly before kick-off, all-history pair stats and
    bookmaker consensus."""
    fx = raw_fixtures.filter(~F.col("status").isin(*C.TERMINAL_STATUSES))
    if now is not None:
        start = C.ts_lit(now)
        fx = fx.filter(F.col("match_date") >= start)
        if days is not None:
            fx = fx.filter(F.col("match_date") < start + F.expr(f"INTERVAL {int(days)} DAYS"))
    fx = fx.select("fixture_id", "league_id", "season", "match_date", "home_team_id", "away_team_id")
    form_cols = ["avg_points_l5", "avg_goals_scored_l5", "avg_goals_conceded_l5", "win_rate_l5",
                 "avg_points_l10"]
    probes = fx.select("fixture_id", F.explode(F.array(
        F.struct(F.lit("home").alias("side"), F.col("home_team_id").alias("team_id")),
        F.struct(F.lit("away").alias("side"), F.col("away_team_id").alias("team_id")))).alias("s"),
        "match_date").select("fixture_id", "s.side", "s.team_id", "match_date")
    form = team_form.select("team_id", F.col("match_date").alias("form_date"),
                            F.col("fixture_id").alias("form_fixture"), *form_cols)
    hit = asof_join(probes, form, ["team_id"], "match_date", "form_date", form_cols,
                    probe_key=["fixture_id", "side"], tie_col="form_fixture")
    piv = hit.groupBy("fixture_id").agg(*[
        F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{side}_{c}")
        for side in ("home", "away") for c in form_cols])
    h2h = I.head_to_head(stg_fixtures).select("team_a_id", "team_b_id", "h2h_home_wins",
                                              "h2h_draws", "h2h_avg_goals")
    odds = I.odds_consensus(stg_odds).select("fixture_id", "odds_implied_prob_home",
                                             "odds_implied_prob_draw", "odds_implied_prob_away")
    out = (fx.join(piv, "fixture_id", "left").join(odds, "fixture_id", "left")
           .withColumns({"_a": C.pair_low("home_team_id", "away_team_id"),
                         "_b": C.pair_high("home_team_id", "away_team_id")}))
    out = Lookup(h2h).join(out, {"_a": "team_a_id", "_b": "team_b_id"},
                           {c: c for c in ("h2h_home_wins", "h2h_draws", "h2h_avg_goals")}, "fixture_id").drop("_a", "_b")
    return out.fillna(0.0, subset=[c for c in FEATURE_COLUMNS if not c.startswith("odds_")])


def predict_batch(features: DataFrame, poisson: PO.PoissonParams, booster: B.Booster,
                  model_version: str, predicted_at) -> DataFrame:
    """Prediction payload per fixture (9 probabilities, class, confidence,
    expected goals, version, time)."""
    s = score(features, poisson, booster)
    return s.select(
        "fixture_id", "league_id", "match_date", "home_team_id", "away_team_id",
        *[f"{m}_{x}_prob" for m in ("poisson", "gb", "hybrid") for x in HY.SIDES],
        "predicted_result", "confidence_score", "expected_home_goals", "expected_away_goals",
        F.lit(model_version).alias("model_version"),
        C.ts_lit(predicted_at).alias("predicted_at"))
