"""ML operators: probability identities, fit score equations, split, folds, metrics."""
import math

import pandas as pd
from pyspark.sql import functions as F

from matchmart.ml import features as MF
from matchmart.ml import hybrid as MH
from matchmart.ml import metrics as MM
from matchmart.ml import poisson as MP
from matchmart.plans.context import Context

SF = "/root/testdata/sf0.01"


def test_outcome_probs_sum_to_one_and_match_grid(spark):
    mus = [(0.1, 0.1), (1.2, 0.8), (2.5, 3.1), (4.0, 0.3)]
    df = spark.createDataFrame(mus, "expected_home_goals double, expected_away_goals double")
    out = MP.outcome_probs(df).collect()
    for (mh, ma), r in zip(mus, out):
        ph = [math.exp(-mh) * mh ** k / math.factorial(k) for k in range(7)]
        pa = [math.exp(-ma) * ma ** k / math.factorial(k) for k in range(7)]
        h = sum(ph[i] * pa[j] for i in range(7) for j in range(7) if i > j)
        d = sum(ph[i] * pa[i] for i in range(7))
        a = sum(ph[i] * pa[j] for i in range(7) for j in range(7) if i < j)
        t = h + d + a
        assert abs(r.poisson_home_prob - h / t) < 1e-12
        assert abs(r.poisson_draw_prob - d / t) < 1e-12
        assert abs(r.poisson_home_prob + r.poisson_draw_prob + r.poisson_away_prob - 1) < 1e-12


def test_poisson_mle_score_equations(spark):
    c = Context(spark, SF)
    fx = c.stg_fixtures.select("fixture_id", "home_team_id", "away_team_id", "home_goals", "away_goals")
    p = MP.fit_mle(fx)
    assert p.converged
    t = p.teams.toPandas()
    assert abs(t.attack.sum()) < 1e-9
    eg = MP.expected_goals(fx, p).toPandas()
    side = pd.concat([
        eg[["home_team_id", "home_goals", "expected_home_goals"]].set_axis(["t", "g", "e"], axis=1),
        eg[["away_team_id", "away_goals", "expected_away_goals"]].set_axis(["t", "g", "e"], axis=1)])
    per_team = side.groupby("t").sum()
    assert (per_team.g - per_team.e).abs().max() < 1e-6
    assert abs(eg.home_goals.sum() - eg.expected_home_goals.sum()) < 1e-6


def _glm(fx):
    """The same likelihood as one row per match and side, by Spark ML's IRLS."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression
    rows = fx.select("fixture_id", F.explode(F.array(
        F.struct(F.col("home_team_id").alias("s"), F.col("away_team_id").alias("c"), F.lit(1.0).alias("home"),
                 F.col("home_goals").cast("double").alias("y")),
        F.struct(F.col("away_team_id").alias("s"), F.col("home_team_id").alias("c"), F.lit(0.0).alias("home"),
                 F.col("away_goals").cast("double").alias("y")))).alias("x")).select("fixture_id", "x.*")
    return Pipeline(stages=[
        StringIndexer(inputCols=["s", "c"], outputCols=["si", "ci"]),
        OneHotEncoder(inputCols=["si", "ci"], outputCols=["sv", "cv"]),
        VectorAssembler(inputCols=["sv", "cv", "home"], outputCol="features"),
        GeneralizedLinearRegression(family="poisson", link="log", maxIter=50, tol=1e-12, labelCol="y")]).fit(
            rows).transform(rows).where("home = 1").select("fixture_id", "prediction")


def test_newton_fit_equals_glm(spark):
    c = Context(spark, "/root/testdata/sf0.001")
    fx = c.stg_fixtures.select("fixture_id", "home_team_id", "away_team_id", "home_goals", "away_goals").cache()
    p = MP.fit_mle(fx)
    assert p.converged and p.method == "mle-newton-cg" and p.teams.count() == 40
    both = MP.expected_goals(fx, p).join(_glm(fx), "fixture_id").toPandas()
    assert (both.expected_home_goals - both.prediction).abs().max() < 1e-6


def test_newton_fit_of_many_teams(spark):
    """5,000 teams in leagues of 20; teams without a goal; a schedule in unconnected parts."""
    import numpy as np
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for league in range(250):
        strength = rng.normal(0, 0.4, (20, 2))
        for r in range(1, 8):
            for i in range(20):
                j = (i + r) % 20
                mu = [math.exp(0.35 + strength[i, 0] - strength[j, 1]), math.exp(0.1 + strength[j, 0] - strength[i, 1])]
                goals = rng.poisson(mu)
                if league == 0 and i == 0:
                    goals[0] = 0
                if league == 0 and j == 0:
                    goals[1] = 0
                rows.append((k, league * 20 + i, league * 20 + j, int(goals[0]), int(goals[1])))
                k += 1
    fx = spark.createDataFrame(pd.DataFrame(rows, columns=["fixture_id", "home_team_id", "away_team_id", "home_goals",
                                                           "away_goals"]))
    p = MP.fit_mle(fx)
    assert p.converged and p.teams.count() == 5000
    b = MP.goal_balance(fx, p).toPandas()
    total = b.scored.sum()
    assert (b.scored - b.expected_scored).abs().max() <= max(0.001, 2e-9 * total) + 1e-3
    assert (b.conceded - b.expected_conceded).abs().max() <= 2e-3


def test_fit_without_enough_iterations_says_so(spark):
    c = Context(spark, "/root/testdata/sf0.001")
    p = MP.fit_mle(c.stg_fixtures, max_iter=1)
    assert not p.converged and p.method == "mle-newton-cg"
    one = spark.createDataFrame([(1, 1, 2, 1)], "home_team_id long, away_team_id long, home_goals long, away_goals long")
    assert not MP.fit_mle(one).converged


def test_blend_normalised_and_missing_model(spark):
    df = spark.createDataFrame([(0.5, 0.3, 0.2, 0.2, 0.2, 0.6), (None, None, None, 0.1, 0.1, 0.8)],
                               ", ".join(f"{m}_{s}_prob double" for m in ("poisson", "gb")
                                         for s in ("home", "draw", "away")))
    out = MH.decide(MH.blend(df)).collect()
    for r in out:
        assert abs(r.hybrid_home_prob + r.hybrid_draw_prob + r.hybrid_away_prob - 1) < 1e-12
    assert abs(out[1].hybrid_home_prob - (0.3 / 3 + 0.07)) < 1e-12


def test_argmax_and_sql_tie_rules(spark):
    from matchmart.functions import columns as C
    df = spark.createDataFrame([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (0.3, 0.3, 0.4)], "h double, d double, a double")
    r = df.select(C.predicted_result_sql("h", "d", "a").alias("s"),
                  C.predicted_result_argmax("h", "d", "a").alias("m")).collect()
    assert [x.s for x in r] == ["HOME_WIN", "AWAY_WIN", "AWAY_WIN"]
    assert [x.m for x in r] == ["HOME_WIN", "DRAW", "AWAY_WIN"]


def test_temporal_split_is_first_80_percent(spark):
    rows = [(i, f"2024-01-{1 + (i * 7) % 28:02d}") for i in range(137)]
    df = spark.createDataFrame(rows, "fixture_id long, d string").withColumn("match_date", F.to_timestamp("d"))
    out = MF.temporal_split(df).toPandas().sort_values(["match_date", "fixture_id"])
    k = int(137 * 0.8)
    assert out.is_train.tolist() == [True] * k + [False] * (137 - k)


def test_split_follows_kick_off_times_inside_a_day(spark):
    rows = [((i * 37) % 1000, f"2024-01-01 {i % 24:02d}:{i % 60:02d}:00") for i in range(1000)]
    df = spark.createDataFrame(rows, "fixture_id long, d string").withColumn("match_date", F.col("d").cast("timestamp_ntz"))
    for fraction in (0.0, 0.001, 0.5, 0.8, 1.0):
        out = MF.temporal_split(df, fraction).toPandas().sort_values(["match_date", "fixture_id"])
        k = int(1000 * fraction)
        assert out.is_train.tolist() == [True] * k + [False] * (1000 - k)
    assert MF.temporal_split(df.limit(0)).count() == 0


def test_stratified_folds_match_round_robin_allocation(spark):
    rows = [(i, f"2024-02-{1 + i % 9:02d} {i * 7 % 24:02d}:00:00", float([0, 1, 2, 0, 0, 2][i % 6])) for i in range(203)]
    df = spark.createDataFrame(rows, "fixture_id long, d string, label double").withColumn(
        "match_date", F.to_timestamp("d"))
    out = MF.stratified_folds(df).toPandas()
    # brute force: labels sorted, dealt round-robin, then each class in time order
    pdf = df.toPandas().sort_values(["match_date", "fixture_id"])
    ys = sorted(pdf.label)
    exp = {}
    for c in sorted(set(ys)):
        alloc = [sum(1 for p, y in enumerate(ys) if y == c and p % 5 == f) for f in range(5)]
        folds = [f for f in range(5) for _ in range(alloc[f])]
        ids = pdf[pdf.label == c].fixture_id.tolist()
        exp.update(dict(zip(ids, folds)))
    assert dict(zip(out.fixture_id, out.fold)) == exp


def test_metrics_small_example(spark):
    df = spark.createDataFrame(
        [("HOME_WIN", "HOME_WIN", 0.7, 0.2, 0.1, 1), ("DRAW", "HOME_WIN", 0.5, 0.3, 0.2, 1),
         ("AWAY_WIN", "AWAY_WIN", 0.0, 0.0, 1.0, 2)],
        "actual_result string, predicted_result string, hybrid_home_prob double, "
        "hybrid_draw_prob double, hybrid_away_prob double, league_id long")
    m = MM.classification_metrics(df).first()
    assert (m.n_matches, m.n_correct, m.n_wrong) == (3, 2, 1)
    assert m.accuracy == round(2 / 3, 4) and m.flat_bet_roi == round(1 / 3, 4)
    clip = lambda p: min(max(p, 1e-7), 1 - 1e-7)
    p3 = [clip(x) for x in (0.0, 0.0, 1.0)]
    ll = -(math.log(0.7) + math.log(0.3) + math.log(p3[2] / sum(p3))) / 3
    assert m.log_loss == round(ll, 4)
    g = {r.scope: r.n_matches for r in MM.metrics_by_group(df).collect() if r.scope == "overall"}
    assert g == {"overall": 3}
    cm = {r.actual_result: (r.HOME_WIN, r.DRAW, r.AWAY_WIN) for r in MM.confusion_matrix(df).collect()}
    assert cm["DRAW"] == (1, 0, 0)


def test_load_features_filters(spark):
    from matchmart.sources import scan as SC
    c = Context(spark, "/root/testdata/sf0.001")
    allf = SC.load_features(c.fct_match_features)
    one = SC.load_features(c.fct_match_features, league_id=2, season=1997)
    exp = allf.filter((F.col("league_id") == 2) & (F.col("season") == 1997))
    assert sorted(r.fixture_id for r in one.collect()) == sorted(r.fixture_id for r in exp.collect())
    assert one.filter(F.col("odds_implied_prob_home").isNull()).count() == 0
    ordered = SC.load_features(c.fct_match_features, ordered=True).select("match_date", "fixture_id").collect()
    assert ordered == sorted(ordered, key=lambda r: (r.match_date, r.fixture_id))


def test_goal_model_ignores_matches_without_a_result(spark):
    from matchmart.ml import poisson as MP
    rows = [(1, 2, 3, 1, "HOME_WIN"), (2, 1, 2, 2, "DRAW"), (1, 2, 0, 0, None)]
    m = spark.createDataFrame(rows, "home_team_id long, away_team_id long, home_goals long, away_goals long, match_result string")
    with_phantom, without = (MP.fit_fallback(x) for x in (m, m.where("match_result is not null")))
    assert with_phantom.intercept == without.intercept
    assert sorted(map(tuple, with_phantom.teams.collect())) == sorted(map(tuple, without.teams.collect()))
