"""Independent-Poisson goal model (M03-M06) as Spark jobs.

Model: ``mu_home = exp(c + h + att[home] - def[away])``,
``mu_away = exp(c + att[away] - def[home])``.

Fitting (M03) never touches match rows inside the loop.  The matches are
first reduced to one row per ordered (home, away) pair with the number of
meetings and goal sums -- the sufficient statistics of the likelihood -- with
map-side partial aggregation, so a hot pair costs one partial row per map
task.  The maximum-likelihood point is found by Newton's method.  A Newton step
solves ``H x = g`` by preconditioned conjugate gradients, and ``H`` is never formed:
its product with a vector is one pass over the cached pair blocks, summed up by
(team, side) in a reduction tree.  So one solver serves any number of teams; driver
and tasks hold a few vectors of two numbers a team.  A step is halved until
the likelihood does not fall.

The result is re-centred so that sum(att) = 0 (the reference's constraint) and
sum(def) = 0 (fixes the remaining shift between intercept and defence; only
expected goals are identified, so compare those, not raw parameters).  It says
whether the gradient came below the tolerance; without that the last iterate is
returned with ``converged = False``, never another estimate.  A team that never
scored or never conceded has no finite optimum: its parameter stops at
``log(EPS)`` below the others.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import Lookup
from ..session import ship_package

# Fixed values
MAX_GOALS = 7              # score grid 0..6
FALLBACK_HOME_ADV = 0.25
MIN_LEAGUE_AVG = 0.5
MIN_TEAM_AVG = 0.1
EPS = 1e-6                 # floor for a team that never scored / conceded
PAIRS_PER_PART = 50_000


@dataclass
class PoissonParams:
    """Fitted parameters: a team table (team_id, attack, defence) and globals."""
    teams: DataFrame
    home_advantage: float
    intercept: float
    converged: bool = True
    iterations: int = 0
    method: str = "mle"


def _matches(df: DataFrame) -> DataFrame:
    """Played matches only: staging turns unknown goals into 0, so a known result decides."""
    if "match_result" in df.columns:
        df = df.filter(F.col("match_result").isNotNull())
    return df.select("home_team_id", "away_team_id", "home_goals", "away_goals").dropna()


# --- M04 closed-form fallback ------------------------------------------------------------------

def fit_fallback(matches: DataFrame) -> PoissonParams:
    """attack = log(max(avg scored, 0.1) / L), defence = log(max(avg conceded,
    0.1) / L), L = max((mean home + mean away goals) / 2, 0.5), home 0.25."""
    m = _matches(matches)
    g = m.agg(F.avg("home_goals").alias("h"), F.avg("away_goals").alias("a")).first()
    league_avg = max(((g["h"] or 0.0) + (g["a"] or 0.0)) / 2.0, MIN_LEAGUE_AVG)
    app = m.select(F.explode(F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.col("home_goals").alias("gf"),
                 F.col("away_goals").alias("ga")),
        F.struct(F.col("away_team_id").alias("team_id"), F.col("away_goals").alias("gf"),
                 F.col("home_goals").alias("ga")))).alias("x")).select("x.*")
    teams = app.groupBy("team_id").agg(F.avg("gf").alias("gf"), F.avg("ga").alias("ga"))
    teams = teams.select(
        "team_id",
        F.log(F.greatest(F.col("gf"), F.lit(MIN_TEAM_AVG)) / F.lit(league_avg)).alias("attack"),
        F.log(F.greatest(F.col("ga"), F.lit(MIN_TEAM_AVG)) / F.lit(league_avg)).alias("defence"))
    return PoissonParams(teams, FALLBACK_HOME_ADV, math.log(league_avg), True, 0, "fallback")


# --- M03 maximum likelihood ----------------------------------------------------------------------

def pair_table(matches: DataFrame) -> DataFrame:
    """Sufficient statistics per ordered pair (partial aggregation map-side)."""
    return _matches(matches).groupBy("home_team_id", "away_team_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("home_goals").cast("double").alias("hg"),
        F.sum("away_goals").cast("double").alias("ag"))


def _blocks(pairs: DataFrame, teams: np.ndarray):
    """The pair rows as cached arrays (home place, away place, meetings, home goals, away goals)."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            place = [np.searchsorted(teams, f[c].to_numpy()).astype(np.int64) for c in ("home_team_id", "away_team_id")]
            goals = [f[c].to_numpy(float) for c in ("n", "hg", "ag")]
            yield pd.DataFrame({"block": [pickle.dumps((*place, *goals))]})

    parts = max(1, -(-pairs.count() // PAIRS_PER_PART))
    blocks = pairs.repartition(parts, "home_team_id", "away_team_id").mapInPandas(run, "block binary").checkpoint()
    return blocks.rdd.map(lambda r: pickle.loads(r.block)).persist()


def _summed(blocks, run) -> np.ndarray:
    """The sum of ``run(block)`` over all blocks."""
    def part(own):
        total = None
        for block in own:
            value = run(block)
            total = value if total is None else total + value
        if total is not None:
            yield total
    n = blocks.getNumPartitions()
    return blocks.mapPartitions(part).treeReduce(np.add, 1 if n <= 32 else 2 if n <= 1024 else 3)


def _side_sums(t: int, home: np.ndarray, away: np.ndarray, vh: np.ndarray, va: np.ndarray) -> np.ndarray:
    """X' v: by attack, by defence (negative), home side, both sides."""
    attack = np.bincount(home, vh, t) + np.bincount(away, va, t)
    defence = np.bincount(away, vh, t) + np.bincount(home, va, t)
    return np.concatenate([attack, -defence, [vh.sum(), vh.sum() + va.sum()]])


def _lines(t: int, x: np.ndarray, home: np.ndarray, away: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """X x for the home and the away side of each pair; x is attack, defence, home advantage, intercept."""
    return x[2 * t + 1] + x[2 * t] + x[home] - x[t + away], x[2 * t + 1] + x[away] - x[t + home]


def _likelihood_pass(t: int, x: np.ndarray):
    """Log-likelihood, gradient and the diagonal of H, as one vector."""
    def run(block):
        home, away, n, hg, ag = block
        lh, la = _lines(t, x, home, away)
        mh, ma = n * np.exp(lh), n * np.exp(la)
        value = (hg * lh - mh + ag * la - ma).sum()
        diagonal = _side_sums(t, home, away, mh, ma)
        diagonal[t:2 * t] *= -1
        return np.concatenate([[value], _side_sums(t, home, away, hg - mh, ag - ma), diagonal])
    return run


def _product_pass(t: int, x: np.ndarray, v: np.ndarray):
    """H v at the point x."""
    def run(block):
        home, away, n, _, _ = block
        lh, la = _lines(t, x, home, away)
        vh, va = _lines(t, v, home, away)
        return _side_sums(t, home, away, n * np.exp(lh) * vh, n * np.exp(la) * va)
    return run


def _conjugate_gradients(blocks, t: int, x: np.ndarray, g: np.ndarray, diagonal: np.ndarray, tol: float,
                         max_iter: int) -> np.ndarray:
    """The step that solves H step = g to a relative residual of ``tol``, preconditioned by the diagonal."""
    scale = 1.0 / np.maximum(diagonal, 1e-12)
    step, rest = np.zeros_like(g), g.copy()
    z = scale * rest
    towards, rho, goal = z.copy(), rest @ z, tol * np.sqrt(g @ (scale * g))
    for _ in range(max_iter):
        if np.sqrt(max(rho, 0.0)) <= goal:
            break
        product = _summed(blocks, _product_pass(t, x, towards))
        curve = towards @ product
        if curve <= 0:  # a direction that changes no expected goal
            break
        a = rho / curve
        step += a * towards
        rest -= a * product
        z = scale * rest
        rho, old = rest @ z, rho
        towards = z + (rho / old) * towards
    return step


def fit_mle(matches: DataFrame, max_iter: int = 60, tol: float = 1e-9) -> PoissonParams:
    """Maximum-likelihood fit by Newton steps with conjugate gradients (see the module).

    ``converged``: no expected goal sum of a team differs from the observed one by more
    than ``tol`` times all goals.  With fewer than two teams there is nothing to fit and
    the closed form (M04) is returned with ``method`` "fallback" and ``converged = False``."""
    ship_package(matches.sparkSession)
    spark = matches.sparkSession
    pairs = pair_table(matches).checkpoint()
    ids = pairs.select(F.explode(F.array("home_team_id", "away_team_id")).alias("team_id")).distinct()
    # Two numbers a team are what every step holds; the ids are no larger.
    teams = np.sort(ids.toPandas()["team_id"].to_numpy())
    t = len(teams)
    if t < 2:
        return replace(fit_fallback(matches), converged=False)
    blocks = _blocks(pairs, teams)
    sums = _summed(blocks, lambda b: np.array([b[2].sum(), b[3].sum(), b[4].sum()]))
    goals = float(sums[1] + sums[2])
    x = np.zeros(2 * t + 2)
    x[2 * t + 1] = math.log(max(goals, EPS) / (2 * sums[0]))
    converged, iterations, lowest = False, 0, math.log(EPS)
    state = _summed(blocks, _likelihood_pass(t, x))
    for iterations in range(1, max_iter + 1):
        value, g, diagonal = state[0], state[1:2 * t + 3], state[2 * t + 3:]
        # A parameter at its floor is held there.
        held = np.zeros(len(g), bool)
        held[:t] = (x[:t] <= lowest) & (g[:t] < 0)
        held[t:2 * t] = (-x[t:2 * t] <= lowest) & (g[t:2 * t] > 0)
        g = np.where(held, 0.0, g)
        size = np.abs(g).max()
        if size <= tol * max(goals, 1.0):
            converged = True
            break
        # Loose at first, tight near the end: the error then shrinks quadratically.
        inner = min(0.1, math.sqrt(size / max(goals, 1.0)))
        step = _conjugate_gradients(blocks, t, x, g, diagonal, max(inner, 1e-8), 200)
        step = np.clip(np.where(held, 0.0, step), -2.0, 2.0)
        for _ in range(30):
            trial = x + step
            trial[:t] = np.maximum(trial[:t], lowest)
            trial[t:2 * t] = np.minimum(trial[t:2 * t], -lowest)
            state = _summed(blocks, _likelihood_pass(t, trial))
            if state[0] >= value - 1e-12 * abs(value):
                break
            step = step / 2
        x = trial
    blocks.unpersist()
    ma, md = x[:t].mean(), x[t:2 * t].mean()
    table = spark.createDataFrame(pd.DataFrame({"team_id": teams, "attack": x[:t] - ma, "defence": x[t:2 * t] - md}))
    return PoissonParams(table.checkpoint(), float(x[2 * t]), float(x[2 * t + 1] + ma - md), converged, iterations,
                         "mle-newton-cg")


def goal_balance(matches: DataFrame, params: PoissonParams) -> DataFrame:
    """M03 check: goals scored and conceded per team, observed and expected (equal at the optimum)."""
    m = expected_goals(_matches(matches), params)
    side = m.select(F.explode(F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.col("home_goals").alias("gf"), F.col("away_goals").alias("ga"),
                 F.col("expected_home_goals").alias("ef"), F.col("expected_away_goals").alias("ea")),
        F.struct(F.col("away_team_id").alias("team_id"), F.col("away_goals").alias("gf"), F.col("home_goals").alias("ga"),
                 F.col("expected_away_goals").alias("ef"), F.col("expected_home_goals").alias("ea")))).alias("x"))
    return side.select("x.*").groupBy("team_id").agg(
        F.sum("gf").cast("long").alias("scored"), F.sum("ga").cast("long").alias("conceded"),
        F.round(F.sum("ef"), 3).alias("expected_scored"), F.round(F.sum("ea"), 3).alias("expected_conceded"))


# --- M05 / M06 prediction ----------------------------------------------------------------------

def expected_goals(fixtures: DataFrame, params: PoissonParams) -> DataFrame:
    """mu_home / mu_away per fixture; unknown teams get 0.0 parameters."""
    teams = Lookup(params.teams.select("team_id", "attack", "defence"))
    spread = "fixture_id" if "fixture_id" in fixtures.columns else "away_team_id"
    j = teams.join(fixtures, {"home_team_id": "team_id"}, {"_ha": "attack", "_hd": "defence"}, spread)
    j = teams.join(j, {"away_team_id": "team_id"}, {"_aa": "attack", "_ad": "defence"}, spread)
    z = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("_ha", "_hd", "_aa", "_ad")}
    c, h = F.lit(params.intercept), F.lit(params.home_advantage)
    return j.withColumns({
        "expected_home_goals": F.exp(c + h + z["_ha"] - z["_ad"]),
        "expected_away_goals": F.exp(c + z["_aa"] - z["_hd"]),
    }).drop("_ha", "_hd", "_aa", "_ad")


def _pmf(mu: Column) -> list[Column]:
    """P(X = k), k = 0..MAX_GOALS-1, by the recurrence p_k = p_{k-1} * mu / k."""
    out = [F.exp(-mu)]
    for k in range(1, MAX_GOALS):
        out.append(out[-1] * mu / F.lit(float(k)))
    return out


def outcome_probs(df: DataFrame, mu_home: str = "expected_home_goals",
                  mu_away: str = "expected_away_goals", prefix: str = "poisson") -> DataFrame:
    """Home/draw/away probabilities from the 7x7 independent score grid,
    normalised to sum 1.  Closed column expressions (no UDF, no join)."""
    ph, pa = _pmf(F.col(mu_home)), _pmf(F.col(mu_away))
    # prefix sums of the away pmf give the lower/upper triangle sums
    cum_a = [pa[0]]
    for k in range(1, MAX_GOALS):
        cum_a.append(cum_a[-1] + pa[k])
    home = sum((ph[i] * cum_a[i - 1] for i in range(2, MAX_GOALS)), ph[1] * cum_a[0])
    draw = sum((ph[i] * pa[i] for i in range(1, MAX_GOALS)), ph[0] * pa[0])
    total_a = cum_a[-1]
    away = sum((ph[i] * (total_a - cum_a[i]) for i in range(1, MAX_GOALS - 1)),
               ph[0] * (total_a - cum_a[0]))
    tmp = df.withColumns({"_ph": home, "_pd": draw, "_pa": away})
    tot = F.col("_ph") + F.col("_pd") + F.col("_pa")
    return tmp.withColumns({
        f"{prefix}_home_prob": F.col("_ph") / tot,
        f"{prefix}_draw_prob": F.col("_pd") / tot,
        f"{prefix}_away_prob": F.col("_pa") / tot,
    }).drop("_ph", "_pd", "_pa")
