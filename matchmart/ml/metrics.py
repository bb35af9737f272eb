"""Evaluation metrics as aggregates.

Every metric is a column expression inside one ``agg``; per-league and overall
blocks come from a single ``rollup`` pass (``grouping()`` marks the overall
row) instead of one scan per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

# Fixed values
CLIP = 1e-7
BASELINE_ACCURACY = 0.50
CLASSES = [C.HOME_WIN, C.DRAW, C.AWAY_WIN]


def _clipped(df: DataFrame, probs: list[str]) -> DataFrame:
    """Clip probabilities to [1e-7, 1 - 1e-7] and renormalise each row."""
    cl = {p: F.least(F.greatest(F.col(p).cast("double"), F.lit(CLIP)), F.lit(1 - CLIP)) for p in probs}
    tot = sum(cl.values(), F.lit(0.0))
    return df.withColumns({f"_p{i}": cl[p] / tot for i, p in enumerate(probs)})


def metric_columns(actual: str = "actual_result", predicted: str = "predicted_result") -> list[Column]:
    """Aggregate expressions over rows with ``_p0.._p2`` (clipped probs)."""
    y = C.encode_target(actual)
    correct = F.col(predicted) == F.col(actual)
    p_true = F.when(y == 0, F.col("_p0")).when(y == 1, F.col("_p1")).otherwise(F.col("_p2"))
    brier = sum(((F.when(y == c, 1.0).otherwise(0.0) - F.col(f"_p{c}")) ** 2 for c in range(3)),
                F.lit(0.0)) / 3.0
    n = F.count(F.lit(1))
    n_correct = F.sum(F.when(correct, 1).otherwise(0))
    return [
        n.alias("n_matches"),
        F.round(n_correct / n, 4).alias("accuracy"),
        F.round(-F.avg(F.log(p_true)), 4).alias("log_loss"),
        F.round(F.avg(brier), 4).alias("brier_score"),
        F.round((n_correct - (n - n_correct)) / n, 4).alias("flat_bet_roi"),
        n_correct.cast("long").alias("n_correct"),
        (n - n_correct).cast("long").alias("n_wrong"),
    ]


def evaluation_rows(predictions: DataFrame, features: DataFrame | None = None, league_id=None,
                    since=None) -> DataFrame:
    """Predictions joined to finished fixtures (the evaluation input); without ``features`` the
    predictions are the fact that has their dates and results already, and nothing is joined."""
    j = predictions
    if features is not None:
        f = features.select("fixture_id", "match_date", F.col("match_result").alias("actual_result"))
        j = predictions.join(f, "fixture_id", "inner")
    j = j.filter(F.col("actual_result").isNotNull())
    if league_id is not None:
        j = j.filter(F.col("league_id") == F.lit(league_id))
    if since is not None:
        j = j.filter(F.col("match_date") >= C.ts_lit(since))
    return j


def classification_metrics(rows: DataFrame, probs=("hybrid_home_prob", "hybrid_draw_prob",
                                                    "hybrid_away_prob")) -> DataFrame:
    """One row of accuracy, log loss, Brier, ROI and counts."""
    return _clipped(rows, list(probs)).agg(*metric_columns())


def metrics_by_group(rows: DataFrame, group: str = "league_id",
                     probs=("hybrid_home_prob", "hybrid_draw_prob", "hybrid_away_prob"),
                     extra: list[Column] | None = None) -> DataFrame:
    """A10: per-group metrics plus the overall row in one rollup pass."""
    x = _clipped(rows, list(probs))
    out = x.rollup(group).agg(*metric_columns(), *(extra or []), F.grouping(group).alias("_g"))
    return out.withColumn("scope", F.when(F.col("_g") == 1, "overall").otherwise("league")).drop("_g")


def confusion_matrix(rows: DataFrame, actual: str = "actual_result",
                     predicted: str = "predicted_result") -> DataFrame:
    """3x3 counts (rows = actual, columns = predicted)."""
    return (rows.groupBy(actual).pivot(predicted, CLASSES).count()
            .fillna(0, CLASSES))


def distinct_versions(predictions: DataFrame) -> DataFrame:
    """Distinct non-null model versions."""
    return predictions.select("model_version").dropna().distinct()


def champion_gate(metrics: DataFrame, model_version: str,
                  baseline: float = BASELINE_ACCURACY) -> DataFrame:
    """Accept the model when accuracy > baseline (one row)."""
    return metrics.select(F.lit(model_version).alias("model_version"), "accuracy",
                          F.lit(baseline).alias("baseline_accuracy"),
                          (F.col("accuracy") > F.lit(baseline)).alias("registered"))


def eval_report(rows: DataFrame, league_filter=None, since=None) -> DataFrame:
    """The report as rows: overall + per-league metric blocks, the model
    versions seen and the filters used."""
    # the version list is bounded by the number of distinct model versions
    versions = F.sort_array(F.collect_set("model_version")).alias("model_versions")
    blocks = metrics_by_group(rows, extra=[versions])
    return (blocks.withColumn("filter_league", F.lit(league_filter).cast("long"))
            .withColumn("filter_since", F.lit(since).cast("string")))


def save_report(report: DataFrame, store, name: str = "eval_report") -> DataFrame:
    """K10 sink: the report rows written as a JSON table version (one small
    file per block group) and read back with the same schema."""
    store.write(report, name, fmt="json")
    return store.read(name, schema=report.schema)


def register_champion(gate: DataFrame, store, registered_at, name: str = "model_registry") -> DataFrame:
    """M17 sink: append the gate row of an accepted model to the registry table
    (insert-if-absent by model version, so re-running the gate is a no-op)."""
    row = gate.filter(F.col("registered")).withColumn("registered_at", C.ts_lit(registered_at))
    current = store.read(name)
    if current is None:
        merged = row
    else:
        # the gate is one row: test the key with a filter instead of a join on
        # a constant (which would plan as a nested-loop join)
        versions = [r["model_version"] for r in row.select("model_version").collect()]
        known = versions and current.filter(F.col("model_version").isin(*versions)).limit(1).count() > 0
        merged = current if (not versions or known) else current.unionByName(row)
    store.write(merged, name)
    return store.read(name)
