"""Declarative data-quality operators (Q01-Q09).

Contract (same as a SQL data test): a check returns the DataFrame of *failing*
rows and passes when it is empty.  All failures share one schema

    check STRING, model STRING, column STRING, key STRING, value STRING

so the checks of a model can be unioned into one report.

Row-level checks (not_null, accepted_values, between) of one model run in a
single scan: each row produces an array with one entry per failed check, which
is exploded (rows that pass produce nothing).  ``unique`` is one aggregate per
column (partial aggregation map-side, so a hot value costs one counter per map
task), ``relationships`` one left-anti join per foreign key.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C

FAILURE_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("column", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType())])


@dataclass(frozen=True)
class Check:
    """One declared test.  ``kind``: not_null | unique | accepted_values |
    between | relationships."""
    kind: str
    column: str
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    parent: str | None = None          # model name of the referenced table
    parent_column: str | None = None
    params: dict = field(default_factory=dict, compare=False, hash=False)


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def accepted_values(column: str, values) -> Check:
    return Check("accepted_values", column, values=tuple(values))


def between(column: str, min_value=None, max_value=None) -> Check:
    return Check("between", column, min_value=min_value, max_value=max_value)


def relationships(column: str, parent: str, parent_column: str) -> Check:
    return Check("relationships", column, parent=parent, parent_column=parent_column)


def _failure(check: str, model: str, column: str, key: Column, value: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(model).alias("model"),
                    F.lit(column).alias("column"), key.cast("string").alias("key"),
                    value.cast("string").alias("value"))


def _row_condition(chk: Check) -> Column:
    """True when the row FAILS the check (nulls pass every check but not_null)."""
    c = F.col(chk.column)
    if chk.kind == "not_null":
        return c.isNull()
    if chk.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*chk.values)
    if chk.kind == "between":
        cond = F.lit(False)
        if chk.min_value is not None:
            cond = cond | (c < F.lit(chk.min_value))
        if chk.max_value is not None:
            cond = cond | (c > F.lit(chk.max_value))
        return c.isNotNull() & cond
    raise ValueError(chk.kind)


def row_level_failures(df: DataFrame, model: str, key: str, checks: list[Check]) -> DataFrame:
    """Evaluate every row-level check of a model in one pass."""
    row_checks = [c for c in checks if c.kind in ("not_null", "accepted_values", "between")]
    if not row_checks:
        return df.sparkSession.createDataFrame([], FAILURE_SCHEMA)
    entries = [F.when(_row_condition(c), _failure(c.kind, model, c.column, F.col(key),
                                                  F.col(c.column)))
               for c in row_checks]
    arr = F.filter(F.array(*entries), lambda x: x.isNotNull())
    return df.select(F.explode(arr).alias("f")).select("f.*")


def unique_failures(df: DataFrame, model: str, column: str) -> DataFrame:
    """Values that occur more than once (nulls ignored)."""
    dup = (df.filter(F.col(column).isNotNull()).groupBy(column).count()
           .filter(F.col("count") > 1))
    return dup.select(_failure("unique", model, column, F.col(column),
                               F.col("count")).alias("f")).select("f.*")


def relationship_failures(child: DataFrame, model: str, column: str,
                          parent: DataFrame, parent_column: str, key: str) -> DataFrame:
    """Child rows whose non-null FK has no parent row (left-anti join)."""
    p = parent.select(F.col(parent_column).alias("_mm_pk")).distinct()
    orphans = child.filter(F.col(column).isNotNull()).join(
        p, F.col(column) == F.col("_mm_pk"), "left_anti")
    return orphans.select(_failure("relationships", model, column, F.col(key),
                                   F.col(column)).alias("f")).select("f.*")


def run_checks(df: DataFrame, model: str, key: str, checks: list[Check],
               parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """All failures of all checks of one model."""
    parts = [row_level_failures(df, model, key, checks)]
    for c in checks:
        if c.kind == "unique":
            parts.append(unique_failures(df, model, c.column))
        elif c.kind == "relationships":
            parent = (parents or {})[c.parent]
            parts.append(relationship_failures(df, model, c.column, parent,
                                               c.parent_column, key))
    return reduce(DataFrame.unionByName, parts)


def summary(spark: SparkSession, failures: DataFrame, declared: list[tuple[str, str, str]]) -> DataFrame:
    """One row per declared (check, model, column): failure count and status."""
    decl = spark.createDataFrame(declared, "check string, model string, column string")
    counts = failures.groupBy("check", "model", "column").agg(F.count(F.lit(1)).alias("failures"))
    out = decl.join(counts, ["check", "model", "column"], "left").fillna(0, ["failures"])
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def source_freshness(df: DataFrame, source: str, loaded_at: str, now,
                     warn_hours: float = 12, error_hours: float = 24) -> DataFrame:
    """Q06: one row per source: newest load, its age in hours and
    pass / warn (> warn_hours) / error (> error_hours)."""
    now_c = C.ts_lit(now)
    agg = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    # difference of wall times, independent of the session time zone (DST)
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now_c) / 3600.0
    agg = agg.withColumn("age_hours", F.round(age, 3))
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
              .when(F.col("age_hours") > error_hours, "error")
              .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))
    return agg.select(F.lit(source).alias("source"), "max_loaded_at", "age_hours",
                      status.alias("status"))


def row_count_deviation(current: DataFrame, previous: DataFrame, name: str,
                        threshold: float = 0.20) -> DataFrame:
    """Q09: row count moved more than ``threshold`` (relative) between runs."""
    tagged = (current.select(F.lit(1).alias("_c"), F.lit(0).alias("_p"))
              .unionByName(previous.select(F.lit(0).alias("_c"), F.lit(1).alias("_p"))))
    j = tagged.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("current_rows"),
                   F.coalesce(F.sum("_p"), F.lit(0)).cast("long").alias("previous_rows"))
    dev = F.abs(F.col("current_rows") - F.col("previous_rows")) / F.nullif(F.col("previous_rows"), F.lit(0))
    j = j.withColumn("deviation", F.round(dev, 6))
    return j.select(F.lit(name).alias("model"), "previous_rows", "current_rows", "deviation",
                    F.when(F.col("deviation").isNull() | (F.col("deviation") > threshold), "fail")
                    .otherwise("pass").alias("status"))
