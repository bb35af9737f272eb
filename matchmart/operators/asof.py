"""As-of join: for every probe row, the latest data row of the same key whose
timestamp is strictly before the probe's (SURVEY D08: last known form).

Skew-safe formulation, no per-key and no per-day task: data and probes are one
timeline per key, ordered by (timestamp, probes first, tie column, probe key), and
cut into chunks: a day, or the ranges of a day that has more rows than
``spark.matchmart.hotKeyRows`` (``windows.with_ranges``; the probes of one timestamp
are cut by their keys as well).  (1) Per chunk the last data row (``max_by``,
partial aggregation); (2) on that small table, one row per key and chunk, the last
data row of any *earlier* chunk is a running ``last(ignorenulls)``; (3) inside a
chunk the last earlier data row comes from a window over (key, chunk).  The answer
is the hit in the chunk, else the one carried across its border.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import _hot_limit, with_ranges


def asof_join(probes: DataFrame, data: DataFrame, by: Sequence[str], probe_ts: str,
              data_ts: str, value_cols: Sequence[str], probe_key: Sequence[str],
              tie_col: str | None = None, prefix: str = "", hot_key_rows: int | None = None) -> DataFrame:
    """Attach ``value_cols`` of the latest ``data`` row with ``data_ts <
    probe_ts`` (same ``by`` key) to each probe.  ``probe_key`` identifies a
    probe row uniquely (deterministic under task retries); ``tie_col`` orders
    data rows that share a timestamp (the last one wins)."""
    by = list(by)
    pk = [c for c in probe_key if c not in by]
    tie = [F.col(tie_col)] if tie_col else []
    payload = F.struct(F.col(data_ts).alias("_ts"), *tie, *[F.col(c) for c in value_cols])
    # only the last data row of each (key, timestamp) can ever be returned:
    # reduce the data side to it first (partial aggregation, map-side)
    d = data.select(*by, F.col(data_ts).alias("_t"), payload.alias("_v"))
    last = F.max_by("_v", F.col(f"_v.{tie_col}")) if tie_col else F.max("_v")
    d = d.groupBy(*by, "_t").agg(last.alias("_v"))
    p_kinds = dict(probes.dtypes)
    d = d.select(*by, "_t", F.lit(1).alias("_side"), *[F.lit(None).cast(p_kinds[c]).alias(c) for c in pk], "_v")
    p = probes.select(*by, F.col(probe_ts).alias("_t"), F.lit(0).alias("_side"), *pk,
                      F.lit(None).cast(d.schema["_v"].dataType).alias("_v"))
    # a probe stands before data of its own timestamp: only strictly earlier data precede it
    order = ["_t", "_side", *pk]
    both = d.unionByName(p).withColumn("_day", F.to_date("_t"))
    both = with_ranges(both, by, order, "_day", _hot_limit(both, hot_key_rows), "_range")
    chunk = ["_day", "_range"]
    # (1) and (2): the last data row of each chunk, carried over the borders
    per_chunk = both.groupBy(*by, *chunk).agg(
        F.max_by("_v", F.when(F.col("_side") == 1, F.col("_t"))).alias("_last"))
    w_chunks = Window.partitionBy(*by).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(*by, *chunk, F.last("_last", ignorenulls=True).over(w_chunks).alias("_before"))
    # (3) inside the chunk
    w_in = (Window.partitionBy(*by, *chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    inside = both.withColumn("_prev", F.last("_v", ignorenulls=True).over(w_in)).filter(F.col("_side") == 0)
    same = [inside[c].eqNullSafe(carried[c]) for c in (*by, *chunk)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    res = inside.join(carried, on, "left")
    hit = F.coalesce(inside["_prev"], carried["_before"])
    res = res.select(*[inside[c] for c in by + pk], *[hit[c].alias(f"{prefix}{c}") for c in value_cols],
                     hit["_ts"].alias(f"{prefix}asof_ts"))
    return probes.join(res, by + pk, "left")
