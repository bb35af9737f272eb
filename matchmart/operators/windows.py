"""Ordered-window operators that stay correct and parallel on hot keys.

``rolling_avg`` is the reference's rolling-average macro: mean of the current
row and the previous ``n - 1`` rows of the same partition, ordered by the order
columns (a ROWS frame, not a time range).

Three strategies compute the same rows:

``window``
    one ``Window.partitionBy(partition).orderBy(order).rowsBetween(-(n-1), 0)``.
    Every partition key is processed by exactly one task, so a key holding a
    third of the data puts a third of the data into one task.

``chunked``
    the ordered sequence of each partition key is cut into chunks by a column
    that is monotone in the order (by default the calendar day of the first
    order column).  The window runs per ``(partition, chunk)`` and every chunk
    receives a *halo*: the last ``H`` rows of its key that precede the chunk,
    where ``H`` is the largest look-back.  The halo is computed from per-chunk
    tails (``row_number`` <= H, which Spark limits map-side before the shuffle
    with ``WindowGroupLimit``) and a small per-chunk count table, so the only
    full-data shuffle is the one hash exchange on ``(partition, chunk)``.  The
    result is exact for ROWS frames: a chunk with fewer than ``H`` rows is
    handled because the halo is taken across as many earlier chunks as needed.

``auto`` (default)
    one cheap aggregate counts rows per key and keeps the keys above
    ``hot_key_rows`` (at most ``total / hot_key_rows`` keys, so the list is
    bounded and broadcast safely).  Without hot keys the plain window runs;
    otherwise hot keys take the chunked path and all other keys the plain
    window, and the two results are unioned.  A day of a hot key above the
    limit is cut further into ranges of the order columns (``with_ranges``), so
    ids of any type and rows of one timestamp spread as well.

Both strategies order ties by every order column given; callers always pass a
unique last key (fixture id) so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_HALO = "_mm_halo"
_REV = "_mm_rev"
_DAY, _RANGE = "_mm_day", "_mm_range"
_PER_RANGE = 32  # sampled rows per range
# Rows per key above which a key counts as hot (one task handles fewer rows
# comfortably).  Session conf ``spark.matchmart.hotKeyRows`` overrides it.
HOT_KEY_ROWS = 2_000_000


def _hot_limit(df: DataFrame, hot_key_rows: int | None) -> int:
    if hot_key_rows is not None:
        return hot_key_rows
    return int(df.sparkSession.conf.get("spark.matchmart.hotKeyRows", str(HOT_KEY_ROWS)))


def hot_keys(df: DataFrame, partition_by: Sequence[str], hot_key_rows: int | None = None):
    """Keys with more than ``hot_key_rows`` rows, or None when there are none.

    The result has at most ``rows / hot_key_rows`` entries (a proven bound), is
    collected once and returned as a small literal DataFrame for broadcasting.
    """
    limit = _hot_limit(df, hot_key_rows)
    part = list(partition_by)
    hot = (df.groupBy(*part).count().filter(F.col("count") > limit)
           .select(*part).collect())
    if not hot:
        return None
    return df.sparkSession.createDataFrame([tuple(r) for r in hot], df.select(*part).schema)


def with_ranges(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], day: str, limit: int,
                name: str = _RANGE) -> DataFrame:
    """Add ``name``: 0, or for a (key, day) of more than ``limit`` rows the number of the row's range.

    The ranges follow the order columns whatever their types, ties on the first
    ones included: their borders are every ``_PER_RANGE``-th row of a sample of
    about ``_PER_RANGE`` rows a range, drawn by a hash, so a range has about
    ``limit`` rows.  Only days above the limit have borders, about
    rows / limit of them in all, which is what is broadcast.
    """
    part = [*partition_by, day]
    place = F.struct(*order_by)
    large = (df.groupBy(*part).count().filter(F.col("count") > limit)
             .select(*part, F.ceil(F.col("count") / limit).alias("_mm_pieces"), F.col("count").alias("_mm_n")))
    drawn = F.pmod(F.xxhash64(F.lit(11), *order_by), F.lit(1 << 30)) < F.least(
        F.lit(1 << 30), F.ceil(F.col("_mm_pieces") * F.lit(float(_PER_RANGE << 30)) / F.col("_mm_n")))
    borders = (df.join(F.broadcast(large), part).filter(drawn).groupBy(*part)
               .agg(F.sort_array(F.collect_list(place)).alias("_mm_s"), F.first("_mm_pieces").alias("_mm_pieces"))
               .select(*part, F.filter("_mm_s", lambda x, i: (i > 0) & (i % _PER_RANGE == 0)).alias("_mm_borders")))
    passed = F.filter("_mm_borders", lambda b: b <= place)
    return (df.join(F.broadcast(borders), part, "left")
            .withColumn(name, F.coalesce(F.size(passed), F.lit(0))).drop("_mm_borders"))


def _auto(df: DataFrame, partition_by, hot_key_rows, plain, chunked, order_by=None) -> DataFrame:
    hot = hot_keys(df, partition_by, hot_key_rows)
    if hot is None:
        return plain(df)
    hot_b = F.broadcast(hot)
    hot_df = df.join(hot_b, list(partition_by), "left_semi")
    rest = plain(df.join(hot_b, list(partition_by), "left_anti"))
    if not order_by:
        return rest.unionByName(chunked(hot_df))
    ranged = with_ranges(hot_df.withColumn(_DAY, F.to_date(F.col(order_by[0]))), partition_by, order_by, _DAY,
                         _hot_limit(df, hot_key_rows))
    return rest.unionByName(chunked(ranged, [F.col(_DAY), F.col(_RANGE)]).drop(_DAY, _RANGE))


def chunked_window(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    halo: int,
    compute: Callable[[WindowSpec], dict[str, Column]],
    chunk_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Apply row-frame window expressions with a bounded look-back per chunk.

    ``compute(spec)`` receives a WindowSpec partitioned by
    ``partition_by + chunk`` and ordered by ``order_by`` and returns the new
    columns.  Every frame it uses must look back at most ``halo`` rows and never
    forward.  ``chunk_by`` must be non-decreasing along ``order_by`` inside a
    partition (default: ``to_date(order_by[0])``).
    """
    part = list(partition_by)
    order = list(order_by)
    if chunk_by is None:
        chunk_by = [F.to_date(F.col(order[0]))]
    chunk_names = [f"_mm_chunk{i}" for i in range(len(chunk_by))]
    base = df.withColumns(dict(zip(chunk_names, chunk_by)))
    keys = part + chunk_names

    if halo <= 0:
        spec = Window.partitionBy(*keys).orderBy(*order)
        return base.withColumns(compute(spec)).drop(*chunk_names)

    # 1. per-chunk tails: the last `halo` rows of every (partition, chunk).
    rev = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    tails = base.withColumn(_REV, F.row_number().over(rev)).filter(F.col(_REV) <= halo)

    # 2. chunk table: kept tail rows per chunk, running total before each chunk
    #    and the next `halo` chunks (a chunk holds >= 1 row, so a tail row can
    #    only reach the halos of the next `halo` chunks).
    ct = tails.groupBy(*keys).agg(F.count(F.lit(1)).alias("_mm_c"))
    seq = Window.partitionBy(*part).orderBy(*chunk_names)
    ct = ct.withColumn(
        "_mm_cb",
        F.coalesce(F.sum("_mm_c").over(seq.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    nxt = F.struct(*[F.col(c).alias(c) for c in chunk_names], F.col("_mm_cb").alias("_mm_cb"))
    ct = ct.withColumn("_mm_next", F.collect_list(nxt).over(seq.rowsBetween(1, halo)))

    # 3. a tail row belongs to the halo of a later chunk when fewer than `halo`
    #    rows lie between it and that chunk.
    cand = tails.join(ct, on=keys, how="inner")
    cand = cand.withColumn("_mm_t", F.explode("_mm_next"))
    between = (F.col(_REV) - 1) + (F.col("_mm_t._mm_cb") - F.col("_mm_cb") - F.col("_mm_c"))
    halo_rows = cand.filter(between < halo)
    halo_rows = halo_rows.withColumns({c: F.col(f"_mm_t.{c}") for c in chunk_names})
    halo_rows = halo_rows.select(*base.columns).withColumn(_HALO, F.lit(True))

    full = base.withColumn(_HALO, F.lit(False)).unionByName(halo_rows)
    spec = Window.partitionBy(*keys).orderBy(*order)
    out = full.withColumns(compute(spec)).filter(~F.col(_HALO))
    return out.drop(_HALO, *chunk_names)


def rolling_avg(
    df: DataFrame,
    specs: dict[str, tuple[str, int]],
    partition_by: Sequence[str],
    order_by: Sequence[str],
    strategy: str = "auto",
    include_current: bool = True,
    chunk_by: Sequence[Column] | None = None,
    hot_key_rows: int | None = None,
) -> DataFrame:
    """Add ``avg(col)`` over the last ``n`` rows for each ``out: (col, n)``.

    ``include_current=False`` shifts the frame to the ``n`` rows *before* the
    current one (leak-free form features); the default is the reference frame.
    """
    def frame(spec: WindowSpec, n: int) -> WindowSpec:
        return spec.rowsBetween(-(n - 1), 0) if include_current else spec.rowsBetween(-n, -1)

    def compute(spec: WindowSpec) -> dict[str, Column]:
        return {out: F.avg(F.col(c)).over(frame(spec, n)) for out, (c, n) in specs.items()}

    look_back = max(n for _, n in specs.values()) - (1 if include_current else 0)

    def plain(d: DataFrame) -> DataFrame:
        return d.withColumns(compute(Window.partitionBy(*partition_by).orderBy(*order_by)))

    def chunked(d: DataFrame, chunks=None) -> DataFrame:
        return chunked_window(d, partition_by, order_by, look_back, compute, chunks or chunk_by)

    if strategy == "window":
        return plain(df)
    if strategy == "chunked":
        return chunked(df)
    if strategy == "auto":
        return _auto(df, partition_by, hot_key_rows, plain, chunked,
                     order_by=None if chunk_by else order_by)
    raise ValueError(f"unknown strategy {strategy!r}")


def lag_by(
    df: DataFrame,
    specs: dict[str, str],
    partition_by: Sequence[str],
    order_by: Sequence[str],
    strategy: str = "auto",
    chunk_by: Sequence[Column] | None = None,
    hot_key_rows: int | None = None,
) -> DataFrame:
    """Add ``lag(col, 1)`` per partition for each ``out: col``."""
    def compute(spec: WindowSpec) -> dict[str, Column]:
        return {out: F.lag(F.col(c), 1).over(spec) for out, c in specs.items()}

    def plain(d: DataFrame) -> DataFrame:
        return d.withColumns(compute(Window.partitionBy(*partition_by).orderBy(*order_by)))

    def chunked(d: DataFrame, chunks=None) -> DataFrame:
        return chunked_window(d, partition_by, order_by, 1, compute, chunks or chunk_by)

    if strategy == "window":
        return plain(df)
    if strategy == "chunked":
        return chunked(df)
    return _auto(df, partition_by, hot_key_rows, plain, chunked,
                 order_by=None if chunk_by else order_by)


def top_n(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
          n: int, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per key by ``order_by``.

    ``row_number() <= n`` is planned as a map-side ``WindowGroupLimit`` before
    the shuffle, so a hot key ships at most ``n`` rows per map task.
    """
    name = rank_col or "_mm_rn"
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)
