"""Feature matrix, temporal split and stratified folds.

No operator here sorts the whole fact table or numbers it with an unpartitioned
window.  Row positions in (kick-off, id) order come from ranges: the narrow
(kick-off, id) rows are dealt by Spark's range partitioning (borders from a sample),
rows are counted per range, and an exact position needs the rows of one range only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.scan import FEATURE_COLUMNS, TARGET_COLUMN


def feature_matrix(df: DataFrame, features: list[str] | None = None,
                   vector: bool = False) -> DataFrame:
    """The 16 features, rows with nulls dropped, encoded target ``label``.
    ``vector=True`` adds the assembled ``features`` vector column."""
    feats = features or FEATURE_COLUMNS
    out = df.dropna(subset=feats + [TARGET_COLUMN]).select(
        "fixture_id", "match_date", *[F.col(c).cast("double").alias(c) for c in feats],
        C.encode_target(TARGET_COLUMN).cast("double").alias("label"))
    if vector:
        from pyspark.ml.feature import VectorAssembler
        out = VectorAssembler(inputCols=feats, outputCol="features").transform(out)
    return out


def _ranged(keys: DataFrame, order: list[str]) -> DataFrame:
    """``keys`` in ranges of ``order`` (``_range`` rises with it), written once to the shared folder."""
    return keys.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint()


def kth_in_order(keys: DataFrame, fraction: float, order: list[str]):
    """The row at position ``int(n * fraction)`` (1-based) by ``order``, or None.

    One pass deals the narrow rows to ranges; the exact position is looked for
    inside the one range that holds it (a range is one shuffle partition)."""
    ranged = _ranged(keys.select(*order), order)
    counts = sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect())
    rest = int(sum(n for _, n in counts) * fraction)
    if rest <= 0:
        return None
    for number, n in counts:
        if rest <= n:
            break
        rest -= n
    first = ranged.where(F.col("_range") == number).orderBy(*order).limit(rest)
    return first.agg(F.max(F.struct(*order)).alias("x")).first()["x"]


def temporal_split(df: DataFrame, train_fraction: float = 0.8, day_col: str = "match_date",
                   id_col: str = "fixture_id") -> DataFrame:
    """Add ``is_train``: the first ``int(n * fraction)`` rows in (kick-off,
    id) order are training rows, the rest test rows.

    Only the narrow (kick-off, id) projection is read for the cut; the flag
    itself is a lazy column expression on ``df``.
    """
    cut = kth_in_order(df, train_fraction, [day_col, id_col])
    if cut is None:
        return df.withColumn("is_train", F.lit(False))
    kind = df.schema[day_col].dataType
    when = F.lit(cut[day_col].isoformat(sep=" ") if hasattr(cut[day_col], "hour") else str(cut[day_col])).cast(kind)
    t = F.col(day_col)
    return df.withColumn("is_train", (t < when) | ((t == when) & (F.col(id_col) <= F.lit(cut[id_col]))))


def class_positions(df: DataFrame, label: str = "label", day_col: str = "match_date",
                    id_col: str = "fixture_id") -> DataFrame:
    """0-based position of each row inside its class in (kick-off, id) order.

    The narrow rows are dealt to ranges of (class, kick-off, id); a row's
    position is the rows of its class in earlier ranges plus its place inside its
    range.  No window sees a whole class."""
    ranged = _ranged(df.select(label, day_col, id_col), [label, day_col, id_col])
    cells = ranged.groupBy(label, "_range").count()  # one row per range and class
    before = Window.partitionBy(label).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(label, "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy(label, "_range").orderBy(day_col, id_col)) - 1
    places = (ranged.withColumn("_in", inside).join(cells, [label, "_range"])
              .select(id_col, (F.col("_off") + F.col("_in")).alias("_pos")))
    return df.join(places, id_col)


def stratified_folds(df: DataFrame, n_splits: int = 5, label: str = "label") -> DataFrame:
    """Stratified k-fold ids without shuffling.

    The labels sorted ascending are dealt round-robin to the folds; class c
    therefore gets ``#{p in [s_c, s_c + n_c) : p % k == f}`` rows in fold f
    (s_c = rows of smaller classes), taken in time order.
    """
    counts = df.groupBy(label).count().orderBy(label).collect()  # one row per class
    start, bounds = 0, {}
    for r in counts:
        n_c = r["count"]
        alloc = [n_c // n_splits + (1 if (f - start) % n_splits < n_c % n_splits else 0)
                 for f in range(n_splits)]
        cum, edges = 0, []
        for a in alloc:
            cum += a
            edges.append(cum)
        bounds[r[label]] = edges
        start += n_c
    pos = class_positions(df, label)
    fold: Column | None = None
    for cls, edges in bounds.items():
        expr = None
        for f, e in enumerate(edges):
            expr = F.when(F.col("_pos") < e, f) if expr is None else expr.when(F.col("_pos") < e, f)
        cond = F.col(label) == F.lit(cls)
        fold = F.when(cond, expr) if fold is None else fold.when(cond, expr)
    return pos.withColumn("fold", fold).drop("_pos")
