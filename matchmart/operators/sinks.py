"""Materialisation and keyed writes.

No table format with MERGE is available, so every keyed write is expressed as
DataFrame algebra (left-anti join + union) and materialised into a *new*
version directory; a small pointer file is then switched to the new version.
A path is never read and overwritten in the same job, a failed job leaves the
previous version current, and a retried task rewrites only its own files.

All state lives under the shared folder given by ``spark.checkpoint.dir`` (see
``session.ensure_checkpoint_dir``), never on a machine-local disk.
"""

from __future__ import annotations

import hashlib
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..session import ensure_checkpoint_dir


#: ``based_on`` of a write that replaces whatever is there.
_ANY = object()


# --- K01 / K02 / K05: views, ephemeral models, schema sync ------------------------------

def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy view and return it (re-planned at every use)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ephemeral(df: DataFrame, fan_out: int = 1) -> DataFrame:
    """An inlined model; cached only when several consumers reuse it."""
    return df.persist() if fan_out > 1 else df


def sync_all_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The target's rows in the batch's schema: new columns appear (null
    for old rows), removed columns disappear, types follow the batch."""
    have = dict(target.dtypes)
    return target.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in batch.schema.fields])


# --- K07 / K08: keyed writes as DataFrame algebra -----------------------------------------

def dedupe_latest(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """Keep one row per key: the first by ``order`` (e.g. newest load).

    A hash of the whole row breaks remaining ties, so a recomputed task (after
    an executor loss) keeps the same row.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    w = Window.partitionBy(*key).orderBy(*order, tie)
    return df.withColumn("_mm_rn", F.row_number().over(w)).filter("_mm_rn = 1").drop("_mm_rn")


def with_known_key(batch: DataFrame, key: list[str]) -> DataFrame:
    """``batch``, failing the job on a null key: no stored row could ever match
    it, so every further delivery would add it again."""
    kinds = {f.name: f.dataType for f in batch.schema.fields}
    return batch.withColumns({
        k: F.coalesce(F.col(k), F.raise_error(F.lit(f"null in key column {k}")).cast(kinds[k])) for k in key})


def keyed_upsert(target: DataFrame, batch: DataFrame, key: list[str],
                 update_cols: list[str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE``.

    ``batch`` must hold one row per key (see ``dedupe_latest``).  With
    ``update_cols`` only those columns are replaced on conflict, every other
    column keeps the target's value.  Target rows without a batch row pass
    through a left-anti join, so the target is shuffled once and never joined
    to itself.  A null in a key fails the job.
    """
    batch = with_known_key(batch, key)
    keep = target.join(batch.select(*key), key, "left_anti")
    if update_cols is None:
        return keep.unionByName(batch.select(*target.columns))
    fixed = [c for c in target.columns if c not in update_cols and c not in key]
    # The marker tells a stored null from a row that is not stored.
    old = target.select(*key, F.lit(True).alias("_mm_stored"), *[F.col(c).alias(f"_mm_old_{c}") for c in fixed])
    upd = batch.join(old, key, "left")
    upd = upd.select(*key, *[F.when(F.col("_mm_stored"), F.col(f"_mm_old_{c}")).otherwise(F.col(c)).alias(c)
                             if c in fixed else F.col(c) for c in target.columns if c not in key])
    return keep.unionByName(upd.select(*target.columns))


def insert_if_absent(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """``ON CONFLICT DO NOTHING``: only new keys are added; a null key fails the job."""
    batch = with_known_key(batch, key)
    new = batch.join(target.select(*key), key, "left_anti")
    return target.unionByName(new.select(*target.columns))


# --- K04: incremental model ------------------------------------------------------------------

def incremental_batch(src: DataFrame, target: DataFrame | None, watermark: str,
                      lookback=None) -> DataFrame:
    """Rows of ``src`` newer than the target's watermark.

    The watermark is one scalar (``max`` over the target), turned into a
    literal predicate so the filter is pushed into the source scan.  An empty
    or missing target loads everything (the reference never loads in that
    case).  ``lookback`` (an interval string such as ``'1 day'``) re-reads late
    rows; the default keeps the strict ``>``.
    """
    if target is None:
        return src
    wm = target.agg(F.max(watermark).alias("wm")).first()["wm"]
    if wm is None:
        return src
    # a text literal cast to the column's type: no time-zone conversion
    bound = F.lit(wm.isoformat(sep=" ") if hasattr(wm, "isoformat") else wm).cast(
        target.schema[watermark].dataType)
    if lookback:
        bound = bound - F.expr(f"INTERVAL {lookback}")
    return src.filter(F.col(watermark) > bound)


def incremental_merge(src: DataFrame, target: DataFrame | None, key: list[str],
                      watermark: str, lookback=None) -> DataFrame:
    """New rows replace target rows with the same unique key."""
    batch = incremental_batch(src, target, watermark, lookback)
    if target is None:
        return batch
    return keyed_upsert(sync_all_columns(target, batch), batch, key)


# --- K06: type-2 snapshot ------------------------------------------------------------------

def scd2_snapshot(prev: DataFrame | None, src: DataFrame, key: str, updated_at: str,
                  run_ts, invalidate_hard_deletes: bool = True) -> DataFrame:
    """Timestamp-strategy snapshot.

    A key gets a new version when its ``updated_at`` advances; the open version
    is closed at the new ``updated_at``.  Keys missing from the source are
    closed at ``run_ts`` when ``invalidate_hard_deletes``.  Re-running with an
    unchanged source is a no-op.
    """
    upd = F.col(updated_at).cast("timestamp_ntz")

    def fresh(df):
        return df.select(*src.columns,
                         C.surrogate_key(key, updated_at).alias("dbt_scd_id"),
                         upd.alias("dbt_updated_at"), upd.alias("dbt_valid_from"),
                         F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))

    if prev is None:
        return fresh(src)
    closed_hist = prev.filter(F.col("dbt_valid_to").isNotNull())
    current = prev.filter(F.col("dbt_valid_to").isNull())
    s = src.select(F.col(key).alias("_mm_k"), upd.alias("_mm_src_upd"))
    j = current.join(s, current[key] == s["_mm_k"], "full_outer")
    in_cur, in_src = F.col("dbt_scd_id").isNotNull(), F.col("_mm_k").isNotNull()
    changed = in_cur & in_src & (F.col("_mm_src_upd") > F.col("dbt_updated_at"))
    deleted = in_cur & ~in_src
    run = C.ts_lit(run_ts)
    valid_to = (F.when(changed, F.col("_mm_src_upd"))
                .when(deleted & F.lit(invalidate_hard_deletes), run))
    cur_out = (j.filter(in_cur)
               .withColumn("dbt_valid_to", valid_to)
               .select(*prev.columns))
    # new versions: keys new to the snapshot or whose timestamp advanced
    new_keys = j.filter((in_src & ~in_cur) | changed).select(F.col("_mm_k").alias(key))
    inserts = fresh(src.join(new_keys, key, "left_semi"))
    return closed_hist.unionByName(cur_out).unionByName(inserts.select(*prev.columns))


# --- K03 / K09: versioned table store ---------------------------------------------------------

class TableStore:
    """Versioned parquet tables with an atomic pointer switch.

    ``root`` defaults to ``<spark.checkpoint.dir>/tables``.  Each ``write``
    creates ``<root>/<name>/v<time>-<id>``; only after the write succeeded the
    pointer ``<root>/<name>/_CURRENT`` is replaced by one overwriting rename.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or ensure_checkpoint_dir(spark).rstrip("/") + "/tables").rstrip("/")
        jvm = spark.sparkContext._jvm
        self._formats: dict[str, str] = {}
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _fs(self, path):
        return path.getFileSystem(self._conf)

    def _pointer(self, name: str):
        return self._Path(f"{self.root}/{name}/_CURRENT")

    def current(self, name: str) -> str | None:
        p = self._pointer(name)
        fs = self._fs(p)
        if not fs.exists(p):
            return None  # never committed: the pointer, once there, is only ever overwritten
        stream = fs.open(p)
        try:
            reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
                self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            line = reader.readLine()
        finally:
            stream.close()
        return f"{self.root}/{name}/{line.strip()}" if line else None

    def read(self, name: str, schema=None) -> DataFrame | None:
        path = self.current(name)
        if not path:
            return None
        fmt = self._formats.get(path) or ("json" if path.rsplit("/", 1)[-1].startswith("j") else "parquet")
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.json(path) if fmt == "json" else reader.parquet(path)

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None,
              fmt: str = "parquet", based_on=_ANY) -> str:
        """Materialise a new version and switch the pointer to it.

        ``based_on`` is the version (or None) that ``df`` was derived from; if
        another job has switched the pointer since, nothing is switched.

        ``partition_by`` lays the files out by those columns (e.g. ``season``)
        so readers filtering on them prune whole directories.  ``fmt="json"``
        writes JSON lines (reports); the version name records the format.
        """
        version = f"{'j' if fmt == 'json' else 'v'}{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        path = f"{self.root}/{name}/{version}"
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.json(path) if fmt == "json" else writer.parquet(path)
        self._formats[path] = fmt
        tmp = self._Path(f"{self.root}/{name}/_CURRENT.{version}.tmp")
        fs = self._fs(tmp)
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(version.encode("utf-8")))
        finally:
            out.close()
        if based_on is not _ANY and self.current(name) != based_on:
            raise RuntimeError(f"table {name!r} was written by another job meanwhile")
        # One rename that overwrites: a stop at any moment leaves the old or the new pointer.
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        overwrite = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        overwrite[0] = getattr(hadoop, "Options$Rename").OVERWRITE
        dst = self._pointer(name)
        hadoop.FileContext.getFileContext(dst.toUri(), self._conf).rename(
            fs.makeQualified(tmp), fs.makeQualified(dst), overwrite)
        return path

    def table_name(self, name: str) -> str:
        return f"mm_{hashlib.md5(self.root.encode()).hexdigest()[:12]}_{name}"

    def register(self, name: str, analyze: bool = True) -> DataFrame:
        """Expose the current version as an external catalog table (no data
        copied) and compute its statistics (row count and size) so the
        optimizer and AQE plan joins with real sizes.  The table's name carries
        the store's root, so no other table of that name is touched."""
        path = self.current(name)
        if path is None:
            raise ValueError(f"no table {name!r}")
        fmt = "json" if path.rsplit("/", 1)[-1].startswith("j") else "parquet"
        table = self.table_name(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{path}'")
        if analyze:
            self.spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        return self.spark.table(table)

    # K04 / K07 in persistent form -----------------------------------------------------

    def merge_incremental(self, src: DataFrame, name: str, key: list[str], watermark: str,
                          lookback=None) -> str:
        based_on, target = self.current(name), self.read(name)
        return self.write(incremental_merge(src, target, key, watermark, lookback), name, based_on=based_on)

    def upsert(self, batch: DataFrame, name: str, key: list[str],
               update_cols: list[str] | None = None) -> str:
        based_on, target = self.current(name), self.read(name)
        merged = with_known_key(batch, key) if target is None else keyed_upsert(target, batch, key, update_cols)
        return self.write(merged, name, based_on=based_on)

    def snapshot(self, src: DataFrame, name: str, key: str, updated_at: str, run_ts) -> str:
        based_on, prev = self.current(name), self.read(name)
        return self.write(scd2_snapshot(prev, src, key, updated_at, run_ts), name, based_on=based_on)
