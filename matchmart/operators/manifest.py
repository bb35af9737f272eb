"""Keyed tables that are rewritten only where a delivery changes them (K04, K06-K08, ST1).

A table is a set of parts; a part is a list of Parquet folders.  A row's part
follows from its key alone: a hash bucket, or with ``width`` a range of a whole-number
key (ids that grow with time then touch the last ranges only).  A manifest names
every part's folders, its rows and the greatest value of the tracked columns;
folders are never changed once written.

A write reads the newest manifest, finds the parts its batch touches, writes
their new folders, and commits manifest ``n + 1`` = manifest ``n`` with those parts
replaced.  Committing is one step that fails if ``n + 1`` exists (a hard link on a
local file system, a rename without overwriting elsewhere), so of two writers one
loses.  The loser looks at what was committed meanwhile: when its own parts and
the schema are as it read them, it commits on top of that, else it computes
anew.  Folders that no manifest names belong to failed or lost attempts.

Batches are written to the shared checkpoint folder once, checked there (a null
or a repeated key is refused) and then merged, so a batch is computed once.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..session import scratch_dir
from . import sinks as K

BUCKETS = 64
ATTEMPTS = 20
_PART = "_mm_part"


class ManifestStore:
    """Keyed tables under ``root`` (default: a fresh folder of the shared checkpoint folder)."""

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.root = (root or scratch_dir(spark, "manifest-tables")).rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # --- manifests ------------------------------------------------------------------------------

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _numbers(self, name: str) -> list[int]:
        folder = self._path(f"{self.root}/{name}/_manifest")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, name: str, number: int | None = None) -> dict | None:
        """Manifest ``number`` (default: the newest), or None when the table does not exist."""
        if number is None:
            numbers = self._numbers(name)
            if not numbers:
                return None
            number = numbers[-1]
        path = self._path(f"{self.root}/{name}/_manifest/{number:010d}.json")
        stream = path.getFileSystem(self._conf).open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, name: str, manifest: dict) -> bool:
        """Make ``manifest`` the newest; False when its number is taken."""
        folder = f"{self.root}/{name}/_manifest"
        target = self._path(f"{folder}/{manifest['number']:010d}.json")
        draft = self._path(f"{folder}/draft-{uuid.uuid4().hex}")
        fs = draft.getFileSystem(self._conf)
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        try:
            if fs.getScheme() == "file":
                files, paths = self._jvm.java.nio.file.Files, self._jvm.java.nio.file.Paths
                files.createLink(*(paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(
                    self._jvm.java.lang.String, 0)) for p in (target, draft)))
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
                none = self.spark.sparkContext._gateway.new_array(
                    getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                context.rename(fs.makeQualified(draft), fs.makeQualified(target), none)
        except Exception:  # the Java error differs by file system; the file that is there tells
            if not fs.exists(target):
                raise
            return False
        return True

    def _write(self, name: str, change: Callable[[dict | None], dict | None]) -> dict | None:
        """Commit ``change(manifest)`` = {"parts": {part: entry or None}, ...other fields}, until nobody was faster."""
        for _ in range(ATTEMPTS):
            read = self.manifest(name)
            new = change(read)
            if new is None:
                return read
            base = read
            while True:
                parts = {**(base["parts"] if base else {}), **new["parts"]}
                manifest = {**(base or {}), **new, "parts": {p: e for p, e in parts.items() if e is not None},
                            "number": (base["number"] if base else 0) + 1}
                if self._commit(name, manifest):
                    return manifest
                base = self.manifest(name)
                same = read is not None and base["schema"] == read["schema"] == new.get("schema", read["schema"])
                if not same or base.get("epochs") != read.get("epochs") or any(
                        base["parts"].get(p) != read["parts"].get(p) for p in new["parts"]):
                    break  # its parts have changed: compute anew
        raise RuntimeError(f"table {name!r}: {ATTEMPTS} writes were overtaken by others")

    # --- parts ----------------------------------------------------------------------------------

    def _part(self, key: list[str], layout: dict) -> Column:
        if layout.get("width"):
            return F.floor(F.col(key[0]) / F.lit(layout["width"])).cast("long")
        return F.pmod(F.xxhash64(*key), F.lit(layout["buckets"])).cast("long")

    def _load(self, manifest: dict, parts=None, columns: list[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f for p, e in sorted(manifest["parts"].items()) if parts is None or p in parts for f in e["files"]]
        df = (self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema))
        return df.select(*columns) if columns else df

    def _store(self, df: DataFrame, name: str, tracked: list[str]) -> dict[str, dict]:
        """Write rows with ``_PART`` as one new folder; the entries of its parts."""
        path = f"{self.root}/{name}/data/{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        df.repartition(_PART).write.partitionBy(_PART).parquet(path)
        stats = self.spark.read.schema(df.schema).parquet(path).groupBy(_PART).agg(
            F.count(F.lit(1)).alias("rows"), *[F.max(c).cast("string").alias(f"m{i}") for i, c in enumerate(tracked)])
        return {str(r[_PART]): {"files": [f"{path}/{_PART}={r[_PART]}"], "rows": r["rows"],
                                "max": {c: r[f"m{i}"] for i, c in enumerate(tracked)}}
                for r in stats.collect()}  # one row per part

    def read(self, name: str) -> DataFrame | None:
        manifest = self.manifest(name)
        return None if manifest is None else self._load(manifest)

    # --- checked batches ------------------------------------------------------------------------

    def _batch(self, batch: DataFrame, key: list[str], layout: dict, schema: T.StructType | None):
        """The batch with its parts, written once, and the parts it touches."""
        if schema is not None:
            kinds = {f.name: f.dataType for f in schema.fields}
            batch = batch.withColumns({k: F.col(k).cast(kinds[k]) for k in key})
        batch = K.with_known_key(batch, key).withColumn(_PART, self._part(key, layout)).checkpoint()
        per_part = batch.groupBy(*key, _PART).count().groupBy(_PART).agg(F.max("count").alias("n")).collect()
        if any(r["n"] > 1 for r in per_part):
            raise ValueError(f"a batch holds several rows of one key {key}")
        return batch, [str(r[_PART]) for r in per_part]

    def _layout(self, manifest: dict | None, width: int | None) -> dict:
        return manifest["layout"] if manifest else {"buckets": self.buckets, "width": width}

    # --- K07 / K08 / K04 ------------------------------------------------------------------------

    def upsert(self, batch: DataFrame, name: str, key: list[str], update_cols: list[str] | None = None,
               newer: str | None = None, width: int | None = None, tracked: list[str] | None = None,
               epoch: tuple[str, int] | None = None) -> dict | None:
        """Batch rows replace stored rows of their key; only the batch's parts are rewritten.

        ``newer``: a stored row with a greater value of this column stays.  ``tracked``: columns whose
        greatest value the manifest keeps.  ``epoch`` (stream, number): a number not above the recorded
        one was written before and is skipped.  A batch with other columns than the table changes
        the table's columns as K05 does; a column of another type rewrites the whole table."""
        def change(m: dict | None) -> dict | None:
            if epoch and m and m.get("epochs", {}).get(epoch[0], -1) >= epoch[1]:
                return None
            schema = T.StructType.fromJson(m["schema"]) if m else None
            layout = self._layout(m, width)
            rows, parts = self._batch(batch, key, layout, schema)
            keep = sorted(set((m or {}).get("tracked", []) + (tracked or [])))
            clean = rows.drop(_PART)
            new = {"schema": clean.schema.jsonValue() if m is None or update_cols is None else m["schema"],
                   "key": key, "layout": layout, "tracked": keep}
            if epoch:
                new["epochs"] = {**(m or {}).get("epochs", {}), epoch[0]: epoch[1]}
            if m is None:
                return {**new, "parts": self._store(rows, name, keep)}
            kinds = {f.name: f.dataType for f in schema.fields}
            if any(kinds.get(f.name, f.dataType) != f.dataType for f in clean.schema.fields) and update_cols is None:
                parts = list(m["parts"])
            old = self._load(m, parts)
            if newer:
                seen = old.select(*key, F.col(newer).alias("_mm_seen"))
                clean = (clean.join(seen, key, "left")
                         .where(F.col("_mm_seen").isNull() | (F.col(newer) >= F.col("_mm_seen"))).drop("_mm_seen"))
            if update_cols is None:
                merged = K.keyed_upsert(K.sync_all_columns(old, clean), clean, key)
            else:
                merged = K.keyed_upsert(old, clean, key, update_cols)
            written = self._store(merged.withColumn(_PART, self._part(key, layout)), name, keep)
            return {**new, "parts": {p: written.get(p) for p in {*parts, *written}}}

        return self._write(name, change)

    def insert_if_absent(self, batch: DataFrame, name: str, key: list[str], width: int | None = None) -> dict | None:
        """Rows of unknown keys are added as further folders of their parts; nothing is rewritten."""
        def change(m: dict | None) -> dict | None:
            schema = T.StructType.fromJson(m["schema"]) if m else None
            layout = self._layout(m, width)
            rows, parts = self._batch(batch, key, layout, schema)
            if m is None:
                return {"schema": rows.drop(_PART).schema.jsonValue(), "key": key, "layout": layout, "tracked": [],
                        "parts": self._store(rows, name, [])}
            fresh = rows.join(self._load(m, parts, key), key, "left_anti").select(*schema.names, _PART)
            return self._appended(m, self._store(fresh, name, m["tracked"]))

        return self._write(name, change)

    @staticmethod
    def _appended(m: dict, written: dict[str, dict]) -> dict | None:
        """The parts of ``m`` with further folders; None when there are none."""
        out = {}
        for p, e in written.items():
            old = m["parts"].get(p, {"files": [], "rows": 0, "max": {}})
            out[p] = {"files": old["files"] + e["files"], "rows": old["rows"] + e["rows"],
                      "max": {c: max([x for x in (old["max"].get(c), v) if x is not None], default=None)
                              for c, v in e["max"].items()}}
        return {"parts": out} if out else None

    def watermark(self, name: str, column: str):
        """The greatest stored value of a tracked column, from the manifest."""
        m = self.manifest(name)
        kind = T.StructType.fromJson(m["schema"])[column].dataType
        values = [e["max"][column] for e in m["parts"].values() if e["max"].get(column) is not None]
        if not values:
            return None
        # at most one text per part, compared in the column's own type
        return self.spark.createDataFrame([(v,) for v in values], "v string").agg(
            F.max(F.col("v").cast(kind))).first()[0]

    def merge_incremental(self, src: DataFrame, name: str, key: list[str], watermark: str,
                          lookback: str | None = None, width: int | None = None) -> dict | None:
        """Rows of ``src`` past the stored watermark replace the rows of their keys.

        The watermark comes from the manifest, so neither it nor the merge reads parts the batch does not touch."""
        if self.manifest(name) is not None:
            known = self.watermark(name, watermark)
            if known is not None:
                bound = F.lit(known.isoformat(sep=" ") if hasattr(known, "isoformat") else known).cast(
                    src.schema[watermark].dataType)
                src = src.where(F.col(watermark) > (bound - F.expr(f"INTERVAL {lookback}") if lookback else bound))
        return self.upsert(src, name, key, width=width, tracked=[watermark])

    # --- K06 ------------------------------------------------------------------------------------

    def snapshot(self, src: DataFrame, name: str, key: str, updated_at: str, run_ts,
                 invalidate_hard_deletes: bool = True) -> dict | None:
        """Type-2 history by timestamp.

        Open and closed rows of a bucket are two parts (2 b and 2 b + 1).  One join of the open rows' keys and
        times with the source finds what changed; open parts with a change are rewritten, rows that
        close are added to the closed part, and nothing else is read or written."""
        run = C.ts_lit(run_ts)
        source = K.with_known_key(src, [key])
        updated = F.col(updated_at).cast("timestamp_ntz")

        def bucket(layout: dict) -> Column:
            return F.pmod(F.xxhash64(F.col(key)), F.lit(layout["buckets"])).cast("long")

        def fresh(df: DataFrame) -> DataFrame:
            return df.select(*src.columns, C.surrogate_key(key, updated_at).alias("dbt_scd_id"),
                             updated.alias("dbt_updated_at"), updated.alias("dbt_valid_from"),
                             F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"))

        def change(m: dict | None) -> dict | None:
            layout = m["layout"] if m else {"buckets": self.buckets, "width": None}
            if m is None:
                rows = fresh(source)
                self._batch(rows, [key], layout, None)
                return {"schema": rows.schema.jsonValue(), "key": [key], "layout": layout, "tracked": [],
                        "parts": self._store(rows.withColumn(_PART, bucket(layout) * 2), name, [])}
            is_open = {p for p in m["parts"] if int(p) % 2 == 0}
            stored = self._load(m, is_open, [key, "dbt_updated_at"]).withColumnRenamed("dbt_updated_at", "_mm_old")
            given = source.select(key, updated.alias("_mm_new"))
            kind = (F.when(F.col("_mm_old").isNull(), "new").when(F.col("_mm_new").isNull(), "gone")
                    .when(F.col("_mm_new") > F.col("_mm_old"), "changed"))
            diff = (stored.join(given, key, "full_outer").withColumn("_mm_kind", kind)
                    .where(F.col("_mm_kind").isNotNull() & (F.lit(invalidate_hard_deletes) | (F.col("_mm_kind") != "gone")))
                    .select(key, "_mm_new", "_mm_kind", bucket(layout).alias("_mm_b")).checkpoint())
            touched = [r["_mm_b"] for r in diff.select("_mm_b").distinct().collect()]  # at most the buckets
            if not touched:
                return None
            parts = {str(2 * b) for b in touched}
            held = self._load(m, parts).join(diff.drop("_mm_b"), key, "left")
            closing = F.col("_mm_kind").isNotNull()
            columns = [f.name for f in T.StructType.fromJson(m["schema"]).fields]
            end = F.when(closing, F.coalesce(F.col("_mm_new"), run))
            old = held.withColumn("dbt_valid_to", end).select(
                *columns, (bucket(layout) * 2 + closing.cast("long")).alias(_PART))
            added = fresh(source.join(diff.where("_mm_kind <> 'gone'").select(key), key, "left_semi")).select(
                *columns, (bucket(layout) * 2).alias(_PART))
            written = self._store(old.unionByName(added), name, [])
            closed = self._appended(m, {p: e for p, e in written.items() if int(p) % 2}) or {"parts": {}}
            return {"parts": {**closed["parts"], **{p: written.get(p) for p in parts}}}

        return self._write(name, change)
