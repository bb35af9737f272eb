"""ST1: the incremental model as a Structured Streaming job.

New prediction files landing in a folder are picked up with
``readStream.parquet`` and ``trigger(availableNow=True)`` (process everything
present, then stop -- the daily batch of the reference, but restartable from
the checkpoint).  Each micro-batch is merged into a manifest table
(``operators.manifest``) and reads and rewrites only the parts its keys are in: of
all rows of a key, stored or delivered, the one with the newest event time
stays, so late rows are added, corrections replace, and an older row never
overwrites a newer one.  The manifest records the last epoch of the stream in the
same commit as its rows, so a batch that is replayed after a stop is not written
twice.  The stream's offsets and the table both live under the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sinks as K
from ..operators.manifest import ManifestStore


def run_incremental_stream(spark: SparkSession, source_dir: str, schema, store: ManifestStore,
                           table: str, key: list[str], event_time: str,
                           checkpoint: str) -> None:
    """Merge every file under ``source_dir`` into ``table`` and stop."""
    stream = spark.readStream.schema(schema).parquet(source_dir)

    def merge(batch: DataFrame, epoch_id: int) -> None:
        latest = K.dedupe_latest(batch, key, [F.col(event_time).desc()])
        store.upsert(latest, table, key, newer=event_time, epoch=(checkpoint, epoch_id))

    q = (stream.writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
