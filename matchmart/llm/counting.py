"""Fixed-length count vectors over a whole table, without a driver collect of rows.

Each task counts into one vector of fixed length, cuts it into segments, and a
short tree of group-bys adds the segments up: 64 tasks, then 128 groups of
tasks, then the rest.  Only the finished vector, whose length does not depend on
the data, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SEGMENT = 1 << 14
_SCHEMA = "part long, segment int, counts binary"


def total_counts(rows: DataFrame, size: int, count: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """The sum over all rows of what ``count(batch, vector)`` adds to an int64 vector of ``size``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(size, np.int64)
        for batch in batches:
            count(batch, vector)
        if vector.any():
            parts = [vector[a:a + _SEGMENT] for a in range(0, size, _SEGMENT)]
            some = [i for i, x in enumerate(parts) if x.any()]
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(some), pa.int64()), pa.array(some, pa.int32()),
                 pa.array([parts[i].tobytes() for i in some], pa.binary())], names=["part", "segment", "counts"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(group["counts"].iloc[0], np.int64).copy()
        for other in group["counts"].iloc[1:]:
            total += np.frombuffer(other, np.int64)
        return pd.DataFrame({"part": group["part"].iloc[:1], "segment": group["segment"].iloc[:1],
                             "counts": [total.tobytes()]})

    summed = rows.mapInArrow(run, _SCHEMA)
    for fan_in in (64, 128, 1 << 40):
        summed = (summed.withColumn("part", F.floor(F.col("part") / fan_in).cast("long"))
                  .groupBy("segment", "part").applyInPandas(add, _SCHEMA))
    out = np.zeros(size, np.int64)
    for row in summed.select("segment", "counts").toLocalIterator():
        values = np.frombuffer(row["counts"], np.int64)
        out[row["segment"] * _SEGMENT:row["segment"] * _SEGMENT + len(values)] = values
    return out
