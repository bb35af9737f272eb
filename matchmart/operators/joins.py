"""Joins of a fact to a table that is an aggregate or a dimension of it.

The planner cannot know how small such a table is, so it shuffles the fact on a few
keys (leagues, teams, pairs).  Here the table is written first and measured.  Up to
``spark.matchmart.lookupBytes`` (default 64 MB) it is broadcast and the fact stays
where it is.  A larger table is joined by its key, and the few keys that hold more
than ``spark.matchmart.hotKeyRows`` fact rows are salted: the fact's rows of such a key
are dealt to ``SALTS`` parts, and the table's row of it is there in each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windows import _hot_limit, hot_keys

LOOKUP_BYTES = 64 * 1024 * 1024
SALTS = 64
_SALT = "_mm_salt"


class Lookup:
    """A written table (in the shared checkpoint folder) with its rows and bytes."""

    def __init__(self, table: DataFrame):
        self.table = table.checkpoint()
        texts = [f.name for f in table.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
        # A row in memory: eight bytes a field, and texts in steps of eight.
        size = sum((F.coalesce(F.octet_length(c), F.lit(0)) + 7 for c in texts), F.lit(16 + 8 * len(table.schema.fields)))
        r = self.table.agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes")).first()
        self.rows, self.bytes = r["rows"], int(r["bytes"] or 0)

    def join(self, fact: DataFrame, keys: dict[str, str], columns: dict[str, str], spread: str,
             limit: int | None = None, hot_key_rows: int | None = None) -> DataFrame:
        """``fact`` with ``columns`` (new name -> table column) of the table row whose ``keys`` (fact column ->
        table column, unique in the table) are equal, null where there is none.

        ``spread`` is the fact column by which the rows of a hot key are dealt."""
        conf = fact.sparkSession.conf
        limit = limit if limit is not None else int(conf.get("spark.matchmart.lookupBytes", str(LOOKUP_BYTES)))
        on = [f"_mm_k{i}" for i in range(len(keys))]
        small = self.table.select(*[F.col(t).alias(k) for k, t in zip(on, keys.values())],
                                  *[F.col(t).alias(new) for new, t in columns.items()])
        fact = fact.withColumns({k: F.col(c) for k, c in zip(on, keys)})
        if self.bytes <= limit:
            return fact.join(F.broadcast(small), on, "left").drop(*on)
        hot = hot_keys(fact, on, _hot_limit(fact, hot_key_rows))
        if hot is None:
            return fact.join(small, on, "left").drop(*on)
        # At most rows / hotKeyRows keys.
        hot = F.broadcast(hot.withColumn("_mm_hot", F.lit(True)))
        salt = F.when(F.col("_mm_hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
        salts = F.when(F.col("_mm_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        dealt = fact.join(hot, on, "left").withColumn(_SALT, salt).drop("_mm_hot")
        copies = small.join(hot, on, "left").withColumn(_SALT, F.explode(salts)).drop("_mm_hot")
        return dealt.join(copies, [*on, _SALT], "left").drop(*on, _SALT)
