"""The held-out third of the documents, by the checksum of the doc_id's text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 3 is 1; a null doc_id counts as the empty text and is not held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1
