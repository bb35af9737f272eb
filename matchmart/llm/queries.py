"""Registry of the subpackage's queries and their DuckDB SQL."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchmart.llm import (align, clusters, decontaminate, languages, near, packing, pii, quality,
                            substrings, token_counts, toxicity, urls, warc)

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once per application.

    Spark's own file server carries the archive, so workers need neither the
    repository nor a shared folder.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="matchmart-py-"), "matchmart_py.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": token_counts.op1_token_counts,
        "op2_substring_dedup": substrings.op2_substring_dedup,
        "op3_pii": pii.op3_pii,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_best_fit_packing": packing.op5_best_fit_packing,
        "op6_language_id": languages.op6_language_id,
        "op7_url_filter": urls.op7_url_filter,
        "op8_decontamination": decontaminate.op8_decontamination,
        "op9_quality_rules": quality.op9_quality_rules,
        "op10_near_dedup": near.op10_near_dedup,
        "op11_token_alignment": align.op11_token_alignment,
        "op12_centroid_clustering": clusters.op12_centroid_clustering,
        "op13_warc": warc.op13_warc,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": substrings.OP2_SQL,
        "op9_quality_rules": quality.OP9_SQL,
        "op12_centroid_clustering": clusters.OP12_SQL,
        "op13_warc": warc.OP13_SQL,
    }
