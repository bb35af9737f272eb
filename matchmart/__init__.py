"""matchmart: football match data as Spark DataFrame jobs.

Subpackages: ``sources`` (scans, adapters, payloads), ``functions`` (Column
helpers), ``operators`` (windows, as-of join, quality checks, sinks), ``plans``
(staging / intermediate / mart models and the query registry), ``ml`` (goal
model, boosting, blending, metrics) and ``streaming`` (incremental merge).
"""

__version__ = "0.1.0"
