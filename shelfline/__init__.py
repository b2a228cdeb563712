"""shelfline: a Spark-native retail analytics engine.

Layers: ``sources`` (raw tables) -> ``plans`` (staging, dims, facts, marts,
metrics, reports, forecast) built from ``operators`` (ranking, SCD2,
inventory balances, quality checks, incremental writes) and ``functions``
(column expressions).  ``streaming`` holds the micro-batch variants.
"""

from .params import DEFAULT, Params

__all__ = ["Params", "DEFAULT"]
