"""citylake: a Spark-native trip analytics warehouse.

Layers: ``sources`` (scans + fixtures) -> ``plans.silver`` (cleaned trips, weather,
zones) -> ``plans.dims`` / ``plans.facts`` (star schema) -> ``plans.reports``.
``operators`` holds the reusable DataFrame operators (latest-per-key, size-checked
lookup joins, profiles, quality checks); ``functions`` the column expressions;
``sinks`` the table writes; ``streaming`` the file-triggered incremental load.
"""

from citylake.config import Rules

__all__ = ["Rules"]
