"""panelsight — Spark-native analytics over employee x quarter review panels.

Subpackages
-----------
sources    readers/writers: panel built from the warehouse tables, CSV/parquet
           round trips, report sinks, fitted-model store
functions  scalar column expressions (KPI roll-up, band, quarter keys, tiers)
operators  DataFrame operators: cleaning, preparation, insights, decisions,
           fairness, metrics, models, explanation, scoring
plans      end-to-end compositions (full pipeline, batch scoring)
streaming  the same stateless scoring plan applied to a file stream
"""

from panelsight.session import get_spark, work_dir  # noqa: F401

__all__ = ["get_spark", "work_dir"]
