"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 32 << 20


def sized_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its contents have at most ``max_bytes``.

    For joins on low-cardinality keys (nation, (feature, band), ...): a
    shuffle join would put all rows of one key value in one task, so the
    small side is broadcast -- but only after its bytes are summed (one cheap
    aggregate of the small side); beyond the bound the planner's own choice
    (sort-merge join with AQE skew handling) is kept.
    """
    size = df.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
