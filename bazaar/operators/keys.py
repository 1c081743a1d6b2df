"""Surrogate key assignment (R0): the data effect of IDENTITY for new rows.

Keys are dense and deterministic: ``max(existing) + DENSE_RANK over the natural key``. The rank is
computed with the distributed global order (range buckets + offsets), not a single-partition
window, so assigning keys to a billion new rows does not funnel through one task.
``monotonically_increasing_id`` is not used: it is neither dense nor stable across recomputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.operators.windows import global_order

C = F.col


def assign_surrogate_keys(df: DataFrame, natural_key: str, id_col: str, existing: DataFrame | None = None,
                          plain: bool = False, start: int = 0) -> DataFrame:
    """Add ``id_col`` = start + dense rank of ``natural_key`` (ascending). ``start`` is the maximum
    id in ``existing`` if that is given, so new ids never collide with old ones."""
    if existing is not None:
        mx = existing.agg(F.max(id_col)).first()[0]  # one scalar
        start = int(mx or 0)
    g = global_order(df, natural_key, [], descending=False, plain=plain)
    return g.withColumn(id_col, (F.lit(start) + C("_dense")).cast("bigint")).drop("_rn", "_rank", "_dense", "_n")
