"""Dimension joins whose broadcast is backed by a checked size bound.

By default the choice is Spark's: a side is broadcast when the planner's
size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, or when
AQE measures it under the adaptive threshold at run time; otherwise both
sides are shuffled on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def join_dimension(fact: DataFrame, dim: DataFrame, fact_keys, dim_keys,
                   how: str = "left", bounded: bool = False) -> DataFrame:
    """``fact`` LEFT JOIN ``dim`` (facts without a member keep nulls).

    ``bounded=True`` declares a dimension whose size is fixed by
    construction (inline members); it is broadcast without a check.
    Otherwise Spark's size checks decide (see the module note).
    """
    fact_keys = [fact_keys] if isinstance(fact_keys, str) else list(fact_keys)
    dim_keys = [dim_keys] if isinstance(dim_keys, str) else list(dim_keys)
    right = F.broadcast(dim) if bounded else dim
    if fact_keys == dim_keys:
        return fact.join(right, fact_keys, how)
    cond = [fact[a] == right[b] for a, b in zip(fact_keys, dim_keys)]
    out = fact.join(right, cond, how)
    return out.drop(*[right[b] for b in dim_keys])
