"""A9 over a table: pool token vectors stored one row per token.

``df`` holds one vector per row with a group key and an order column
(token position); the result is one pooled vector per group.  Mean and
max are per-dimension aggregates with partial (map-side) combine, cls is
the lowest-order row's vector; a group's rows are never collected
together, only its pooled vector (bounded by the dimension) is assembled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skulink.functions.vectors import check_pooling
from skulink.operators.lookup import first_by_key


def pool_groups(df: DataFrame, key: str, order: str, vec: str, strategy: str = "mean",
                out: str = "pooled") -> DataFrame:
    """``key, out`` with ``out`` the pooled ``array<double>`` of each group."""
    check_pooling(strategy)
    if strategy == "cls":
        first = first_by_key(df, key, order, vec)
        return first.select(key, F.transform(vec, lambda x: x.cast("double")).alias(out))
    x = df.select(key, F.posexplode(vec).alias("dim", "value"))
    v = F.col("value").cast("double")
    per_dim = x.groupBy(key, "dim").agg((F.avg(v) if strategy == "mean" else F.max(v)).alias("value"))
    return (per_dim.groupBy(key)
            .agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("_dv"))
            .select(key, F.transform("_dv", lambda s: s["value"]).alias(out)))
