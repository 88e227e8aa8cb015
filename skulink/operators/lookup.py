"""Keyed lookups: first row per key (J2, J3) and full-row exclusion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, keys, order: str, values) -> DataFrame:
    """Per key, the ``values`` of the row with the lowest ``order``.

    An aggregation with partial (map-side) combine, so a key held by a
    third of all rows never travels as one group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = [values] if isinstance(values, str) else list(values)
    agg = F.min(F.struct(F.col(order).alias("_o"), *[F.col(v) for v in values])).alias("_m")
    return df.groupBy(*keys).agg(agg).select(*keys, *[F.col(f"_m.{v}").alias(v) for v in values])


def exclude_rows(pool: DataFrame, recorded: DataFrame, columns: list[str]) -> DataFrame:
    """Drop pool rows equal on every column in ``columns`` to a recorded row.

    Null-safe equality, so empty cells compare like the text ''.  The
    recorded side is de-duplicated first.
    """
    rec = recorded.select(*[F.col(c).alias(f"_r_{c}") for c in columns]).distinct()
    cond = None
    for c in columns:
        e = pool[c].eqNullSafe(rec[f"_r_{c}"])
        cond = e if cond is None else cond & e
    return pool.join(rec, cond, "left_anti")
