"""Reporting building blocks of the sample workload, written skew-aware:

* first/last row per key (W1) is an arg-min / arg-max aggregate, so each key is pre-reduced
  on the map side and a key that holds a third of all rows never lands in one sort;
* broadcast is used only for dimensions whose size is bounded by the schema (nation: 25
  rows, region: 5 rows); every other join is left to Spark's size-checked planning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_last_per_key(df: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """(key, first_<c>, last_<c>) for the row with the smallest / largest ``order``
    (ties broken by the later order columns, which should end with a unique column)."""
    s = F.struct(*order, *[c for c in cols if c not in order])
    agg = df.groupBy(key).agg(F.min(s).alias("_f"), F.max(s).alias("_l"))
    return agg.select(key, *[F.col(f"_f.{c}").alias(f"first_{c}") for c in cols],
                      *[F.col(f"_l.{c}").alias(f"last_{c}") for c in cols])


def money(c: Column | str) -> Column:
    """Exact cents: sums of decimals do not depend on the order the partial sums arrive in."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,2)")


def total(c: Column) -> Column:
    """Exact sum of money, shown as double."""
    return F.sum(c).cast("double")
