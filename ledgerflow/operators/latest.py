"""Latest row per key (SCD type 1 winner).

``row_number() = 1`` over ``(keys)`` ordered by the sequence descending. Spark
plans this as a partial ``WindowGroupLimit`` *before* the shuffle, so a hot key
ships at most one row per map partition: a key holding a third of all rows costs
no more shuffle than any other. The aggregate form (``max_by`` over a struct) is
kept as an alternative; it also reduces map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RN = "_rn"


def latest_per_key(df: DataFrame, keys: list[str] | tuple, sequence_by: list[str] | tuple) -> DataFrame:
    """One row per key: the greatest ``sequence_by`` (lexicographic, NULL lowest)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in sequence_by])
    return df.withColumn(RN, F.row_number().over(w)).where(F.col(RN) == 1).drop(RN)


def latest_by_max(df: DataFrame, keys: list[str] | tuple, sequence_by: list[str] | tuple) -> DataFrame:
    """Aggregate form: ``max_by(struct(row), struct(sequence))`` per key."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*sequence_by)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])
