"""Table contract and layout on write: conform, key checks, clustered and partitioned writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.session import SHUFFLE_CLEANUP, settings

#: rows repeat long texts (paths, rescued data) beyond a dictionary's size; zstd finds them again
CODEC = "zstd"


def conform(df: DataFrame, schema: StructType, not_null: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Select the contract's columns in order with their types (``try_cast``), and fail the
    job on a NULL in a NOT NULL column (the check runs inside the same projection)."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c if (f.name in df.columns and df.schema[f.name].dataType == f.dataType) else c.try_cast(f.dataType)
        if f.name in not_null:
            c = F.when(
                c.isNull(), F.raise_error(F.lit(f"NOT NULL constraint violated: {f.name}"))
            ).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Primary-key check: keys with more than one row (empty when the key is unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def clustered(df: DataFrame, cols, partitions: int | None = None, spread=()) -> DataFrame:
    """Range-partition and sort by the clustering columns so parquet row-group min/max
    statistics skip data for filters on them (the layout a CLUSTER BY table keeps).

    ``spread`` columns (a key) extend the range key, so rows of one hot clustering value fall
    into several partitions. Without ``partitions`` Spark merges small ones by their size."""
    order = [*cols, *(c for c in spread if c not in cols)]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def write_clustered(df: DataFrame, path: str, cols, partitions: int | None = None, mode: str = "overwrite", spread=()) -> None:
    with settings(df.sparkSession, {SHUFFLE_CLEANUP: "true"}):
        clustered(df, cols, partitions, spread).write.mode(mode).option("compression", CODEC).parquet(path)


def write_quarantine(q: DataFrame, path: str) -> None:
    """One folder per batch (overwrite → replay-safe), Hive-partitioned by rejection month."""
    q.write.mode("overwrite").partitionBy("rejected_at_month").parquet(path)
