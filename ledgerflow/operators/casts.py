"""ANSI-safe casts: a value that does not convert becomes NULL, the batch goes on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType

from ledgerflow.spec import TableSpec


def safe_date(c: Column) -> Column:
    return c.try_cast(DateType())


def safe_casts(df: DataFrame, casts: dict[str, DataType]) -> DataFrame:
    """``try_cast`` every listed column in one projection (decimals round half-up)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})


def silver_cast(df: DataFrame, spec: TableSpec) -> DataFrame:
    return safe_casts(df, spec.cast_map)
