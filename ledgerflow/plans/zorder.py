"""Z-order layout: a filter on any of the columns reads few files.

Each column is cut into ``2 ** BITS`` ranges of about equal row counts; the bits of the range numbers are
interleaved, and rows are range-partitioned and sorted by the number that results. Neighbours on the curve are near
in every column, so the min/max statistics of files are tight for all of them, not only for the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
SAMPLE = 10_000
Z = "_lf_z"


def range_bounds(df: DataFrame, cols, sample: int = SAMPLE, bits: int = BITS) -> dict[str, list]:
    """Upper-exclusive bounds of the ranges of each column, from ``sample`` rows drawn at random.

    Only the layout depends on the sample; a column of few values has fewer bounds. The tasks' candidates meet in a
    shuffle: a limit that is collected sends ``sample`` rows of every task to the driver.
    """
    drawn = df.select(*cols).orderBy(F.rand(7)).limit(sample)
    rows = drawn.agg(F.collect_list(F.struct(*cols)).alias("rows")).first()["rows"]
    out = {}
    for c in cols:
        values = sorted(r[c] for r in rows if r[c] is not None)
        step = len(values) / (1 << bits)
        out[c] = sorted({values[int(step * k)] for k in range(1, 1 << bits)}) if values else []
    return out


def range_number(col: Column, bounds: list, first: int = 0) -> Column:
    """How many of the sorted bounds are at most the value, by halving (NULL counts as the lowest)."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    below, above = range_number(col, bounds[:mid], first), range_number(col, bounds[mid + 1 :], first + mid + 1)
    return F.when(col >= F.lit(bounds[mid]), above).otherwise(below)


def z_value(numbers: list[Column], bits: int = BITS) -> Column:
    """The bits of the numbers in turn, from the highest on (a long)."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for k, number in enumerate(numbers):
            bit = number.cast("long").bitwiseAND(F.lit(1 << b).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * (len(numbers) - 1) + len(numbers) - 1 - k))
    return out


def zordered(df: DataFrame, cols, partitions: int | None = None, spread=(), bits: int = BITS, sample: int = SAMPLE) -> DataFrame:
    """``df`` range-partitioned and sorted along the curve; ``spread`` columns (a key) split one hot cell over partitions."""
    if bits * len(cols) > 62:
        raise ValueError("bits times columns must stay below 63")
    bounds = range_bounds(df, cols, sample, bits)
    rows = df.withColumn(Z, z_value([range_number(F.col(c), bounds[c]) for c in cols], bits))
    order = [Z, *spread]
    rows = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    return rows.sortWithinPartitions(*order).drop(Z)


def file_ranges(stored: DataFrame, cols) -> DataFrame:
    """file and (min, max) per column of each file of a stored table: what the footers' statistics allow to skip."""
    rows = stored.select(*cols, F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("file").agg(*[F.struct(F.min(c).alias("min"), F.max(c).alias("max")).alias(c) for c in cols])
