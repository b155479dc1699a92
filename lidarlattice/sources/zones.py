"""Grid cells in space-filling order, and stored by zones of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells along the side of a zone: 2 ** ZONE_BITS.
ZONE_BITS = 9


def _spread(v: Column) -> Column:
    """The 32 bits of a number moved to the even places."""
    v = v.cast("long")
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def morton(row: Column, col: Column) -> Column:
    """Place of a cell along the Z-shaped curve through the grid: cells near each other are mostly near on it. Rows and columns are not negative and below 2 ** 31."""
    return F.shiftleft(_spread(row), 1).bitwiseOR(_spread(col))


def zone(row: Column, col: Column) -> Column:
    """Number of the block of 2 ** ZONE_BITS by 2 ** ZONE_BITS cells, along the same curve."""
    return F.shiftright(morton(row, col), 2 * ZONE_BITS)


def in_order(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells with their zone, brought together by (keys, zone) in parts of about the advisory size, and along the curve in each.

    A zone has a bounded number of cells, and Spark splits parts that are too large and joins
    small ones, so a product of many cells is spread over tasks and files.
    """
    at = cells.withColumn("zone", zone(F.col("row"), F.col("col")))
    return at.hint("rebalance", *keys, "zone").sortWithinPartitions(*keys, morton(F.col("row"), F.col("col")))


def read_box(spark: SparkSession, path: str, row0: int, col0: int, row1: int, col1: int) -> DataFrame:
    """Cells of stored grids within rows row0 to row1 and columns col0 to col1 (inclusive): only the zones that the box touches are read."""
    side = 1 << ZONE_BITS
    corners = spark.range(row0 // side, row1 // side + 1).withColumnRenamed("id", "r").crossJoin(spark.range(col0 // side, col1 // side + 1).withColumnRenamed("id", "c"))
    zones = [r[0] for r in corners.select(morton(F.col("r"), F.col("c"))).collect()]  # as many as the box has blocks
    return spark.read.parquet(path).where(F.col("zone").isin(zones) & F.col("row").between(row0, row1) & F.col("col").between(col0, col1)).drop("zone")
