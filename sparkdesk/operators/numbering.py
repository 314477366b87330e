"""Dense row numbers in a global order, without one task that sees all rows.

Rows are dealt by range of the order columns and sorted within each range.  A row's number is
its place in its range plus the rows of all ranges before it; the ranges' counts are a table
of one row a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkdesk.session import write_scratch

#: A row's number within its partition is in the lower bits of monotonically_increasing_id.
PARTITION_BITS = 33


def dense_numbers(df: DataFrame, order: Sequence[str], out: str = "row_number", start: int = 0) -> DataFrame:
    """Adds ``out``: ``start`` for the first row in ``order`` (NULLs first), then one more for each row.

    Equal order values are numbered in any order.  The sorted rows are written once, so a
    retried task cannot number them differently.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    rows = write_scratch(placed, "numbered")
    part = F.shiftright("__place", PARTITION_BITS)
    counts = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a partition of the write above, whatever the table's size
    offsets = F.broadcast(counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")))
    local = F.col("__place").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1))
    return (rows.join(offsets, part == F.col("__part")).withColumn(out, F.lit(start) + F.col("__before") + local)
            .drop("__place", "__part", "__before"))
