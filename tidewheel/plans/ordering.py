"""Successor and rank of rows in key order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .storage import materialize


def positions(rows: DataFrame, *keys: str) -> DataFrame:
    """rows with ``pos``: 0, 1, 2, ... in ascending order of keys, nulls first.

    Rows are range-partitioned and numbered inside their range; the window without a key
    sees one row a range. The numbered rows are written once, so a task that runs again
    reads the same numbers.
    """
    numbered = rows.repartitionByRange(*(F.col(k).asc_nulls_first() for k in keys)).sortWithinPartitions(*(F.col(k).asc_nulls_first() for k in keys))
    numbered = materialize(numbered.withColumn("__at", F.monotonically_increasing_id()), "positions")
    part, within = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return numbered.withColumn("__part", part).join(before, "__part").select(*rows.columns, (F.col("__before") + within).alias("pos"))


def merge_by_position(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], how: str = "outer") -> DataFrame:
    """The i-th row of left beside the i-th row of right, in the order of their keys; column names must differ. ``pos`` counts from 0."""
    return positions(left, *left_keys).join(positions(right, *right_keys), "pos", how)
