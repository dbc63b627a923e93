"""Small operators that the domain modules are built from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows; order must end in columns that make it total."""
    return df.orderBy(*order).limit(n)


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def tail(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*(F.col(c).desc_nulls_last() for c in order)).limit(n)


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key: the first by order."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def first_in_input(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row a key: the first as df is read (file order for a file scan; a frame without an order of its own has any)."""
    at = df.withColumn("__at", F.monotonically_increasing_id())
    rest = [c for c in df.columns if c not in keys]
    first = at.groupBy(*keys).agg(F.min_by(F.struct(*(F.col(c) for c in rest)), "__at").alias("__row")) if rest else df.distinct()
    return first.select(*keys, *(F.col(f"__row.{c}") for c in rest)).select(*df.columns) if rest else first


def full_outer(left: DataFrame, right: DataFrame, keys: list[str], fill: int = 0) -> DataFrame:
    """Full outer equi join on one or more keys; what a side lacks is ``fill``."""
    out = left.join(right, keys, "full")
    return out.withColumns({c: F.coalesce(c, F.lit(fill)) for c in out.columns if c not in keys})


def share_of_total(df: DataFrame, count: str, alias: str = "percentage") -> DataFrame:
    """df, small, with each row's percentage of the column's sum."""
    total = df.agg(F.sum(count).alias("__total"))
    return df.crossJoin(F.broadcast(total)).withColumn(alias, F.try_divide(F.col(count) * F.lit(100.0), F.col("__total"))).drop("__total")


def metric_table(row: DataFrame) -> DataFrame:
    """(metric, value double) from a frame of one row."""
    cast = row.select(*(F.col(c).cast("double") for c in row.columns))
    return cast.unpivot([], cast.columns, "metric", "value")


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def concat(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def pivot_counts(df: DataFrame, row: str, column: str, values: list, count: str = "n", prefix: str = "c") -> DataFrame:
    """One column a value, filled with 0: conditional sums in one pass."""
    return df.groupBy(row).agg(*(F.coalesce(F.sum(F.when(F.col(column) == v, F.col(count))), F.lit(0)).cast("long").alias(f"{prefix}{v}") for v in values))


def densify_hours(df: DataFrame, key: str, hour: str, value: str) -> DataFrame:
    """Every hour from a key's first to its last, with 0 where it has no row."""
    span = df.groupBy(key).agg(F.min(hour).alias("lo"), F.max(hour).alias("hi"))
    grid = span.select(key, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias(hour))
    return grid.join(df, [key, hour], "left").withColumn(value, F.coalesce(value, F.lit(0)).cast("long"))
