"""Exact quantiles without a task that holds all values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import materialize


def ranked(df: DataFrame, value: str, *by: str, nulls: bool = False) -> DataFrame:
    """(*by, v, n, before, total): each distinct value, its rows, the rows of lesser values and all rows, null values left out
    (with ``nulls`` they are a row of v null, which no rank counts); a null in ``by`` is a key like any other.

    Equal values are counted before they move. Distinct values are sorted by range; a window sees
    the values of one range, another one row a range. The ranked values are written once, so
    whatever is read from them scans df no second time.
    """
    keys = list(by)
    values = df.select(*keys, F.col(value).alias("v"))
    counts = (values if nulls else values.where("v IS NOT NULL")).groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))
    dealt = materialize(counts.repartitionByRange(*keys, "v").withColumn("part", F.spark_partition_id()), "value-counts")
    held = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)
    inside = dealt.withColumn("within", F.sum(held).over(Window.partitionBy(*keys, "part").orderBy("v")) - held)
    sums = dealt.groupBy(*keys, "part").agg(F.sum(held).alias("m"))
    every = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    sums = sums.select(*keys, "part", (F.sum("m").over(every.orderBy("part")) - F.col("m")).alias("offset"), F.sum("m").over(every).alias("total"))
    sums = sums.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("part").alias("__part"), "offset", "total")
    same = F.col("part") == F.col("__part")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    return inside.join(sums, same).select(*keys, "v", "n", (F.col("offset") + F.col("within")).alias("before"), "total")


def quantile(p: float) -> Column:
    """An aggregate over ``ranked`` rows: the linearly interpolated quantile."""
    at = F.col("total").cast("double") - 1
    at = at * F.lit(float(p))
    value = lambda rank: F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), F.col("v").cast("double")))
    low, high, share = value(F.floor(at)), value(F.ceil(at)), F.max(at - F.floor(at))
    return F.when(share == 0, low).otherwise((1 - share) * low + share * high)


def rows() -> Column:
    return F.coalesce(F.sum("n"), F.lit(0)).cast("long")


def rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")


def mean() -> Column:
    return F.try_divide(F.sum(F.col("v").cast("double") * F.col("n")), F.sum(F.when(F.col("v").isNotNull(), F.col("n"))))
