"""Data overview: nulls, duplicates, ranges, summaries, histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.plans import quantiles

from .core import metric_table


def null_report(df: DataFrame) -> DataFrame:
    """(column, nulls, percentage) of every column, from one pass."""
    one = df.agg(F.count(F.lit(1)).alias("__n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return one.unpivot(["__n"], df.columns, "column", "nulls").select("column", "nulls", F.try_divide(F.col("nulls") * F.lit(100.0), F.col("__n")).alias("percentage"))


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows, extra copies, and rows that have a copy."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    z = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return g.agg(z(F.col("__n")).alias("row_count"), z(F.col("__n") - 1).alias("extra_copies"), z(F.when(F.col("__n") > 1, F.col("__n")).otherwise(0)).alias("rows_with_copy"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, std, min, q1, median, q3, max), exact."""
    long = df.select(*(F.col(c).cast("double") for c in columns)).unpivot([], columns, "column", "v")
    g = long.groupBy("column").agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    q = quantiles.ranked(long, "v", "column").groupBy("column").agg(F.min("v").alias("min"), F.max("v").alias("max"), *(quantiles.quantile(p).alias(n) for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))))
    return g.join(q, "column", "left").select("column", "count", "mean", "std", "min", "q1", "median", "q3", "max")


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(metric, value): rows that break each rule."""
    return metric_table(df.agg(*(F.count_if(c).alias(k) for k, c in rules.items())))


def trip_rules() -> dict[str, Column]:
    rules = {"negative_duration": F.col("end_time_ms") < F.col("start_time_ms")}
    for p in ("start", "end"):
        rules[f"{p}_latitude"] = ~F.col(f"{p}_station_latitude").between(44, 46)
        rules[f"{p}_longitude"] = ~F.col(f"{p}_station_longitude").between(-75, -72)
    return rules


def median_fill(df: DataFrame, column: str) -> DataFrame:
    m = quantiles.ranked(df, column).agg(quantiles.quantile(0.5).alias("__m"))
    return df.crossJoin(F.broadcast(m)).withColumn(column, F.coalesce(F.col(column).cast("double"), "__m")).drop("__m")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, lo, n) of equal widths from smallest to largest; the last bin holds the largest value. Empty bins have 0."""
    v = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    edge = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo IS NOT NULL")
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    at = F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), width)), F.lit(0))).cast("long")
    n = v.crossJoin(F.broadcast(edge)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = edge.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1)).cast("array<long>")).alias("bin"), "lo", width.alias("w"))
    return grid.join(n, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("lo"), F.coalesce("n", F.lit(0)).alias("n"))


def box(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, and whiskers at the last values within 1.5 interquartile ranges."""
    r = quantiles.ranked(df.select(F.col(column).cast("double").alias("x")), "x")
    q = r.agg(*(quantiles.quantile(p).alias(n) for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("v") >= F.col("q1") - reach) & (F.col("v") <= F.col("q3") + reach)
    return r.crossJoin(F.broadcast(q)).groupBy("q1", "median", "q3").agg(F.min(F.when(inside, F.col("v"))).alias("low"), F.max(F.when(inside, F.col("v"))).alias("high"), quantiles.rows_where(~inside).alias("outliers"))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct().agg(F.count(F.lit(1)).alias("n"))


def distinct_tuples(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count_distinct(F.struct(*columns)).alias("n"))


def same_columns(frames: list[DataFrame]) -> bool:
    return reduce(lambda a, b: a and b, (f.columns == frames[0].columns for f in frames), True)
