"""Array expressions that stay near linear in the length of the array."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bound(value: Column, use) -> Column:
    """use(value), with value worked out once however often it is used."""
    return F.transform(F.array(value), use)[0]


def in_blocks(items: Column) -> Column:
    """An array cut into about as many blocks as each is long.

    Arrays can only grow by being copied. Running sums are therefore made in blocks, and
    over the blocks: n items cost n times the root of n copies, not n squared.
    """
    width = F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(1)).cast("int")
    last = F.greatest(F.ceil(F.size(items) / width) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(items, k * width + 1, width))


def running(values: Column, step) -> Column:
    """For each of an array of longs the result of step over those before it, from 0."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(values, start, lambda s, x: F.struct(step(s["at"], x).cast("long").alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])
