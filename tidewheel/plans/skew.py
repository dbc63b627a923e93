"""Joins whose hot keys are dealt over all tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_KEY, _HOT, _SALT = "__dealt_key", "__dealt_hot", "__dealt_salt"


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, parts: int, key: str = "key", n: str = "n") -> DataFrame:
    """(hot) keys of ``counts`` (one row a key) that hold over 1/(4 parts) of all rows: fewer than 4 parts keys, whatever the input."""
    return counts.where(F.col(n) * (4 * parts) > counts.agg(F.sum(n)).scalar()).select(F.col(key).alias(_HOT))


def dealt_join(rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str, how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """rows joined with lookup (unique in ``lookup_key``, which is left out), however often one key comes in rows.

    Rows of a hot key get one of as many salts as a shuffle has partitions, by a hash of all
    their columns (so a task that runs again deals them alike, and only rows equal in all
    columns stay together), and the lookup's row of that key is copied for each salt. Only hot keys are broadcast: fewer than four
    times the shuffle partitions. ``counts`` (key, n) may be given where it is known. Null
    keys match nothing; how is inner or left.
    """
    parts = shuffle_parts(rows)
    if counts is None:
        counts = rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(hot_keys(counts, parts))
    dealt = rows.join(hot, F.col(key) == F.col(_HOT), "left").withColumn(_SALT, F.when(F.col(_HOT).isNull(), 0).otherwise(F.pmod(F.xxhash64(*(F.col(c) for c in rows.columns), F.lit(0)), F.lit(parts))).cast("int")).drop(_HOT)
    side = lookup.withColumnRenamed(lookup_key, _KEY).join(hot, F.col(_KEY) == F.col(_HOT), "left")
    salts = F.when(F.col(_HOT).isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(parts - 1)))
    side = side.withColumn(_SALT + "2", F.explode(salts)).drop(_HOT)
    return dealt.join(side, (F.col(key) == F.col(_KEY)) & (F.col(_SALT) == F.col(_SALT + "2")), how).drop(_KEY, _SALT, _SALT + "2")
