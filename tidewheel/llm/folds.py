"""Hold-out folds by document id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(0))
