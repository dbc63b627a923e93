"""Distances and coordinate keys as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KM, METRES = 6371.0, 6371000.0


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return F.least(F.lit(1.0), a * a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b * b)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.lit(2 * KM) * F.asin(F.sqrt(_half_chord(lat1, lon1, lat2, lon2)))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    h = _half_chord(lat1, lon1, lat2, lon2)
    return F.lit(2 * METRES) * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def degree_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.sqrt(F.pow(lat2 - lat1, F.lit(2.0)) + F.pow(lon2 - lon1, F.lit(2.0)))


def coord(value: Column) -> Column:
    return F.round(value.cast("double"), 6)


def coord_key(lat: Column, lon: Column) -> Column:
    return F.format_string("%.6f,%.6f", coord(lat), coord(lon))


def split_key(key: Column) -> tuple[Column, Column]:
    parts = F.split(key, ",")
    return parts[0].cast("double"), parts[1].cast("double")
