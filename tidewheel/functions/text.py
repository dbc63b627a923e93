"""Station-name cleaning, tokens and overlap as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tokens too common to block on.
COMMON_TOKENS = ["de", "du", "des", "la", "le", "les", "et", "st", "ste", "rue", "avenue", "av", "blvd", "boulevard", "chemin", "parc"]
KEPT = r"a-zA-Z0-9 -/"  # the range from space to slash is meant
SHORTEST_TOKEN = 3


def normalize_name(name: Column, nbsp: bool = False) -> Column:
    """One space for any run, spaced slashes, tight hyphens, trimmed, lower case. nbsp: as in live feeds, whose spaces may not break."""
    s = r"[\s ]" if nbsp else r"\s"
    x = F.regexp_replace(name, s + "+", " ")
    x = F.regexp_replace(x, s + "*/" + s + "*", " / ")
    x = F.regexp_replace(x, s + "*-" + s + "*", "-")
    return F.lower(F.trim(x))


def clean_first(name: Column) -> Column:
    """Upper case without the first character outside the kept class."""
    return F.upper(drop_first_outside(name))


def drop_first_outside(name: Column) -> Column:
    return F.regexp_replace(name, f"^([{KEPT}]*)[^{KEPT}]", "$1")


def clean_all(name: Column) -> Column:
    """Upper case without any character outside the kept class, trimmed."""
    return F.trim(F.upper(F.regexp_replace(name, f"[^{KEPT}]", "")))


def tokens(name: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(name), F.lit("[a-z0-9]+"), F.lit(0)))


def blocking_tokens(name: Column) -> Column:
    long = F.filter(tokens(name), lambda t: F.length(t) >= SHORTEST_TOKEN)
    return F.array_sort(F.array_except(long, F.array(*map(F.lit, COMMON_TOKENS))))


def token_overlap(a: Column, b: Column) -> Column:
    """Shared tokens over the smaller token set; 0 if either is empty."""
    x, y = tokens(a), tokens(b)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)).cast("double"), F.least(F.size(x), F.size(y)).cast("double")), F.lit(0.0))
