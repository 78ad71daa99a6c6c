"""Predicate builder over entity tables.

Each builder returns a ``Column``; combinators fold them. Filters stay
declarative, so Catalyst pushes what it can into the parquet scan (name and
result bounds, time ranges) and prunes the rest.

``properties`` may be a struct (entity tables built here) or a
``map<string,string>`` (entity JSON read back); ``prop`` reads both.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.time import parse_instant


def prop(key: str, props: str = "properties") -> Column:
    return F.col(props)[key]


# P1 / P2
def property_equals(key: str, value, props: str = "properties") -> Column:
    """Text, number or boolean equality on a property."""
    p = prop(key, props)
    if isinstance(value, bool):
        return F.lower(p.cast("string")) == F.lit(str(value).lower())
    if isinstance(value, (int, float)):
        return p.cast("string").try_cast("double") == F.lit(float(value))
    return p.cast("string") == F.lit(value)


# P3
def _num(key: str, props: str) -> Column:
    return prop(key, props).cast("string").try_cast("double")


def property_not_equals(key: str, value, props: str = "properties") -> Column:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return _num(key, props) != F.lit(float(value))
    return prop(key, props).cast("string") != F.lit(str(value))


def property_greater_than(key: str, value: float, props: str = "properties") -> Column:
    return _num(key, props) > F.lit(float(value))


def property_greater_or_equal(key: str, value: float, props: str = "properties") -> Column:
    return _num(key, props) >= F.lit(float(value))


def property_less_than(key: str, value: float, props: str = "properties") -> Column:
    return _num(key, props) < F.lit(float(value))


def property_less_or_equal(key: str, value: float, props: str = "properties") -> Column:
    return _num(key, props) <= F.lit(float(value))


# P4
def property_in(key: str, *values: str, props: str = "properties") -> Column:
    return prop(key, props).cast("string").isin(*values)


# P5
def name_equals(v: str, col: str = "name") -> Column:
    return F.col(col) == F.lit(v)


def name_starts_with(v: str, col: str = "name") -> Column:
    return F.col(col).startswith(v)


def name_ends_with(v: str, col: str = "name") -> Column:
    return F.col(col).endswith(v)


def name_contains(v: str, col: str = "name") -> Column:
    return F.col(col).contains(v)


# P6
def result_greater_than(v: float, col: str = "result") -> Column:
    return F.col(col) > F.lit(float(v))


def result_less_than(v: float, col: str = "result") -> Column:
    return F.col(col) < F.lit(float(v))


def time_at_or_after(instant: str, col: str = "phenomenon_ts") -> Column:
    """phenomenonTime ge an ISO instant (zone designator optional, F7)."""
    return F.col(col) >= parse_instant(F.lit(instant))


def time_at_or_before(instant: str, col: str = "phenomenon_ts") -> Column:
    return F.col(col) <= parse_instant(F.lit(instant))


def all_of(*terms: Column) -> Column:
    """``and``; zero terms = no filter."""
    return reduce(lambda a, b: a & b, terms) if terms else F.lit(True)


def any_of(*terms: Column) -> Column:
    """``or``; zero terms = no filter."""
    return reduce(lambda a, b: a | b, terms) if terms else F.lit(True)


def negate(term: Column) -> Column:
    """``not`` over the whole expression."""
    return ~term


def group(term: Column) -> Column:
    """Parenthesised group: Column expressions are already trees."""
    return term
