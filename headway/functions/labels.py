"""Classifiers that turn numbers and timestamps into labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Severity labels with the ratio each ends below; the last is open and takes NULL too.
SEVERITY_BOUNDS = (("free_flow", 1.1), ("light", 1.3), ("moderate", 1.6), ("heavy", 2.0))
SEVERITY_OPEN = "severe"
SEVERITIES = tuple(label for label, _ in SEVERITY_BOUNDS) + (SEVERITY_OPEN,)

# First and last hour of each time-of-day label; any other hour is overnight.
TIME_PERIODS = (("morning_rush", 7, 9), ("midday", 10, 15), ("evening_rush", 16, 18), ("evening", 19, 21))
TIME_PERIOD_OTHER = "overnight"

# Route type codes; any other code, and NULL, is "other".
ROUTE_TYPES = ((1, "subway"), (2, "rail"), (3, "bus"), (4, "ferry"))
ROUTE_TYPE_OTHER = "other"

# Spark numbers Sunday 1 and Saturday 7.
WEEKEND_DAYS = (1, 7)
DAY_TYPES = ("weekday", "weekend")


def _first_match(cases: list[tuple[Column, str]], otherwise: str) -> Column:
    """CASE expression over (condition, label) pairs; a NULL condition does not match."""
    condition, label = cases[0]
    chain = F.when(condition, F.lit(label))
    for condition, label in cases[1:]:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def congestion_severity(ratio: Column) -> Column:
    return _first_match([(ratio < bound, label) for label, bound in SEVERITY_BOUNDS], SEVERITY_OPEN)


def time_period(hour: Column) -> Column:
    return _first_match([(hour.between(first, last), label) for label, first, last in TIME_PERIODS], TIME_PERIOD_OTHER)


def day_type(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(*WEEKEND_DAYS), F.lit("weekend")).otherwise(F.lit("weekday"))


def route_type_label(code: Column) -> Column:
    return _first_match([(code == value, label) for value, label in ROUTE_TYPES], ROUTE_TYPE_OTHER)
