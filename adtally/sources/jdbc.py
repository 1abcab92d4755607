"""Slices of a report table in a database."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Slice = tuple[str, int]


def slice_predicates(slices: Iterable[Slice]) -> list[str]:
    """One condition per distinct (day, hour), so no row is read twice."""
    distinct = sorted({(_day(day), int(hour)) for day, hour in slices})
    return [f"day='{day}' and hour={hour}" for day, hour in distinct]


def day_predicates(days: Iterable[str], first_hour: int = 0, last_hour: int = 23) -> list[str]:
    """One condition per distinct day, limited to an hour range."""
    hours = f"hour between {int(first_hour)} and {int(last_hour)}"
    return [f"day='{day}' and {hours}" for day in sorted({_day(day) for day in days})]


def _day(day: str) -> str:
    digits = day.replace("-", "")
    if len(digits) != 8 or not digits.isdigit():
        raise ValueError(f"not a day: {day!r}")
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:]}"


def read_report(
    spark: SparkSession,
    url: str,
    table: str,
    predicates: list[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Rows of the conditions, read by one task and one connection per condition."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def running_counts(stored: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Totals per key of counters that ``sinks.jdbc.append_counts`` stored.

    A batch that was inserted again after a failure has equal rows, of which one counts.
    """
    once = stored.groupBy(*keys, "stream_id", "batch_id").agg(*[F.max(name).alias(name) for name in measures])
    return once.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])
