"""Slices (days, hours) in which something was active, and rows that lie in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Events that make an ad active in a slice.
ACTIVE_EVENT = 6


def active_slices(tracking: DataFrame, ad_id: int, by: Sequence[str] = ("d", "h")) -> DataFrame:
    """(ad_id, day[, hour]) of the slices in which an ad had an install."""
    rows = tracking.where((F.col("ad_id") == ad_id) & (F.col("event") == ACTIVE_EVENT))
    return rows.select("ad_id", *by).distinct()


def in_slices(rows: DataFrame, slices: DataFrame, by: Sequence[str] = ("d", "h")) -> DataFrame:
    """Rows of a table that is partitioned by ``by`` which lie in one of the slices.

    The slices are a filtered join side, so that Spark reads only the partitions that they name: they are looked up
    first and prune the scan while the query runs.
    """
    wanted = slices.select(*by).distinct()
    return rows.join(wanted, list(by))
