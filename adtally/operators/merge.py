"""Keyed merges of counters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import folder_exists, materialize
from adtally.sinks.files import replace_partitions

BUCKET = "bucket"


def additive_merge(
    target: DataFrame, delta: DataFrame, keys: Sequence[str], measures: Sequence[str], counted: bool = False
) -> DataFrame:
    """Target rows with the delta added: new keys appear, measures of known keys are summed.

    A union and one aggregate give the same rows as a full outer join with sums, but NULL keys
    need no care and both sides are combined before the shuffle, whatever the key skew.

    ``counted`` says that each side has a key once, fresh from an aggregate. There is nothing to combine then, and without
    a shuffle of its own the merge would keep its hash tables beside those of the aggregates, in tasks that the adaptive
    plan has made few; its rows are spread over all shuffle partitions instead.
    """
    columns = [*keys, *measures]
    both = target.select(*columns).unionByName(delta.select(*columns))
    if counted:
        # In another order of the keys, or the shuffle would be left out as one that the aggregates have made already.
        both = both.repartition(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), *reversed(keys))
    sums = [
        F.sum(name).cast(target.schema[name].dataType).alias(name) for name in measures
    ]
    return both.groupBy(*keys).agg(*sums)


def _stored(target: DataFrame, columns: Sequence[str]) -> DataFrame:
    return target.select(*[F.col(name).alias(f"stored_{name}") for name in columns])


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"stored_{key}")) for key in keys]
    )


def new_rows(delta: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delta rows whose key the target lacks."""
    return delta.join(_stored(target, keys), _same_key(keys), "left_anti")


def updated_rows(
    delta: DataFrame, target: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Rows of keys on both sides, measures added."""
    joined = delta.join(_stored(target, [*keys, *measures]), _same_key(keys), "inner")
    added = [
        (F.col(name) + F.col(f"stored_{name}")).cast(target.schema[name].dataType).alias(name)
        for name in measures
    ]
    return joined.select(*keys, *added)


def stored_beside(
    delta: DataFrame, target: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Every delta row with the stored measures (``stored_*``, NULL for a new key)."""
    joined = delta.join(_stored(target, [*keys, *measures]), _same_key(keys), "left")
    return joined.select(*delta.columns, *[f"stored_{name}" for name in measures])


def merge_into_buckets(
    delta: DataFrame, path: str, keys: Sequence[str], measures: Sequence[str], buckets: int
) -> list[int]:
    """Add a delta to the table below ``path``, rewriting only the buckets that its keys fall in; gives their numbers.

    Rows lie in folders by a hash of their key, so a key has one bucket, and ``buckets`` must stay what it was. The
    merged rows are stored before the folders are replaced: a merge that fails earlier leaves the table as it was.
    """
    spark = delta.sparkSession
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    new = materialize(delta.select(*keys, *measures, number.alias(BUCKET)), "bucket-delta")
    # At most ``buckets`` rows.
    touched = sorted(row[BUCKET] for row in new.select(BUCKET).distinct().collect())
    merged = new
    if folder_exists(spark, path):
        merged = additive_merge(read_buckets(spark, path, delta, keys, measures, touched), new, [*keys, BUCKET], measures)
    replace_partitions(materialize(merged, "merged-buckets"), path, [BUCKET])
    return touched


def read_buckets(
    spark: SparkSession, path: str, like: DataFrame, keys: Sequence[str], measures: Sequence[str], some: Sequence[int] | None = None
) -> DataFrame:
    """Rows of the table, or of some of its buckets; the scan reads their folders only."""
    schema = like.select(*keys, *measures, F.lit(0).alias(BUCKET)).schema
    stored = spark.read.schema(schema).parquet(path)
    return stored if some is None else stored.where(F.col(BUCKET).isin(list(some)))
