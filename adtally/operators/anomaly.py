"""Gaussian scores of profiles, their histogram and blocklists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.functions.numbers import log_density

DEVICE_FEATURES = [
    "ipcount", "vcount", "ipmax", "vcountmax", "vdays", "vdaymean", "vipmean", "hours", "ipdaymean",
]
IP_FEATURES = ["idfacount", "vcount", "vcountmax", "vdays", "vdaymean", "hour_mask"]

# Features whose densities make up the reported probability, and the list prefix.
DEVICE_PROBABILITY = ["ipcount"]
IP_PROBABILITY = IP_FEATURES
BLOCK_PREFIX = "blk:"


def feature_stats(profile: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: mean and population variance of every feature."""
    return profile.agg(
        *[F.avg(name).alias(f"{name}_mean") for name in features],
        *[F.var_pop(name).alias(f"{name}_var") for name in features],
    )


def scores(
    profile: DataFrame, name: str, features: Sequence[str], probability: Sequence[str]
) -> DataFrame:
    """Log density per feature, their sum, and the probability of the chosen features.

    Densities are added as logarithms, so a very unlikely row does not underflow before the last
    step. A feature without variance has no density and counts as factor one. The statistics are
    one row, computed once by a scalar subquery; ``profile`` should be a stored table, since it is
    read twice.
    """
    columns = [f"{f}_{kind}" for kind in ("mean", "var") for f in features]
    stats = feature_stats(profile, features).select(F.struct(*columns)).scalar()
    rows = profile.select("*", F.inline(F.array(stats)))
    logs = rows.select(
        F.col(name).alias("name"),
        *[
            log_density(F.col(f).cast("double"), F.col(f"{f}_mean"), F.col(f"{f}_var")).alias(f"ln_{f}")
            for f in features
        ],
    )

    def joint(names: Sequence[str]):
        return sum((F.coalesce(f"ln_{f}", F.lit(0.0)) for f in names), F.lit(0.0))

    return logs.withColumn("ln_joint", joint(features)).withColumn(
        "probability", F.exp(joint(probability))
    )


def device_scores(profile: DataFrame) -> DataFrame:
    return scores(profile, "idfa", DEVICE_FEATURES, DEVICE_PROBABILITY)


def ip_scores(profile: DataFrame) -> DataFrame:
    return scores(profile, "ip", IP_FEATURES, IP_PROBABILITY)


def histogram(values: DataFrame, parts: int, column: str = "probability") -> DataFrame:
    """Rows per bin of equal width between zero and the maximum, highest bin first.

    Bins are open below and closed above and are named by their upper edge ``i * max / parts``;
    zero belongs to the first bin. The bin of a value is estimated by division and then moved by
    one where the edges themselves say so, so values on an edge are placed exactly.
    """
    top = values.agg(F.max(F.struct(F.col(column).cast("double").alias("top")))).scalar()
    rows = values.select(F.col(column).cast("double").alias("x"), F.inline(F.array(top)))
    guess = F.ceil(F.col("x") * parts / F.nullif(F.col("top"), F.lit(0.0)))
    inside = F.greatest(F.lit(1), F.least(F.lit(parts), guess))
    rows = rows.where("x is not null").select(
        "x", "top", F.when(F.col("x") == 0, 1).otherwise(inside).cast("int").alias("i")
    )

    def edge(i):
        return F.when(i == parts, F.col("top")).otherwise(i * F.col("top") / parts)

    i = F.col("i")
    placed = (
        F.when((i > 1) & (F.col("x") <= edge(i - 1)), i - 1)
        .when((i < parts) & (F.col("x") > edge(i)), i + 1)
        .otherwise(i)
    )
    bins = rows.groupBy(placed.alias("bin"), "top").agg(F.count("*").alias("n"))
    return bins.select(
        F.col("bin"), edge(F.col("bin")).alias("edge"), "n"
    ).orderBy(F.desc("edge"))


def ip_blocklist(profile: DataFrame, videos: int, devices: int) -> DataFrame:
    """IPs with more than ``videos`` videos or more than ``devices`` devices."""
    hits = profile.where((F.col("vcount") > videos) | (F.col("idfacount") > devices))
    return hits.select(
        F.concat(F.lit(BLOCK_PREFIX), "ip").alias("name"),
        F.col("vcount").alias("videos"),
        F.col("idfacount").alias("devices"),
    )


def device_blocklist(profile: DataFrame, videos: int) -> DataFrame:
    """Devices with more than ``videos`` videos."""
    return profile.where(F.col("vcount") > videos).select(
        F.col("idfa").alias("name"), F.col("vcount").alias("videos")
    )


def low_probability(scored: DataFrame, limit: float, prefix: str = "") -> DataFrame:
    """Names whose probability is below ``limit``."""
    return scored.where(F.col("probability") < limit).select(
        F.concat(F.lit(prefix), "name").alias("name")
    )


def with_expiry(blocklist: DataFrame, day: str, ttl_days: int = 30) -> DataFrame:
    """Blocklist with the day (``yyyyMMdd``) after which an entry no longer counts."""
    expires = F.date_add(F.to_date(F.lit(day), "yyyyMMdd"), ttl_days)
    return blocklist.withColumn("expires_at", F.date_format(expires, "yyyyMMdd"))
