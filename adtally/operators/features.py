"""Features of the conversion model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.operators.order import numbered

FeatureColumns = Sequence[tuple[str, str]]

#: Tasks over which the deliveries of one click are spread at most; raise it with the cluster.
SALTS = 64

#: How often a row is repeated by one array at most.
CHUNK = 65_536


def column_list(feature_columns: DataFrame) -> list[tuple[str, str]]:
    """The (column, short) pairs of a column file; a query needs them to name its columns."""
    return [(row.column, row.short) for row in feature_columns.collect()]


def _feature(column: str, short: str) -> Column:
    return F.concat(F.lit(f"{short}_"), F.col(column).cast("string"))


def feature_values(deliveries: DataFrame, columns: FeatureColumns) -> DataFrame:
    """Distinct features with the position of their column, all columns in one scan."""
    cells = [
        F.struct(F.lit(at).alias("at"), _feature(column, short).alias("feature"))
        for at, (column, short) in enumerate(columns)
    ]
    rows = deliveries.where("request_time is not null").select(F.inline(F.array(*cells)))
    return rows.where("feature is not null").groupBy("feature").agg(F.min("at").alias("at"))


def feature_index(values: DataFrame) -> DataFrame:
    """Features numbered from 1 by column position and value."""
    return numbered(values, ["at", "feature"], "idx").select("feature", "idx")


def labelled_rows(
    deliveries: DataFrame, conversions: DataFrame, dedupe: bool = False, salts: int = SALTS
) -> DataFrame:
    """Deliveries with ``label`` 1 where a conversion names their click, else 0.

    A click with several conversions gives several rows unless ``dedupe`` is on; then the deliveries
    of one click are spread over up to ``salts`` tasks.
    """
    rows = deliveries.where("request_time is not null")
    converted = conversions.select("format_uuid")
    same_click = F.col("click_uuid") == F.col("format_uuid")
    if dedupe:
        # The salt spreads the deliveries of one click, and makes both sides plain shuffles: a
        # side that is already partitioned by the key could not be split at run time.
        every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        converted = converted.distinct().select("format_uuid", every.alias("salt"))
        same_click = same_click & (F.pmod(F.xxhash64(*rows.columns), F.lit(salts)) == F.col("salt"))
    joined = rows.join(converted, same_click, "left")
    label = F.col("format_uuid").isNotNull().cast("int")
    return joined.select(*rows.columns, label.alias("label"))


def encode(rows: DataFrame, index: DataFrame, columns: FeatureColumns) -> DataFrame:
    """Label and ascending feature indices of every row; unknown features are skipped.

    Equal rows of a partition are encoded once and come back as often as they were there. Rows are numbered and their
    features unpivoted to (row, feature), which meet the dictionary in one join whatever the number of columns; one
    aggregate brings the indices of a row together. A row whose features are all null or unknown keeps its label, since
    the unpivoting and the join are outer.
    """
    names = list(dict.fromkeys(column for column, _ in columns))
    # Grouped within partitions: equal rows of all of them may be too many to come back from one task.
    part = F.spark_partition_id().alias("part")
    equal = rows.groupBy("label", *names, part).agg(F.count("*").alias("times"))
    cells = F.array(*[_feature(column, short) for column, short in columns])
    each = equal.select(F.monotonically_increasing_id().alias("row"), "label", "times", cells.alias("cells"))
    each = each.select("row", "label", "times", F.explode_outer("cells").alias("feature"))
    known = each.join(index, "feature", "left").groupBy("row").agg(
        F.first("label").alias("label"), F.first("times").alias("times"), F.array_sort(F.collect_list("idx")).alias("indices")
    )
    return _repeated(known, "times").select("label", "indices")


def _repeated(rows: DataFrame, times: str) -> DataFrame:
    """Every row as often as ``times`` says, by sequences of at most ``CHUNK`` numbers.

    The sequences are spread by number: few rows may make many, and the adaptive plan sees the size of the few.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(times) - 1, F.lit(CHUNK).cast("bigint"))).alias("start"))
    last = F.least(F.col("start") + CHUNK, F.col(times)) - 1
    return starts.repartition(tasks, "row", "start").select("*", F.explode(F.sequence("start", last)).alias("at"))


def libsvm_lines(encoded: DataFrame) -> DataFrame:
    """``label idx:1 …`` texts."""
    cells = F.transform("indices", lambda i: F.concat(i.cast("string"), F.lit(":1")))
    return encoded.select(
        F.concat_ws(" ", F.col("label").cast("string"), cells).alias("value")
    )


def index_lines(index: DataFrame) -> DataFrame:
    """``feature,idx`` texts of the dictionary."""
    return index.select(F.concat_ws(",", "feature", F.col("idx").cast("string")).alias("value"))
