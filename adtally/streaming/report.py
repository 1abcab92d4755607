"""The running report over a stream of log lines.

Each micro-batch is reduced to counters and stored as its own partition below ``batches``, named by
the query and the batch. A batch that is replayed after a failure replaces its partition, so nothing
is counted twice and no ledger has to be kept in step with the data; the cost of a batch depends on the
batch alone. ``fold`` adds the batches of closed days up below ``folded``; the report is the sum over
the folded days and the batches that are in none of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally.functions.dates import stamp_day, stamp_hour
from adtally.functions.labels import source_alias
from adtally.functions.numbers import int_or_zero, price_or_zero
from adtally.operators.reports import COUNTERS, GRAIN, MEASURES, counters, finish, reroll, stream_billing
from adtally.operators.tracking import REJECT, parse_lines
from adtally.schemas import FOLDED_COUNTS, STREAM_COUNTS
from adtally.session import DEFAULTS, STATE_STORE, drop_folder, folder_exists, settings
from adtally.sinks.files import replace_partitions
from adtally.streaming.naming import BATCH, batch_stream

KEYS = GRAIN["all_report"]


def stream_rows(lines: DataFrame) -> DataFrame:
    """Events of log lines with exactly three fields, a ``yyyyMMddHH`` stamp and a client id.

    Day and hour come from the stamp; a line without one belongs to no slice. Spaces are removed from the key columns; absent
    numbers are zero and absent texts empty.
    """
    rows = parse_lines(lines, exact_fields=True).where(
        ~F.col(REJECT) & F.col("stamp").rlike(r"^\d{10}") & F.col("hqClientId").isNotNull()
    )

    def text(name: str):
        return F.replace(F.coalesce(F.col(name), F.lit("")), F.lit(" "), F.lit(""))

    return rows.select(
        text("hqClientId").alias("client_id"),
        int_or_zero(text("hqGroupId")).alias("group_id"),
        int_or_zero(text("hqAdId")).alias("ad_id"),
        int_or_zero(text("hqCreativeId")).alias("creative_id"),
        text("tagId").alias("tag_id"),
        text("channelId").alias("channel_id"),
        text("plmtid").alias("placement_id"),
        F.col("hqSource").alias("source"),
        F.replace(F.coalesce(source_alias(F.col("hqSource")), F.lit("")), F.lit(" "), F.lit(""))
        .alias("platform"),
        F.col("hqEvent").try_cast("int").alias("event"),
        price_or_zero(F.col("hqPrice")).alias("price"),
        stamp_day(F.col("stamp")).alias("d"),
        stamp_hour(F.col("stamp")).alias("h"),
    )


def batch_counts(rows: DataFrame) -> DataFrame:
    """Counters per report key."""
    return rows.groupBy(*KEYS).agg(*counters(stream_billing))


def store_batch(
    counts: DataFrame, path: str, stream_id: str, batch_id: int, by: Sequence[str] = ("d", "h")
) -> None:
    """Store the counters of a batch; storing the same batch again replaces it."""
    named = counts.withColumn("stream_id", F.lit(stream_id)).withColumn("batch_id", F.lit(batch_id))
    replace_partitions(named, f"{path}/batches", [*by, *BATCH])


def start_report(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str] = ("d", "h"),
    trigger: dict | None = None,
    store: Callable[[DataFrame, str, int], None] | None = None,
) -> StreamingQuery:
    """Run the report over a stream of log lines.

    ``trigger`` is passed to ``DataStreamWriter.trigger``, for example
    ``{"processingTime": "10 seconds"}``; by default everything available is read once. The
    query id that names the partitions belongs to the checkpoint: a stream restarted without its
    checkpoint is another stream. ``store`` may put the counters of a batch elsewhere, for
    example ``sinks.jdbc.append_counts``; it gets them with the names of the stream and the batch.
    """
    spark = lines.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        counts, stream_id = batch_counts(batch), batch_stream(spark)
        if store:
            store(counts, stream_id, batch_id)
        else:
            store_batch(counts, path, stream_id, batch_id, by)

    return (
        stream_rows(lines)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_state_report(lines: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the running totals in the state of the query itself; ``read_state_report`` reads them there.

    Nothing else is stored. Every key stays in the state, in RocksDB on disk, so this suits keys whose number is bounded
    by what is advertised; ``start_report`` with ``fold`` is for keys that grow with time.
    """
    spark = lines.sparkSession
    writer = batch_counts(stream_rows(lines)).writeStream.outputMode("update").format("noop")
    with settings(spark, {STATE_STORE: DEFAULTS[STATE_STORE]}):
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_state_report(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The report as of the last finished batch, from the state below a checkpoint; the query need not run."""
    state = spark.read.format("statestore").load(checkpoint)
    # The state holds the aggregates in their order; a decimal sum has a mark beside it that it is empty.
    fields = [*(f"{name}: bigint" for name in COUNTERS), f"billed: {STREAM_COUNTS['billed'].dataType.simpleString()}", "none: boolean"]
    values = F.col("value").cast(f"struct<{', '.join(fields)}>").alias("value")
    return finish(state.select("key.*", values).select(*KEYS, *[f"value.{name}" for name in MEASURES]), positive_only=False)


def _stored(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The newest folded rows of each day and stream, and the batches that they do not hold."""
    batches = spark.read.schema(STREAM_COUNTS).parquet(f"{path}/batches")
    if not folder_exists(spark, f"{path}/folded"):
        return spark.createDataFrame([], FOLDED_COUNTS), batches
    folded = spark.read.schema(FOLDED_COUNTS).parquet(f"{path}/folded")
    newest = folded.groupBy("d", "stream_id").agg(F.max("upto").alias("upto"))
    known = newest.withColumnRenamed("upto", "held")
    fresh = batches.join(known, ["d", "stream_id"], "left").where("held is null or batch_id > held").drop("held")
    return folded.join(newest, ["d", "stream_id", "upto"], "left_semi"), fresh


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The running totals per report key, still mergeable."""
    folded, batches = _stored(spark, path)
    columns = [*KEYS, *MEASURES]
    return reroll(folded.select(*columns).unionByName(batches.select(*columns)), KEYS)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The running report; a condition on ``d`` and ``h`` reads those partitions only."""
    return finish(read_counts(spark, path), positive_only=False)


def fold(spark: SparkSession, path: str, closed: str) -> None:
    """Add up the batches of the days that ``closed`` (a condition on ``d``) selects.

    A folded day of a stream says up to which batch it goes. Until it is there, readers use its
    batches; from then on they leave those out, whether or not the folders are gone already. Later
    batches for the day still count, and folding again takes them in. It may be repeated at any time.
    """
    folded, batches = _stored(spark, path)
    batches = batches.where(closed)
    # At most one row per closed day and stream.
    done = {(r.d, r.stream_id): r.upto for r in batches.groupBy("d", "stream_id").agg(F.max("batch_id").alias("upto")).collect()}
    if not done:
        return
    # Built in the plan, so that its size is known to the optimizer.
    known = [F.struct(F.lit(day).alias("d"), F.lit(name).alias("stream_id"), F.lit(last).cast("bigint").alias("upto")) for (day, name), last in done.items()]
    upto = spark.range(1).select(F.inline(F.array(*known)))
    rows = batches.drop("batch_id").unionByName(folded.drop("upto").join(upto, ["d", "stream_id"], "left_semi"))
    sums = rows.groupBy(*KEYS, "stream_id").agg(
        *[F.sum(name).cast(FOLDED_COUNTS[name].dataType).alias(name) for name in MEASURES]
    )
    # Written as they are added up: a new ``upto`` is a new folder, so none that is read here is replaced.
    replace_partitions(sums.join(upto, ["d", "stream_id"]), f"{path}/folded", ["d", "stream_id", "upto"])
    for kind, schema, number in (("batches", STREAM_COUNTS, "batch_id"), ("folded", FOLDED_COUNTS, "upto")):
        stored = spark.read.schema(schema).parquet(f"{path}/{kind}").where(closed)
        folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
        for r in stored.select("d", "stream_id", number, folder).distinct().collect():
            last = done.get((r.d, r.stream_id))
            if last is not None and (r[number] <= last if kind == "batches" else r[number] < last):
                drop_folder(spark, r.folder)
