"""Counts over sliding windows."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adtally.schemas import WINDOW_COUNTS
from adtally.session import DEFAULTS, STATE_STORE, drop_folder, materialize, settings
from adtally.sinks.files import replace_partitions
from adtally.streaming.naming import BATCH, batch_stream


def _words(lines: DataFrame, watermark: str | None) -> DataFrame:
    """(ts, word) of every word of ``value``."""
    if watermark:
        lines = lines.withWatermark("ts", watermark)
    text = F.rtrim("value")
    blank = (text == "") & (F.col("value") != "")
    return lines.select("ts", F.explode(F.when(~blank, F.split(text, " "))).alias("word"))


def _shown(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "word", "n"
    )


def sliding_counts(
    lines: DataFrame,
    watermark: str | None,
    size: str = "20 seconds",
    slide: str = "10 seconds",
) -> DataFrame:
    """Occurrences of each word of ``value`` in event-time windows over ``ts``.

    Works on a table and on a stream. The watermark lets a stream forget old windows; None keeps every
    window, which only a source that ends can afford.
    """
    words = _words(lines, watermark)
    return _shown(words.groupBy(F.window("ts", size, slide).alias("w"), "word").agg(F.count("*").alias("n")))


def _micros(spark: SparkSession, *durations: str) -> list[int]:
    """Lengths of time as ``window`` takes them, a day having 24 hours."""
    zero = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
    gaps = spark.sql("SELECT " + ", ".join(f"{zero} + CAST('{text}' AS INTERVAL) - {zero}" for text in durations)).first()
    return [gap // dt.timedelta(microseconds=1) for gap in gaps]


#: Windows that ``pane_counts`` keeps in one row of its state at most.
TOGETHER = 32


def pane_counts(
    lines: DataFrame, watermark: str | None, size: str = "20 seconds", slide: str = "10 seconds", together: int | None = None
) -> DataFrame:
    """The same counts, from panes: a row counts once, in its pane, and a window is the sum of its panes.

    ``sliding_counts`` copies every row into all its windows; here the counts of a pane are added to windows, once
    the watermark has closed it. As a stream both steps keep state (append mode), and the watermark is needed.

    The second step has a row for ``together`` consecutive windows of a word, a sum for each, and a pane goes into the
    few rows that hold its windows (two at most by default, up to ``TOGETHER`` slides a window), not into each window.
    The windows of a row come out, whole, when the last of them has ended: up to ``together`` - 1 slides after the first,
    by default less than a window's size. One keeps windows apart: each comes out when it has ended.
    """
    length, step = _micros(lines.sparkSession, size, slide)
    together = together or min(-(-length // step), TOGETHER)
    pane = F.window("ts", f"{math.gcd(length, step)} microseconds")
    panes = _words(lines, watermark).groupBy(pane.alias("pane"), "word").agg(F.count("*").alias("n"))
    run = F.window(F.window_time("pane"), f"{(together - 1) * step + length} microseconds", f"{together * step} microseconds")
    rows = panes.select(run.alias("run"), F.col("pane.start").alias("at"), "word", "n")
    begin, kind = F.unix_micros(F.col("run.start").cast("timestamp")), rows.schema["at"].dataType
    into = F.unix_micros(F.col("at").cast("timestamp")) - begin
    sums = [F.sum(F.when(into.between(k * step, k * step + length - 1), F.col("n"))) for k in range(together)]
    runs = rows.groupBy("run", "word").agg(F.array(*sums).alias("counts"))
    windows = runs.select("run", "word", F.posexplode("counts").alias("k", "n")).where("n IS NOT NULL")
    start = begin + F.col("k") * step
    bounds = {"window_start": F.timestamp_micros(start).cast(kind), "window_end": F.timestamp_micros(start + length).cast(kind)}
    return windows.withColumns(bounds).select(*bounds, "word", "n")


def start_sliding_counts(
    counts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, mode: str = "update"
) -> StreamingQuery:
    """Store the windows each batch changes (or, in append mode, ends), one partition per stream and batch.

    The stream is named by the query id, which belongs to the checkpoint: streams on one path do not
    touch each other, and one that is started without its checkpoint is another stream. The state is
    kept by RocksDB, on disk, since the number of open windows grows with the data.
    """
    spark = counts.sparkSession

    def store(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(_named(batch, batch_stream(spark), batch_id), path, BATCH)

    writer = (
        counts.writeStream.outputMode(mode)
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    with settings(spark, {STATE_STORE: DEFAULTS[STATE_STORE]}):
        # A query keeps the settings it was started with.
        return writer.start()


def _named(rows: DataFrame, stream_id: str, batch_id: int) -> DataFrame:
    return rows.withColumns({"stream_id": F.lit(stream_id), "batch_id": F.lit(batch_id).cast("long")})


#: What a count is of.
COUNTED = ["window_start", "window_end", "word"]


def _newest(stored: DataFrame, *streams: str) -> DataFrame:
    """The newest count of every window and word, of each stream if the column is given."""
    return stored.groupBy(*streams, *COUNTED).agg(F.max_by("n", "batch_id").alias("n"))


def read_sliding_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of every window and word, all streams together; those of one stream are not added up."""
    stored = spark.read.schema(WINDOW_COUNTS).parquet(path)
    streams = {file.rsplit("/", 3)[1] for file in stored.inputFiles()}
    if len(streams) == 1:
        return _newest(stored)
    return _newest(stored, "stream_id").groupBy(*COUNTED).agg(F.sum("n").alias("n"))


def fold_sliding_counts(spark: SparkSession, path: str) -> None:
    """Put the batches of each stream that cannot come again into the last of them.

    That is every batch but the newest, which a stream that failed may store anew. The last one gets
    the newest count of each window up to it, so that a reader finds the same counts before, while and
    after the older partitions go, and however often this is repeated.
    """
    stored = spark.read.schema(WINDOW_COUNTS).parquet(path)
    batches: dict[str, list[int]] = {}
    for row in stored.select(*BATCH).distinct().collect():
        batches.setdefault(row.stream_id, []).append(row.batch_id)
    for stream_id, numbers in batches.items():
        *older, last = sorted(numbers)[:-1] or [None]
        if not older:
            continue
        rows = stored.where((F.col("stream_id") == stream_id) & (F.col("batch_id") <= last))
        kept = materialize(_newest(rows), "folded-windows")
        replace_partitions(_named(kept, stream_id, last), path, BATCH)
        for number in older:
            drop_folder(spark, f"{path}/stream_id={stream_id}/batch_id={number}")
