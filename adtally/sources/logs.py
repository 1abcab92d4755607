"""Tracking log lines from files and from a stream."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string


def read_log_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text lines of plain or gzip files, one ``value`` column.

    A gzip file is read by one task, so the collector's file count is the parallelism.
    """
    return spark.read.text(paths)


def json_rows(lines: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """JSON texts as columns of a fixed schema; absent fields are NULL."""
    return lines.select(F.from_json(column, schema).alias("row")).select("row.*")


def inferred_schema(lines: DataFrame, column: str = "value") -> StructType:
    """The schema of JSON texts, from one aggregate over all of them: the same however they are partitioned.

    A field has the narrowest type that holds all its values, and is text if they have none in common or
    are null throughout. Texts that are not a JSON object do not count.
    """
    objects = lines.select(F.try_parse_json(column).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    found = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    if not found.startswith("OBJECT<"):  # no object at all
        return StructType()
    text = re.sub(r"\b(VARIANT|VOID)\b(?=[,>])", "STRING", found.replace("OBJECT<", "STRUCT<"))
    return _parse_datatype_string(text) if text != "STRUCT<>" else StructType()


def inferred_json_rows(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON texts as columns of their inferred schema; absent fields are NULL, and so is all of a text without an object."""
    schema = inferred_schema(lines, column)
    if not schema.fields:
        return lines.select()
    return json_rows(lines, schema, column)


def stream_kafka_lines(
    spark: SparkSession,
    servers: str,
    topics: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Log lines of Kafka topics; needs the Kafka connector on the class path.

    ``starting_offsets`` matters on the first start only: afterwards the checkpoint of the
    query holds the offsets.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(F.col("value").cast("string"))


def stream_file_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """Log lines of files that arrive in a folder, so many files or bytes (whole files) in a batch at most."""
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("a stream is limited by files or by bytes")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.text(path)
