"""Results handed to other systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.operators.ctr import Trained, metrics_frame
from adtally.operators.order import numbered
from adtally.session import materialize
from adtally.sinks.files import write_lines


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def json_message(report: DataFrame, request_id: int) -> DataFrame:
    """(at, fragment): pieces of one document ``{"id": …, "data": [row, …]}``, rows in column order.

    In the order of ``at`` the fragments make the document, however long it is: a header, one piece
    per report row, a footer. No task holds more than a slice of them.
    """
    rows = materialize(numbered(report, report.columns, "_at"), "message")
    comma = F.when(F.col("_at") > 1, ",").otherwise("")
    pieces = rows.select(F.col("_at").alias("at"), F.concat(comma, F.to_json(F.struct(*report.columns))).alias("fragment"))
    # One row each, also of an empty report.
    head = rows.agg(F.lit(0).cast("bigint").alias("at"), F.lit(f'{{"id":{int(request_id)},"data":[').alias("fragment"))
    tail = rows.agg((F.count("*") + 1).alias("at"), F.lit("]}").alias("fragment"))
    return head.unionByName(pieces).unionByName(tail)


def write_fragments(fragments: DataFrame, path: str, order: list[str]) -> None:
    """Fragments as text files whose names follow the order; one fragment per line is the same JSON."""
    lines = fragments.orderBy(*order).select("fragment")
    lines.write.mode("overwrite").text(path)


def save_model(spark: SparkSession, trained: Trained, path: str) -> None:
    """Model under ``path/model`` and its two areas as text under ``path/auc``."""
    trained.model.write().overwrite().save(f"{path}/model")
    write_lines(metrics_frame(spark, trained), f"{path}/auc", separator="=")
