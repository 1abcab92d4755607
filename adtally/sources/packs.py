"""Keyword packs and small configuration files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.schemas import FEATURE_COLUMNS, FEATURE_INDEX


def read_pack(
    spark: SparkSession, paths: str | list[str], first_field: bool = False
) -> DataFrame:
    """Words of one or more pack files, one word per line.

    ``first_field`` takes the text before the first tab. ``paths`` may be a comma-joined text.
    """
    if isinstance(paths, str):
        paths = paths.split(",")
    word = F.col("value")
    if first_field:
        word = F.split(word, "\t")[0]
    return spark.read.text(paths).select(word.alias("keyword"))


def ad_pack_files(maps: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects ``{"ad": "file", …}`` as rows (ad_id, file)."""
    entries = F.explode(F.from_json(column, "map<string,string>"))
    return maps.select(entries.alias("ad_id", "file"))


def ad_keyword_pack(spark: SparkSession, ad_files: DataFrame, folder: str, ads: DataFrame | None = None) -> DataFrame:
    """Words of every ad, or of the ``ads`` given: their files are looked up first and only those are read.

    ``ad_files`` is a configuration with one row per ad, so its file names may reach the driver. Names
    of files that are not in the folder are passed over.
    """
    wanted = ad_files if ads is None else ad_files.join(ads.select("ad_id").distinct(), "ad_id", "left_semi")
    names = wanted.select("file").where("file <> ''").distinct()
    listing = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"))
    paths = sorted(f"{folder}/{row.file}" for row in names.join(listing, "file", "left_semi").collect())
    lines = spark.read.text(paths) if paths else spark.createDataFrame([], "value string")
    file = F.col("_metadata.file_name") if paths else F.lit("")
    words = lines.select(F.col("value").alias("keyword"), file.alias("file"))
    return words.join(wanted, "file").select("ad_id", "keyword")


def read_feature_columns(spark: SparkSession, path: str) -> DataFrame:
    """Rows (column, short) of the feature column file."""
    return spark.read.csv(path, schema=FEATURE_COLUMNS)


def read_feature_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows (feature, idx) of a feature dictionary in text form; the value may hold commas."""
    return spark.read.text(path).select(
        F.regexp_extract("value", r"^(.*),\d+$", 1).alias("feature"),
        F.regexp_extract("value", r",(\d+)$", 1).cast(FEATURE_INDEX["idx"].dataType).alias("idx"),
    )
