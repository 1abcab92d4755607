"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key's text modulo ``folds``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def own_prefix(documents: DataFrame) -> str:
    """A beginning that no column of ``documents`` has, for columns that an operator adds for itself."""
    prefix = "_"
    while any(name.lower().startswith(prefix) for name in documents.columns):
        prefix += "_"
    return prefix


def columns_of(documents: DataFrame) -> list[Column]:
    """All columns, whatever their names hold."""
    return [F.col(quoted(name)) for name in documents.columns]


def numbered(documents: DataFrame) -> tuple[DataFrame, str]:
    """The columns named by number, since Python functions take no names with dots, and their schema."""
    types = ", ".join(f"c{n} {kind}" for n, (_, kind) in enumerate(documents.dtypes))
    return documents.toDF(*(f"c{n}" for n in range(len(documents.columns)))), types


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sampled(documents: DataFrame, labels: DataFrame, label: str, folds: int, out: int, most: int) -> DataFrame:
    """(doc_id, text, y) of at most ``most`` labelled documents outside the held-out fold, chosen by a hash of the id.

    A document with several labels counts with the largest, an id with several texts with the smallest text; null
    labels and null ids do not count. The chosen ids are at most ``most`` rows, so they may be broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != out))
    each = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Give Python tasks this package, which the driver may have found by a path that they do not have."""
    import adtally

    context, home = spark.sparkContext, Path(adtally.__file__).parent
    if context.applicationId in _shipped or not home.is_dir():
        return
    _shipped.add(context.applicationId)
    archive = Path(tempfile.mkdtemp(prefix="adtally-code-")) / "adtally.zip"
    with zipfile.ZipFile(archive, "w") as zipped:
        for file in sorted(home.rglob("*.py")):
            zipped.write(file, file.relative_to(home.parent))
    context.addPyFile(str(archive))


def python_tasks(spark: SparkSession, rows: int = 256, size: str = "8m") -> None:
    """Prepare Python tasks: their code, and a bound on their Arrow batches by rows and bytes, for long texts."""
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def raw_texts(column) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow text column."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()


_caches: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What a Python worker keeps between tasks for one operator; the tables of all others go.

    Workers outlive stages, so without this the tables of every operator they ever ran would add up.
    """
    for name in [name for name in _caches if name != owner]:
        _caches.pop(name).clear()
    return _caches.setdefault(owner, {})
