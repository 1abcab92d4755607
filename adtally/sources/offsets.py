"""A stream of log lines that starts from stored offsets.

An offset names a log file and a line: all files before it in name order are read, and of the file itself
the lines before that one. The stream starts at given offsets, else where a stored offset says, else at
the newest line; afterwards the checkpoint of the query holds the offsets. With an ``offsets`` file the end of a
batch is stored there once the next one starts, so that a stream without that checkpoint can go on from it;
it reads the last batch again.

The driver lists names and counts the lines of the newest file only; lines are read by tasks, a file each. The
newest file may still grow: of it, whole lines count. The folder is any that pyarrow can open.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Lines of a batch that goes to Spark, and bytes read at once while lines are counted.
LINES, BYTES = 10_000, 1 << 20


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return pa.fs.FileSystem.from_uri(path)


class LinePartition(InputPartition):
    """Lines ``first`` to before ``last`` of a file; without ``last`` to its end."""

    def __init__(self, file: str, first: int, last: int | None):
        self.file, self.first, self.last = file, first, last


class LogLineReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.starting, self.stored = options["path"], options.get("startingoffsets"), options.get("offsets")

    def files(self) -> list[str]:
        """Paths below the folder in name order; names that begin with ``_`` or ``.`` are not log files."""
        store, root = file_system(self.path)
        found = store.get_file_info(pa.fs.FileSelector(root, recursive=True, allow_not_found=True))
        names = [info.path[len(root):].lstrip("/") for info in found if info.type == pa.fs.FileType.File]
        return sorted(n for n in names if not any(part.startswith(("_", ".")) for part in n.split("/")))

    def lines_of(self, file: str) -> int:
        store, root = file_system(self.path)
        n = 0
        with store.open_input_stream(f"{root}/{file}") as data:
            while block := data.read(BYTES):
                n += block.count(b"\n")
        return n

    def initialOffset(self) -> dict:
        if self.starting:
            return json.loads(self.starting)
        if self.stored:
            store, path = file_system(self.stored)
            if store.get_file_info(path).type == pa.fs.FileType.File:
                with store.open_input_stream(path) as data:
                    return json.loads(data.read())
        return self.latestOffset()

    def latestOffset(self) -> dict:
        files = self.files()
        return {"file": files[-1], "line": self.lines_of(files[-1])} if files else {"file": "", "line": 0}

    def partitions(self, start: dict, end: dict) -> list[LinePartition]:
        parts = []
        for file in self.files():
            if start["file"] <= file <= end["file"]:
                first = start["line"] if file == start["file"] else 0
                last = end["line"] if file == end["file"] else None
                if last is None or first < last:
                    parts.append(LinePartition(file, first, last))
        return parts

    def read(self, partition: LinePartition) -> Iterator[pa.RecordBatch]:
        store, root = file_system(self.path)
        with store.open_input_stream(f"{root}/{partition.file}") as data:
            rows, number, rest = [], 0, b""
            while block := data.read(BYTES):
                *whole, rest = (rest + block).split(b"\n")
                for line in whole:
                    if partition.last is not None and number >= partition.last:
                        break
                    if number >= partition.first:
                        rows.append(line)
                    number += 1
                while len(rows) >= LINES:
                    yield self.batch(rows[:LINES])
                    rows = rows[LINES:]
            if rest and partition.last is None and number >= partition.first:
                rows.append(rest)
            if rows:
                yield self.batch(rows)

    @staticmethod
    def batch(rows: list[bytes]) -> pa.RecordBatch:
        texts = [row.removesuffix(b"\r").decode(errors="replace") for row in rows]
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])

    def commit(self, end: dict) -> None:
        if self.stored:
            store, path = file_system(self.stored)
            with store.open_output_stream(f"{path}.new") as out:
                out.write(json.dumps(end).encode())
            store.move(f"{path}.new", path)


class LogLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_lines"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> LogLineReader:
        return LogLineReader({key.lower(): value for key, value in self.options.items()})


def stream_log_lines(
    spark: SparkSession, path: str, starting_offsets: dict | None = None, offsets: str | None = None
) -> DataFrame:
    """Log lines of the files below ``path``, from ``starting_offsets``, the offset stored in ``offsets``, or the newest line on."""
    # Python processes of Spark need not find this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LogLines)
    reader = spark.readStream.format("log_lines").option("path", path)
    if starting_offsets:
        reader = reader.option("startingOffsets", json.dumps(starting_offsets))
    if offsets:
        reader = reader.option("offsets", offsets)
    return reader.load()
