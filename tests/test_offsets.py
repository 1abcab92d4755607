"""The stream that starts from stored offsets, JSON schemas, and limits."""

import json
import os

import pytest

from adtally.sources.logs import inferred_json_rows, inferred_schema, stream_file_lines
from adtally.sources.offsets import LogLineReader, stream_log_lines
from adtally.streaming.rates import BatchRows


def put(path, name, text):
    os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
    with open(f"{path}/{name}", "a") as file:
        file.write(text)


def run(spark, logs, out, start=None, offsets=None, checkpoint="state"):
    lines = stream_log_lines(spark, str(logs), start, offsets)
    writer = lines.writeStream.format("parquet").option("path", f"{out}/{checkpoint}-rows").option("checkpointLocation", f"{out}/{checkpoint}")
    writer.trigger(availableNow=True).start().awaitTermination()
    return sorted(r.value for r in spark.read.schema("value string").parquet(f"{out}/{checkpoint}-rows").collect())


def test_starts_within_a_file_and_goes_on(spark, tmp_path):
    logs, out = tmp_path / "logs", tmp_path / "out"
    put(logs, "h1/a.log", "a0\na1\na2\n")
    put(logs, "h2/b.log", "b0\nb1\nhalf")
    put(logs, "h2/.b.crc", "x\n")
    start = {"file": "h1/a.log", "line": 1}
    assert run(spark, logs, out, start) == ["a1", "a2", "b0", "b1"]
    put(logs, "h2/b.log", " more\nb3\n")
    put(logs, "h3/c.log", "c0\r\n\nc2\nopen")
    # The checkpoint knows where to go on; the line that was open is read once, whole.
    assert run(spark, logs, out, start) == sorted(["a1", "a2", "b0", "b1", "half more", "b3", "c0", "", "c2"])


def test_starts_at_the_newest_line_or_where_an_offset_is_stored(spark, tmp_path):
    logs, out = tmp_path / "logs", tmp_path / "out"
    put(logs, "a.log", "a0\na1\n")
    assert run(spark, logs, out, checkpoint="new") == []
    put(logs, "b.log", "b0\n")
    assert run(spark, logs, out, checkpoint="new") == ["b0"]
    stored = f"{tmp_path}/offset.json"
    with open(stored, "w") as file:
        json.dump({"file": "a.log", "line": 1}, file)
    assert run(spark, logs, out, offsets=stored, checkpoint="from-stored") == ["a1", "b0"]


def test_offsets_and_partitions_of_a_reader(tmp_path):
    reader = LogLineReader({"path": str(tmp_path / "none")})
    assert reader.initialOffset() == {"file": "", "line": 0} == reader.latestOffset()
    for name, n in (("a", 3), ("b", 25_001), ("c", 2)):
        put(tmp_path, name, "".join(f"{name}{i}\n" for i in range(n)))
    reader = LogLineReader({"path": str(tmp_path), "offsets": f"{tmp_path}/_offset"})
    assert reader.latestOffset() == {"file": "c", "line": 2}
    parts = reader.partitions({"file": "a", "line": 2}, {"file": "c", "line": 1})
    assert [(p.file, p.first, p.last) for p in parts] == [("a", 2, None), ("b", 0, None), ("c", 0, 1)]
    rows = [[v for batch in reader.read(p) for v in batch.column(0).to_pylist()] for p in parts]
    assert rows == [["a2"], [f"b{i}" for i in range(25_001)], ["c0"]]
    assert reader.partitions({"file": "c", "line": 2}, {"file": "c", "line": 2}) == []
    reader.commit({"file": "b", "line": 9})
    assert reader.initialOffset() == {"file": "b", "line": 9}


JSON = ['{"a":1,"b":"x"}', '{"a":2.5,"c":{"d":[1,2]}}', '{"a":3,"b":4}', "no json", "[1]", None, '{"n":null}', '{"c":{"d":["t"],"e":true}}']


def test_schema_does_not_depend_on_partitions(spark):
    lines = spark.createDataFrame([(t,) for t in JSON], "value string")
    schemas = {inferred_schema(lines.repartition(n)).simpleString() for n in (1, 2, 7)}
    assert schemas == {"struct<a:decimal(21,1),b:string,c:struct<d:array<string>,e:boolean>,n:string>"}
    rows = inferred_json_rows(lines).collect()
    assert sorted((float(r.a), r.b) for r in rows if r.a is not None) == [(1.0, "x"), (2.5, None), (3.0, "4")]
    assert len(rows) == len(JSON) and sorted(str(r.c.d) for r in rows if r.c) == ["['1', '2']", "['t']"]
    nothing = spark.createDataFrame([("x",), (None,)], "value string")
    assert inferred_schema(nothing).fields == [] and inferred_json_rows(nothing).columns == []


def test_a_stream_is_limited_by_files_or_bytes(spark, tmp_path):
    for n in range(4):
        put(tmp_path / "logs", f"{n}.log", f"line {n}\n" * 10)
    listener = BatchRows()
    spark.streams.addListener(listener)
    try:
        for limit in ({"max_files_per_trigger": 1}, {"max_bytes_per_trigger": 150}):
            lines = stream_file_lines(spark, f"{tmp_path}/logs", **limit)
            name = next(iter(limit))
            query = lines.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
            query.awaitTermination()
            progress = [p for p in query.recentProgress if p.numInputRows]
            assert [p.numInputRows for p in progress] == ([10] * 4 if name == "max_files_per_trigger" else [20, 20])
    finally:
        spark.streams.removeListener(listener)
    with pytest.raises(ValueError):
        stream_file_lines(spark, f"{tmp_path}/logs", 1, 1)


def test_the_listener_keeps_the_newest_batches():
    class Event:
        def __init__(self, batch, rows):
            self.progress = type("P", (), {"id": "q", "batchId": batch, "numInputRows": rows})

    listener = BatchRows(most=2)
    for batch, rows in ((0, 5), (1, 7), (1, 0), (2, 3)):
        listener.onQueryProgress(Event(batch, rows))
    assert listener.rows["q"] == {1: 7, 2: 3}


def test_first_lines_are_not_lost_in_lines_of_many_blocks(tmp_path):
    put(tmp_path, "a", "x" * 3_000_000 + "\nend\n")
    reader = LogLineReader({"path": str(tmp_path)})
    part, = reader.partitions({"file": "a", "line": 0}, reader.latestOffset())
    assert [len(v) for b in reader.read(part) for v in b.column(0).to_pylist()] == [3_000_000, 3]
