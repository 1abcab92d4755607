"""Token ids in raw binary shards, with a minimal perfect hash index from document keys to their places.

A store is a folder:

* ``ids/shard-….ids``: the ids of documents in ascending key order as little-endian unsigned numbers, nothing
  between them, of ``width`` bytes: 2 if the vocabulary allows it, else 4. A document is its text's ids and the
  end id. ``ids/shard-….len``: how many ids each document has, as 32-bit numbers.
* ``shards`` (Parquet): the shards' files, ``width``, and what all earlier shards hold: ``first_document``, ``first_id``.
* ``index/bucket-….mph``: for the keys of a bucket (by hash) a minimal perfect hash function and its table.
* ``buckets`` (Parquet): the buckets' files, and how many buckets there are.

The hash function has levels of bits. A key that falls alone on a bit of the first level owns that bit, the
others try the next level; the number of bits set before a key's own is its row in the table. A row holds the
key's 64-bit fingerprint, by which an absent key is told, and the place: shard, offset of the first id there,
number of the document, and how many documents have the key. A lookup thus reads about two bits and one row, whatever
the size of the store. Buckets grow with the square root of the keys, as does their number.

Documents are sorted by range partitions of about ``SHARD_BYTES`` of text, one shard a task. A task writes
files of a name of its own, and the tables, written afterwards, only name files of tasks that succeeded: a
task that is lost and repeated leaves a file nobody reads.

A null or empty text is the end id alone. Documents of one key are neighbours, in the order of the rows; many
of them are several shards' work in writing and in reading, and one row of the index. A null key is a key, and
the first. An empty table is an empty store; other columns are not used. Two keys with the same 128 bits of
hash (a chance of 1e-19 among 1e10 keys) would be refused, by an error.
"""

from __future__ import annotations

import itertools
import math
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtally.llm.common import python_tasks, worker_cache
from adtally.llm.hashing import mixed
from adtally.llm.packing import _PLAIN, REMEMBERED, REMEMBERED_PARTS, _Chunks
from adtally.session import materialize, scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_BYTES = 32 << 20
#: Bits of a level for each key that is left, and bits between two stored counts.
ROOM, COUNTED = 2, 512
#: Levels after which two keys are taken to be the same; a key needs so many with a chance under 1e-80.
LEVELS = 200
#: Keys of a bucket, as a multiple of the square root of all.
KEYS = 8
#: Documents and bytes of a batch that a reading task gives out.
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20

MAGIC = b"MPHIDX01"
ROW = np.dtype([("fingerprint", "<u8"), ("shard", "<u4"), ("last", "<u4"), ("document", "<u8"), ("offset", "<u8"), ("copies", "<u8")])


def file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder that Spark names, for Python tasks."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return pa.fs.FileSystem.from_uri(folder)


class HashFunction:
    """Minimal perfect: a bijection from ``n`` keys, given as two 64-bit hashes, to 0 … n - 1."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.cumsum(sizes) - sizes
        ones = np.bitwise_count(bits).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)[COUNTED // 8 - 1::COUNTED // 8]))

    @staticmethod
    def place(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(one + two * np.uint64(2 * level + 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, one: np.ndarray, two: np.ndarray) -> HashFunction:
        sizes, levels = [], []
        while len(one):
            if len(sizes) == LEVELS:
                raise ValueError("two keys have the same hash")
            size = -(-ROOM * len(one) // 8) * 8
            at = cls.place(one, two, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little"))
            rest = ~alone[at]
            one, two = one[rest], two[rest]
        return cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, np.uint8), *levels]))

    def __call__(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The number of each key; of one that was not given to ``of`` any number, or -1."""
        found, left = np.full(len(one), -1), np.arange(len(one))
        for level, (start, size) in enumerate(zip(self.starts.tolist(), self.sizes.tolist(), strict=True)):
            at = start + self.place(one[left], two[left], level, size)
            own = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            found[left[own]] = self.rank(at[own])
            left = left[~own]
        return found

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many bits are set before each place: the stored count, then those of the bytes since."""
        block = at // COUNTED
        since = block[:, None] * (COUNTED // 8) + np.arange(COUNTED // 8)[None, :]
        byte = (at >> 3)[:, None]
        whole = np.where(since < byte, self.bits[np.minimum(since, len(self.bits) - 1)], 0)
        partly = self.bits[at >> 3] & ((np.uint8(1) << (at & 7).astype(np.uint8)) - np.uint8(1))
        return self.before[block] + np.bitwise_count(whole).sum(1) + np.bitwise_count(partly)


def bucket_bytes(function: HashFunction, rows: np.ndarray) -> bytes:
    head = np.array([len(function.sizes), len(function.bits), len(rows)], "<u8")
    return MAGIC + head.tobytes() + function.sizes.astype("<u8").tobytes() + function.bits.tobytes() + rows.tobytes()


def read_bucket(data: bytes) -> tuple[HashFunction, np.ndarray]:
    if data[:8] != MAGIC:
        raise ValueError("no index bucket")
    levels, bits, n = np.frombuffer(data, "<u8", 3, 8).tolist()
    sizes = np.frombuffer(data, "<u8", levels, 32).astype(np.int64)
    at = 32 + 8 * levels
    return HashFunction(sizes, np.frombuffer(data, np.uint8, bits, at)), np.frombuffer(data, ROW, n, at + bits)


class Vocabulary(_Chunks):
    """The packing's table of chunks, with the new words of a whole batch encoded by one call."""

    def __init__(self, tokenizer):
        super().__init__(tokenizer)
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.fresh: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.fresh.get(chunk)
        return super().__missing__(chunk) if ids is None else ids

    def learn(self, texts: list[list[str]]) -> None:
        """Ids of the chunks not met so far that are a plain word and marks; those beyond what is remembered are
        kept for this batch. New words are encoded joined by blanks, since each ends with a word-ending id."""
        self.fresh, plain = {}, []
        for chunk in set().union(*texts).difference(self):
            if chunk[0] != "<" and (match := _PLAIN.fullmatch(chunk.lower())):
                plain.append((chunk, *match.groups()))
        words = list({word for _, word, _ in plain}.difference(self.parts))
        joined = self.encode(" ".join(words))
        ends = (4 * np.flatnonzero(self.ends_word[np.frombuffer(joined, "<u4")]) + 4).tolist()
        if len(ends) != len(words):
            return
        new = {word: joined[start:end] for word, start, end in zip(words, [0, *ends], ends, strict=False)}
        self.parts.update(itertools.islice(new.items(), max(0, REMEMBERED_PARTS - len(self.parts))))
        room = REMEMBERED - len(self)
        for at, (chunk, word, marks) in enumerate(plain):
            (self if at < room else self.fresh)[chunk] = (new.get(word) or self.parts[word]) + self.part(marks)

    def documents(self, texts: list[str | None], end: int) -> Iterator[bytes]:
        """The ids of every text with the end id behind them, ``width`` bytes each."""
        split = [(text or "").replace("\n", " ").split(" ") for text in texts]
        self.learn(split)
        last = end.to_bytes(4, "little")
        for chunks in split:
            own = b"".join(map(self.__getitem__, chunks)) + last
            yield own if self.width == 4 else np.frombuffer(own, "<u4").astype("<u2").tobytes()


def vocabulary_of(path: str | None) -> Vocabulary:
    """A Python worker keeps it."""
    loaded, key = worker_cache("token-store"), path or ""
    if key not in loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        loaded[key] = Vocabulary(Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER)))
    return loaded[key]


def _hashes(key: str) -> list:
    text = F.col(key).cast("string")
    return [F.xxhash64(text).alias("one"), F.xxhash64(text, F.lit(1)).alias("two")]


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def write_shards(documents: DataFrame, folder: str, key: str, tokenizer: str | None, end: int, shard_bytes: int) -> DataFrame:
    """Write the shards; the stored places (one, two, shard, file, width, document, offset, n) of all documents in them."""
    rows = documents.select(F.col(key).alias("key"), "text", F.monotonically_increasing_id().alias("row"))
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = rows.repartitionByRange(max(1, math.ceil(size / shard_bytes)), "key", "row").sortWithinPartitions("key", "row")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(tokenizer)
        store, root = file_system(folder)
        shard, n, offset = TaskContext.get().partitionId(), 0, 0
        file = f"shard-{shard:07d}-{uuid.uuid4().hex}"
        payload = lengths = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if payload is None:
                store.create_dir(f"{root}/ids", recursive=True)
                payload = store.open_output_stream(f"{root}/ids/{file}.ids")
                lengths = store.open_output_stream(f"{root}/ids/{file}.len")
            sizes = []
            for own in vocabulary.documents(batch.column(2).to_pylist(), end):
                payload.write(own)
                sizes.append(len(own) // vocabulary.width)
            sizes = np.array(sizes, np.int64)
            lengths.write(sizes.astype("<u4").tobytes())
            more = len(sizes)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([shard] * more, pa.int32()), pa.array([file] * more, pa.string()),
                pa.array([vocabulary.width] * more, pa.int32()), pa.array(np.arange(n, n + more)),
                pa.array(offset + np.cumsum(sizes) - sizes), pa.array(sizes),
            ], ["one", "two", "shard", "file", "width", "document", "offset", "n"])
            n, offset = n + more, offset + int(sizes.sum())
        if payload is not None:
            payload.close()
            lengths.close()

    schema = "one bigint, two bigint, shard int, file string, width int, document bigint, offset bigint, n bigint"
    return materialize(dealt.select(*_hashes("key"), "text").mapInArrow(write, schema), "places")


def write_index(places: DataFrame, shards: DataFrame, folder: str) -> DataFrame:
    """Write the index of all keys; (bucket, file, keys, buckets) of every bucket."""
    numbered = places.join(shards.select("shard", "first_document"), "shard").withColumn("document", F.col("first_document") + F.col("document"))
    place = F.struct("document", "shard", "offset")
    keys = numbered.groupBy("one", "two").agg(F.min(place).alias("place"), F.max("shard").alias("last"), F.count("*").alias("copies"))
    keys = materialize(keys.select("one", "two", "place.*", "last", "copies"), "keys")
    buckets = max(1, math.ceil(math.sqrt(keys.count()) / KEYS))

    def build(table: pa.Table) -> pa.Table:
        store, root = file_system(folder)
        one, two = _unsigned(table.column("one")), _unsigned(table.column("two"))
        function = HashFunction.of(one, two)
        rows = np.zeros(len(one), ROW)
        at = function(one, two)
        rows["fingerprint"][at] = two
        for name in ("shard", "last", "document", "offset", "copies"):
            rows[name][at] = table.column(name).to_numpy()
        bucket = table.column("bucket")[0].as_py()
        file = f"bucket-{bucket:07d}-{uuid.uuid4().hex}"
        store.create_dir(f"{root}/index", recursive=True)
        with store.open_output_stream(f"{root}/index/{file}.mph") as out:
            out.write(bucket_bytes(function, rows))
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "file": [file], "keys": [len(one)], "buckets": pa.array([buckets], pa.int32())})

    dealt = keys.withColumn("bucket", F.pmod("one", F.lit(buckets)).cast("int"))
    return dealt.groupBy("bucket").applyInArrow(build, "bucket int, file string, keys bigint, buckets int")


def write_store(
    documents: DataFrame, folder: str, key: str = "doc_id", tokenizer: str | None = None, end: int = END_ID, shard_bytes: int = SHARD_BYTES
) -> None:
    """Write all documents into a new store in ``folder``, which every executor can reach."""
    python_tasks(documents.sparkSession)
    places = write_shards(documents, folder, key, tokenizer, end, shard_bytes)
    each = places.groupBy("shard").agg(
        F.first("file").alias("file"), F.first("width").alias("width"), F.count("*").alias("documents"), F.sum("n").alias("ids")
    )
    # One row per shard.
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda n: F.coalesce(F.sum(n).over(earlier), F.lit(0))
    each.withColumn("first_document", before("documents")).withColumn("first_id", before("ids")).write.parquet(f"{folder}/shards")
    shards = documents.sparkSession.read.parquet(f"{folder}/shards")
    write_index(places, shards, folder).write.parquet(f"{folder}/buckets")


def find(spark: SparkSession, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, shard, last, document, offset, copies) of the keys that the store holds; equal keys count once."""
    python_tasks(spark)
    buckets = spark.read.parquet(f"{folder}/buckets")
    some = buckets.first()
    kind = dict(keys.dtypes)[key]
    asked = keys.select(F.col(key).alias("key")).distinct().select("key", *_hashes("key"))
    asked = asked.withColumn("bucket", F.pmod("one", F.lit(some["buckets"] if some else 1)).cast("int"))
    asked = asked.join(buckets.select("bucket", "file"), "bucket").repartition("bucket").sortWithinPartitions("bucket")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        opened, function, rows = None, None, None
        for batch in batches:
            files = batch.column(3).to_pylist()
            at = 0
            for file, same in itertools.groupby(files):
                n = len(list(same))
                if file != opened:
                    with store.open_input_stream(f"{root}/index/{file}.mph") as data:
                        function, rows = read_bucket(data.read())
                    opened = file
                part = batch.slice(at, n)
                at += n
                one, two = _unsigned(part.column(1)), _unsigned(part.column(2))
                number = function(one, two)
                there = np.flatnonzero((number >= 0) & (rows["fingerprint"][number] == two))
                held = rows[number[there]]
                columns = [part.column(0).take(pa.array(there))]
                columns += [pa.array(held[name].astype(np.int64)) for name in ROW.names[1:]]
                yield pa.RecordBatch.from_arrays(columns, ["key", *ROW.names[1:]])

    found = asked.select("key", "one", "two", "file")
    return found.mapInArrow(look, f"key {kind}, shard bigint, last bigint, document bigint, offset bigint, copies bigint")


def lookup(spark: SparkSession, folder: str, keys: DataFrame, key: str = "doc_id", ids: bool = True) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document with one of the keys, read from the shards.

    ``start`` counts the ids of all documents before it in the store; ``ids`` are 32-bit numbers.
    """
    found = find(spark, folder, keys, key)
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "file", "width", "documents", "first_document", "first_id")
    each = found.select("key", "document", "offset", "copies", F.explode(F.sequence("shard", "last")).alias("in"))
    each = each.join(shards.withColumnRenamed("shard", "in"), "in")
    low = F.greatest("document", "first_document")
    high = F.least(F.col("document") + F.col("copies"), F.col("first_document") + F.col("documents"))
    parts = each.select(
        "key", "in", "file", "width", "first_id", (low - F.col("first_document")).alias("at"), (high - low).alias("n"),
        F.when(F.col("document") >= F.col("first_document"), F.col("offset")).otherwise(0).alias("offset"),
    ).where("n > 0").repartition("in").sortWithinPartitions("in", "at").drop("in")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        opened, payload, lengths = None, None, None
        for batch in batches:
            row, starts, sizes, sums, held, size = [], [], [], [], [], 0

            def given() -> pa.RecordBatch:
                columns = [batch.column(0).take(pa.array(row, pa.int64()))]
                columns += [pa.array(values, pa.int64()) for values in (starts, sizes, sums)]
                names = ["key", "start", "n_tokens", "ids_crc32"]
                if ids:
                    columns, names = [*columns, pa.array(held, pa.binary())], [*names, "ids"]
                return pa.RecordBatch.from_arrays(columns, names)

            columns = (batch.column(i).to_pylist() for i in range(1, 7))
            for number, (file, width, first, at, n, offset) in enumerate(zip(*columns, strict=True)):
                if file != opened:
                    if payload is not None:
                        payload.close()
                    payload = store.open_input_file(f"{root}/ids/{file}.ids")
                    with store.open_input_stream(f"{root}/ids/{file}.len") as data:
                        lengths = np.frombuffer(data.read(), "<u4")
                    opened = file
                for tokens in lengths[at:at + n].tolist():
                    own = payload.read_at(width * tokens, width * offset)
                    own = own if width == 4 else np.frombuffer(own, "<u2").astype("<u4").tobytes()
                    row.append(number)
                    starts.append(first + offset)
                    sizes.append(tokens)
                    sums.append(zlib.crc32(own))
                    offset += tokens
                    if ids:
                        held.append(own)
                        size += len(own)
                    if len(row) == BATCH_ROWS or size > BATCH_BYTES:
                        yield given()
                        row, starts, sizes, sums, held, size = [], [], [], [], [], 0
            yield given()
        if payload is not None:
            payload.close()

    schema = f"key {dict(found.dtypes)['key']}, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if ids else "")
    return parts.mapInArrow(read, schema).withColumnRenamed("key", key)


def store_report(documents: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document: written into a store, then looked up by its key."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "token-store")
    write_store(documents, folder)
    return lookup(spark, folder, documents.select("doc_id"), ids=False)
