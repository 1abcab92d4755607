"""Packing into sequences by Karmarkar-Karp multiway differencing.

A document's ids are its text's ids and the end id. Every full ``CAPACITY`` of them is a sequence of
its own; what remains is one piece, save that one document in ``CHANGE_ONE_IN`` (by the checksum of
its ids) gives its remainder in pieces of ``CHANGE``: small change that evens windows out.

Pieces are dealt out by hash, and each task packs them in blocks of ``BLOCK``. In a block every piece
starts as a partition of ``k`` windows of which one is filled. The two partitions with the largest
difference between fullest and emptiest window are merged, the fullest windows of one with the
emptiest of the other, until one partition is left: ``k`` near-equal windows. ``k`` starts just above
the number that the ids need, and rises as long as the fullest window exceeds the capacity.

Ids come from the tokenizer alone. A text is encoded by its blank-separated chunks, which never
share an id; each task remembers the ids of the chunks it met first, up to a bound, and asks the tokenizer
anew for others.

A null or empty text is the end id alone. A repeated row is packed as often as it occurs; other
columns are not used. No task holds more than two blocks, whatever the sizes of texts or groups.
"""

from __future__ import annotations

import heapq
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import python_tasks, worker_cache
from adtally.session import materialize

CAPACITY = 4096
END_ID = 2
CHANGE, CHANGE_ONE_IN = 256, 8
BLOCK = 2048
#: Chunks, and words and marks that chunks are made of, whose ids a task remembers (about 280 MB when full).
REMEMBERED, REMEMBERED_PARTS = 500_000, 900_000
TOKENIZER = "word_bpe_49k.json"

#: A word of letters that have one form only, then ASCII marks other than the apostrophe.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PIECES = "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class _Chunks(dict):
    """Ids of a chunk as little-endian 32-bit numbers."""

    def __init__(self, tokenizer):
        super().__init__({"": b""})
        self.tokenizer, self.parts = tokenizer, {"": b""}

    def encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def part(self, text: str) -> bytes:
        ids = self.parts.get(text)
        if ids is None:
            ids = self.encode(text)
            if len(self.parts) < REMEMBERED_PARTS:
                self.parts[text] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        plain = _PLAIN.fullmatch(chunk.lower()) if chunk[0] != "<" else None
        ids = self.part(plain[1]) + self.part(plain[2]) if plain else self.encode(chunk)
        if len(self) < REMEMBERED:
            self[chunk] = ids
        return ids


def chunks_of(path: str | None) -> _Chunks:
    """The chunk table of a tokenizer file; a Python worker keeps it."""
    loaded, key = worker_cache("packing"), path or ""
    if key not in loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        loaded[key] = _Chunks(Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER)))
    return loaded[key]


def document_ids(text: str | None, chunks: _Chunks) -> bytes:
    return b"".join(map(chunks.__getitem__, (text or "").replace("\n", " ").split(" "))) + END_ID.to_bytes(4, "little")


def cuts(tokens: int, checksum: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    whole = [(at, capacity) for at in range(0, tokens - capacity + 1, capacity)]
    at, rest = len(whole) * capacity, tokens % capacity
    size = CHANGE if checksum % CHANGE_ONE_IN == 0 else capacity
    return whole + [(start, min(size, tokens - start)) for start in range(at, at + rest, size)]


def pieces(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) of every piece of every document."""
    python_tasks(documents.sparkSession)
    rows = documents.select("doc_id", "text")
    schema = _PIECES.format(id=dict(rows.dtypes)["doc_id"]) + (", ids binary" if ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_of(tokenizer)
        for batch in batches:
            row, starts, lengths, sums, totals, held = [], [], [], [], [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                own = document_ids(text, chunks)
                tokens = len(own) // 4
                for start, length in cuts(tokens, zlib.crc32(own), capacity):
                    part = own[4 * start:4 * (start + length)]
                    row.append(at)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(part))
                    totals.append(tokens)
                    if ids:
                        held.append(part)
            columns = [batch.column(0).take(pa.array(row, pa.int64()))]
            columns += [pa.array(values, pa.int64()) for values in (starts, lengths, sums, totals)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if ids:
                columns, names = [*columns, pa.array(held, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(cut, schema)


def differenced(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece after multiway differencing."""
    n = len(lengths)
    merged = n
    heap = []
    for at in np.argsort(-lengths, kind="stable").tolist():
        sums, nodes = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], nodes[0] = lengths[at], at
        heap.append((-int(lengths[at]) if windows > 1 else 0, len(heap), sums, nodes))
    heapq.heapify(heap)
    links, made = [], n
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other, theirs = heapq.heappop(heap)
        sums, theirs = sums + other[::-1], theirs[::-1]
        both = np.flatnonzero((nodes >= 0) & (theirs >= 0))
        fresh = np.arange(merged, merged + len(both))
        links.append((nodes[both], fresh))
        links.append((theirs[both], fresh))
        merged += len(both)
        nodes = np.maximum(nodes, theirs)
        nodes[both] = fresh
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        made += 1
        heapq.heappush(heap, (int(sums[-1] - sums[0]), made, sums, nodes))
    parent = np.arange(merged)
    for children, above in links:
        parent[children] = above
    while (parent[parent] != parent).any():
        parent = parent[parent]
    window_of = np.full(merged, -1, np.int64)
    last = heap[0][3]
    window_of[last[last >= 0]] = np.flatnonzero(last >= 0)
    return window_of[parent[:n]]


def packed_block(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each piece; as few windows as differencing can fill without excess."""
    total = int(lengths.sum())
    windows = max(1, math.ceil(total / capacity * (1.003 if total > 50 * capacity else 1)))
    while True:
        window_of = differenced(lengths, windows)
        excess = np.maximum(np.bincount(window_of, lengths, windows) - capacity, 0).sum()
        if not excess:
            return window_of
        windows += max(1, int(excess // capacity))


def packed(cut: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """Add sequence_id and offset to stored pieces."""
    total = cut.count()
    by = F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens")
    dealt = cut.repartition(max(1, total // (8 * block)), by).sortWithinPartitions(by, "doc_id", "start", "ids_crc32", "doc_tokens")
    at = cut.columns.index("length")
    types = ", ".join(f"`{name}` {kind}" for name, kind in cut.dtypes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        rows = 0

        def of(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal first
            lengths = table.column(at).to_numpy()
            window_of, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            whole = lengths == capacity
            window_of[whole] = np.arange(whole.sum())
            if not whole.all():
                window_of[~whole] = packed_block(lengths[~whole], capacity) + whole.sum()
            order = np.argsort(window_of, kind="stable")
            before = np.cumsum(lengths[order]) - lengths[order]
            fresh = np.concatenate(([True], np.diff(window_of[order]) > 0))
            offsets[order] = before - before[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
            ids = pa.array(first + window_of)
            first += int(window_of.max()) + 1
            yield from table.append_column("sequence_id", ids).append_column("offset", pa.array(offsets)).combine_chunks().to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            while rows >= 2 * block:
                table = pa.Table.from_batches(held)
                yield from of(table.slice(0, block))
                held, rows = table.slice(block).to_batches(), rows - block
        if rows:
            yield from of(pa.Table.from_batches(held))

    return dealt.mapInArrow(pack, f"{types}, sequence_id bigint, offset bigint")


def packed_documents(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """The pieces of all documents with their places: (…, sequence_id, offset)."""
    return packed(materialize(pieces(documents, tokenizer, capacity, ids), "pieces"), capacity)


def token_sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of pieces that carry their ids; ids are little-endian 32-bit numbers."""
    parts = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    joined = F.aggregate("parts", F.lit(b""), lambda sofar, part: F.concat(sofar, part["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))
