"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all items scans each text once.

Texts are lower-cased (A-Z) and cut into words: runs of digits, letters and characters beyond ASCII.
A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one
window. The automaton holds every window between blanks, so a match in the normalised text begins
and ends at words; the place of its last blank gives the words it covers, and they map to code
points of the original text.

The windows reach the driver in shards of about ``SHARD_CHARS`` characters, and each shard is
broadcast: the bound is on the shard, so a larger benchmark makes more passes over the stored texts
and no larger automaton. Benchmarks of usual size make one.

A null text or item has no words; an item with a null id takes no part. A repeated document row
gives a repeated row; a repeated item or one id on several texts counts once. Very long texts are
scanned whole. Other columns are not used.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import columns_of, numbered, own_prefix, python_tasks, raw_texts, worker_cache
from adtally.session import materialize

WINDOW = 10
SHARD_CHARS = 2_000_000

#: Word bytes stay, A-Z become small, all other ASCII becomes a blank. Bytes beyond ASCII are word bytes.
_KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_HITS = "array<struct<word:int,start:int,end:int>>"


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_KEEP).split()


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (window, item) of all items, the item's id as text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for item, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
                w = words(text)
                for at in range(max(1, len(w) - size + 1) if w else 0):
                    found.append(b" ".join(w[at:at + size]).decode())
                    ids.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(ids, pa.string())], ["window", "item"])

    named = items.where("item_id is not null").select(F.col("item_id").cast("string").alias("item"), "text")
    return named.mapInArrow(cut, "window string, item string").distinct()


def _automaton(key: str, rows: list[tuple[str, str]]) -> ahocorasick.Automaton:
    """The shard's automaton; a Python worker keeps the last one it built."""
    built = worker_cache("decontamination")
    if key not in built:
        held: dict[str, list[str]] = {}
        for window, item in rows:
            held.setdefault(window, []).append(item)
        machine = ahocorasick.Automaton()
        for window, items in held.items():
            machine.add_word(f" {window.encode().decode('latin-1')} ", (window.count(" ") + 1, items))
        machine.make_automaton()
        built.clear()
        built[key] = machine
    return built[key]


def _scan(machine: ahocorasick.Automaton, text: bytes | None) -> tuple[int, list[tuple[int, int, int]], list[str]]:
    """Number of words, the hit words with their code points, the items whose windows occur."""
    w = words(text)
    if not w or not len(machine):
        return len(w), [], []
    line = b" " + b" ".join(w) + b" "
    matches = list(machine.iter(line.decode("latin-1")))
    if not matches:
        return len(w), [], []
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    ends = np.searchsorted(blanks, np.fromiter((end for end, _ in matches), np.int64, len(matches)))
    lengths = np.fromiter((n for _, (n, _) in matches), np.int64, len(matches))
    covered = np.zeros(len(w) + 1, np.int64)
    np.add.at(covered, ends - lengths, 1)
    np.add.at(covered, ends, -1)
    hit = np.flatnonzero(np.cumsum(covered)[:-1])
    raw = np.frombuffer(text, np.uint8)
    inside = np.concatenate(([False], np.frombuffer(text.translate(_KEEP), np.uint8) != 32, [False]))
    starts, stops = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
    point = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    found = list(zip(hit.tolist(), point[starts[hit]].tolist(), point[stops[hit]].tolist(), strict=True))
    return len(w), found, sorted({item for _, (_, items) in matches for item in items})


def _scanned(documents: DataFrame, rows: list[tuple[str, str]], keep_text: bool = False) -> DataFrame:
    """Add n_words, hits and items of one shard; the columns of ``documents`` stay, the text on demand."""
    own = own_prefix(documents)
    sent, key = documents.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex
    at = documents.columns.index("text")
    kept = [i for i in range(len(documents.columns)) if keep_text or i != at]
    hits_type = pa.list_(pa.struct([("word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(key, sent.value)
        for batch in batches:
            n, hits, items = [], [], []
            for text in raw_texts(batch.column(at)):
                count, found, names = _scan(machine, text)
                n.append(count)
                hits.append([{"word": a, "start": b, "end": c} for a, b, c in found])
                items.append(names)
            arrays = [batch.column(i) for i in kept]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(n, pa.int64()), pa.array(hits, hits_type), pa.array(items, pa.list_(pa.string()))],
                [*(batch.schema.names[i] for i in kept), "words", "hits", "items"],
            )

    plain, _ = numbered(documents)
    kinds = [kind for _, kind in documents.dtypes]
    schema = ", ".join([*(f"c{i} {kinds[i]}" for i in kept), "words bigint", f"hits {_HITS}", "items array<string>"])
    found = plain.mapInArrow(scan, schema)
    return found.toDF(*(documents.columns[i] for i in kept), f"{own}words", f"{own}hits", f"{own}items")


def contamination(documents: DataFrame, items: DataFrame, size: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(doc_id, n_words, hits, items) of every document.

    ``hits`` has each hit word once: its number and its code points (end exclusive) in the original text.
    """
    python_tasks(documents.sparkSession)
    shards = _shards(items, size, shard_chars)
    if len(shards) == 1:
        found = _scanned(documents.select("doc_id", "text"), _rows(shards[0]))
        return found.toDF("doc_id", "n_words", "hits", "items")
    rows = materialize(documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "numbered-texts")
    parts = [materialize(_scanned(rows, _rows(shard)), "shard-hits") for shard in shards]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    merged = united.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("items"),
    )
    return merged.drop("row")


def _shards(items: DataFrame, size: int, shard_chars: int) -> list[DataFrame]:
    """The windows in parts of about ``shard_chars`` characters each, at least one."""
    cut = materialize(windows(items, size), "benchmark-windows")
    chars = cut.agg(F.sum(F.length("window") + F.length("item"))).first()[0] or 0
    n = max(1, math.ceil(chars / shard_chars))
    own = F.pmod(F.xxhash64("window", "item"), F.lit(n))
    return [cut.where(own == at) for at in range(n)]


def _rows(shard: DataFrame) -> list[tuple[str, str]]:
    return [tuple(row) for row in shard.collect()]


def contamination_report(documents: DataFrame, items: DataFrame) -> DataFrame:
    found = contamination(documents, items)
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def clean_documents(documents: DataFrame, items: DataFrame, size: int = WINDOW, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The documents without any hit word, with all their columns; a row is judged by its own text."""
    python_tasks(documents.sparkSession)
    shards = _shards(items, size, shard_chars)
    for at, shard in enumerate(shards):
        found = _scanned(documents, _rows(shard), keep_text=True)
        documents = found.where(F.size(f"{own_prefix(documents)}hits") == 0).select(*columns_of(documents))
        if at + 1 < len(shards):
            documents = materialize(documents, "cleaned-of-shards")
    return documents


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS k, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS t
  FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - {WINDOW - 2}))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
grams AS (
  SELECT rid, i, k, array_to_string(w[i:i + k - 1], ' ') AS t
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT rid, i, k, item FROM grams JOIN win USING (k, t)),
hit AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS place FROM found) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
