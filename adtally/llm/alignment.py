"""Alignment of two tokenizers' tokens by merge-path partitioning.

Tokens of A (byte-level BPE) and of B (pieces with byte fallback) cover the same bytes, so merging the sorted
ends of both gives everything: every distinct end closes one overlap of an A token with a B token, and an end
of both closes a group.

1. ``pieces``: tasks tokenize whole texts and lay the documents of a batch end to end. The merge of all A and B
   ends is cut at equally spaced diagonals; where a diagonal crosses the merge path is found by binary search.
   A piece is the ids between two crossings, one further id of each side, and its documents: equal work,
   whether it holds many short texts or a small part of a long one. Pieces are stored.
2. ``occurrences``: every piece finds its overlaps by itself and adds up, for its whole documents, in how many
   an id pair is linked. Documents that were cut contribute distinct (document, pair) rows. The sums over
   all pieces are the corpus counts, and the largest one of an A id marks its best pairs.
3. ``aligned``: each piece meets the counts of its own pairs (one row per piece, not one per link), and gives
   out sums and groups of its documents. Parts of cut documents are stitched: the group that a piece
   leaves open goes on with the one that the next piece begins with.

A pair that a third of all documents hold is one row per piece in step 2. No step holds more than a few
pieces, save the stitching of a document, which is as large as its text.

Texts that are null or empty, or whose joined tokens are not a blank and the text on either side, have no
tokens: zeros and an empty list of groups. Strings that look like special tokens are plain text. A null id
stays null, repeated rows count as documents of their own, and other columns are not used. An empty table
gives no rows.

A is encoded by its ranks where its file lists merges in the order of their ids, which gives the same ids several
times faster than its tokenizer; texts with very long runs of white space take the tokenizer.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import python_tasks, worker_cache
from adtally.session import materialize

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Ends of A and B in a piece.
WORK = 1 << 20
#: Documents of a batch, which are cut together.
ROWS = 512
#: Runs of white space whose split needs too deep a recursion for the encoder by ranks.
_LONG_BLANK = re.compile(r"\s{1000}")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


class Tokens:
    """Both tokenizers: ids of texts, bytes of ids, and what listing the groups needs."""

    def __init__(self, a_path: str | None, b_path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path or public_tokenizers.path(A_FILE))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path or public_tokenizers.path(B_FILE))
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.blank = self.b.piece_to_id("▁")
        self.a_size = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_size = np.array([len(b) for b in self.b_bytes], np.int64)
        self.a_type, self.b_type = ("<u2" if len(t) <= 1 << 16 else "<u4" for t in (self.a_bytes, self.b_bytes))
        self.ranks = self._by_ranks(a_path or public_tokenizers.path(A_FILE))

    def _by_ranks(self, path: str):
        """An encoder by ranks, if ids are in the order of the file's merges."""
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        in_order = [model["vocab"].get(a + b) for a, b in pairs] == list(range(256, 256 + len(pairs)))
        ranks = {self.a_bytes[i]: i for i in range(256 + len(pairs))} if in_order else {}
        if len(ranks) != 256 + len(pairs):
            return None
        return tiktoken.Encoding("by-ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> tuple[bytes, bytes] | None:
        """Ids of a text in A and B; None if it is empty or their bytes are not a blank and the text."""
        if not text:
            return None
        if self.ranks is None or _LONG_BLANK.search(text):
            a = self.a.encode(" " + text, add_special_tokens=False).ids
        else:
            a = self.ranks.encode_ordinary(" " + text)
        b = self.b.encode(text)
        wanted = (" " + text).encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != wanted or b"".join(map(self.b_bytes.__getitem__, b)) != wanted:
            return None
        return np.array(a, self.a_type).tobytes(), np.array(b, self.b_type).tobytes()

    def listed(self) -> list[str]:
        """Ids in decimal, with what may follow: A ids with ``,`` then with ``|``, B ids with ``,`` then with ``;``."""
        if not hasattr(self, "texts"):
            a, b = range(len(self.a_bytes)), range(len(self.b_bytes))
            self.texts = [f"{i}{mark}" for ids, marks in ((a, ",|"), (b, ",;")) for mark in marks for i in ids]
        return self.texts


def tokens_of(a_path: str | None, b_path: str | None) -> Tokens:
    """A Python worker keeps both tokenizers."""
    loaded, key = worker_cache("alignment"), (a_path, b_path)
    if key not in loaded:
        loaded[key] = Tokens(a_path, b_path)
    return loaded[key]


def crossings(a_ends: np.ndarray, b_ends: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many A ends are among the first so many of the merge (A first at equal ends), for all diagonals at once."""
    low, high = np.maximum(0, diagonals - len(b_ends)), np.minimum(diagonals, len(a_ends))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        a = a_ends[np.minimum(middle, len(a_ends) - 1)]
        b = b_ends[np.clip(diagonals - middle - 1, 0, len(b_ends) - 1)]
        first = open_ & (a <= b)
        low, high = np.where(first, middle + 1, low), np.where(open_ & ~first, middle, high)
    return low


def packed(ids: np.ndarray) -> bytes:
    """Ids as they are stored: compressed, since a piece is written, shuffled and read."""
    return pa.Codec("zstd", 3).compress(ids.tobytes(), asbytes=True) + len(ids).to_bytes(8, "little")


def unpacked(data: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(data[-8:], "little") * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data[:-8], size, codec="zstd", asbytes=True), kind)


_PIECE = (
    "piece bigint, a binary, b binary, a_own bigint, b_own bigint, a_from bigint, b_from bigint, "
    "docs array<struct<doc_id: {id}, row: bigint, end: bigint, part: int, parts: int, n_a: bigint, n_b: bigint>>"
)


def pieces(documents: DataFrame, tokenizers: tuple[str | None, str | None] = (None, None), work: int = WORK) -> DataFrame:
    """Stored pieces. Positions are bytes from where the first token of the piece starts; a document's ``end``
    is among them, and it has ``parts`` in so many pieces (0 without tokens)."""
    python_tasks(documents.sparkSession, ROWS)
    rows = documents.select("doc_id", "text")
    schema = _PIECE.format(id=dict(rows.dtypes)["doc_id"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(*tokenizers)
        task = TaskContext.get().partitionId()
        piece, row = task << 32, task << 40
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [tokens.ids(text) for text in batch.column(1).to_pylist()]
            held = np.flatnonzero([f is not None for f in found])
            ids = [[np.frombuffer(found[i][side], kind) for i in held] for side, kind in enumerate((tokens.a_type, tokens.b_type))]
            counts = np.zeros((2, len(found)), np.int64)
            counts[:, held] = [[len(part) for part in side] for side in ids]
            a, b = (np.concatenate([np.zeros(0, kind), *side]) for side, kind in zip(ids, (tokens.a_type, tokens.b_type), strict=True))
            a_ends, b_ends = tokens.a_size[a].cumsum(), tokens.b_size[b].cumsum()
            doc_ends = a_ends[counts[0, held].cumsum() - 1]
            n = max(1, -(-(len(a) + len(b)) // work))
            diagonals = np.arange(n + 1) * (len(a) + len(b)) // n
            a_at = crossings(a_ends, b_ends, diagonals) if len(held) else np.zeros(n + 1, np.int64)
            b_at = diagonals - a_at
            a_before, b_before = (np.concatenate(([0], ends)) for ends in (a_ends, b_ends))
            a_from, b_from = a_before[a_at], b_before[b_at]
            # A piece closes the ends above all that came before it.
            reached = np.maximum(a_from, b_from)
            first, last = np.searchsorted(doc_ends, reached[:-1], side="right"), np.searchsorted(doc_ends, reached[1:], side="left")
            last = np.where(reached[1:] > reached[:-1], last + 1, first)
            parts = np.bincount(np.concatenate([np.zeros(0, np.int64), *map(np.arange, first, last)]), minlength=len(held))
            made = np.zeros(len(held), np.int64)
            empty = np.flatnonzero(counts[0] == 0)
            columns, docs, offsets = [[] for _ in range(7)], [], [0]
            for p in range(n):
                base = min(a_from[p], b_from[p])
                within = np.arange(first[p], last[p])
                here = held[within]
                docs.append((here, doc_ends[within] - base, made[within], parts[within]))
                made[within] += 1
                if p == 0:
                    docs.append((empty, empty * 0, empty * 0, empty * 0))
                offsets.append(offsets[-1] + len(here) + (len(empty) if p == 0 else 0))
                values = (
                    piece, packed(a[a_at[p]:a_at[p + 1] + 1]), packed(b[b_at[p]:b_at[p + 1] + 1]),
                    int(a_at[p + 1] - a_at[p]), int(b_at[p + 1] - b_at[p]), int(a_from[p] - base), int(b_from[p] - base),
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
                piece += 1
            which, ends, part, of = (np.concatenate(each).astype(np.int64) for each in zip(*docs, strict=True))
            struct = pa.StructArray.from_arrays([
                batch.column(0).take(pa.array(which)), pa.array(row + which), pa.array(ends), pa.array(part.astype(np.int32)),
                pa.array(of.astype(np.int32)), pa.array(counts[0, which]), pa.array(counts[1, which]),
            ], ["doc_id", "row", "end", "part", "parts", "n_a", "n_b"])
            row += len(found)
            types = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
            names = ["piece", "a", "b", "a_own", "b_own", "a_from", "b_from", "docs"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)], names)

    return materialize(rows.mapInArrow(cut, schema), "pieces")


@dataclass
class Overlaps:
    """What a piece closes, one entry per distinct end: the ids, the document, and which sides end there."""

    a: np.ndarray
    b: np.ndarray
    doc: np.ndarray
    a_closes: np.ndarray
    b_closes: np.ndarray
    starts_open: bool

    @property
    def pair(self) -> np.ndarray:
        return self.a << 32 | self.b


def overlaps(tokens: Tokens, row: dict) -> Overlaps:
    """All overlaps of a piece; ``docs`` without tokens come last in the list and have none."""
    a, b = unpacked(row["a"], tokens.a_type), unpacked(row["b"], tokens.b_type)
    a_ends, b_ends = row["a_from"] + tokens.a_size[a].cumsum(), row["b_from"] + tokens.b_size[b].cumsum()
    ends = np.concatenate([a_ends[:row["a_own"]], b_ends[:row["b_own"]]])
    ends.sort(kind="stable")
    ends = ends[np.diff(ends, prepend=max(row["a_from"], row["b_from"])) > 0]
    at_a, at_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    doc = np.searchsorted(np.array([d["end"] for d in row["docs"] if d["parts"]], np.int64), ends)
    return Overlaps(a[at_a].astype(np.int64), b[at_b].astype(np.int64), doc, a_ends[at_a] == ends, b_ends[at_b] == ends, row["a_from"] != row["b_from"])


_COLUMNS = ["piece", "a", "b", "a_own", "b_own", "a_from", "b_from", "docs"]


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The pieces of a batch, one at a time."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def occurrences(cut: DataFrame, tokenizers: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Stored (piece, row, pair, docs): for every pair of a piece in how many of its whole documents it is linked, with
    a null ``row``; and a row for each pair of a document that was cut, which ``row`` names."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(*tokenizers)
        for batch in batches:
            for row in _rows(batch):
                found = overlaps(tokens, row)
                if not len(found.a):
                    continue
                pair, number = np.unique(found.pair, return_inverse=True)
                # Distinct (document, pair), in numbers of this piece.
                each = np.unique(found.doc * len(pair) + number)
                doc, number = each // len(pair), each % len(pair)
                whole = np.array([d["parts"] == 1 for d in row["docs"] if d["parts"]])[doc]
                split = np.flatnonzero(~whole)
                rows = np.array([d["row"] for d in row["docs"]])[doc[split]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(pair) + len(split), row["piece"])),
                    pa.concat_arrays([pa.nulls(len(pair), pa.int64()), pa.array(rows, pa.int64())]),
                    pa.array(np.concatenate([pair, pair[number[split]]])),
                    pa.array(np.concatenate([np.bincount(number[whole], minlength=len(pair)), np.ones(len(split), np.int64)])),
                ], ["piece", "row", "pair", "docs"])

    return materialize(cut.select(*_COLUMNS).mapInArrow(count, "piece bigint, row bigint, pair bigint, docs bigint"), "occurrences")


def pair_counts(found: DataFrame) -> DataFrame:
    """Stored (pair, count, best): in how many documents a pair is linked, and whether that is its A id's most."""
    whole = found.where("row is null").select("pair", "docs")
    cut = found.where("row is not null").select("row", "pair", "docs").dropDuplicates(["row", "pair"]).select("pair", "docs")
    counts = whole.union(cut).groupBy("pair").agg(F.sum("docs").alias("count"))
    # An A id meets at most as many B ids as there are.
    highest = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return materialize(counts.withColumn("best", F.col("count") == highest), "pair-counts")


def _listed(tokens: Tokens, found: Overlaps) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Tokens as text in the order of the listing; the group and the document of each, and its side."""
    both = found.a_closes & found.b_closes
    group = both.cumsum() - both
    a_group, b_group = group[found.a_closes], group[found.b_closes]
    a_place = np.arange(len(a_group)) + np.searchsorted(b_group, a_group)
    b_place = np.arange(len(b_group)) + np.searchsorted(a_group, b_group, side="right")
    last = lambda groups: np.concatenate([np.diff(groups) > 0, np.ones(min(1, len(groups)), bool)])
    n_a, n_b = len(tokens.a_bytes), len(tokens.b_bytes)
    code, groups, docs, sides = (np.zeros(len(a_group) + len(b_group), np.int64) for _ in range(4))
    code[a_place] = found.a[found.a_closes] + n_a * last(a_group)
    code[b_place] = found.b[found.b_closes] + 2 * n_a + n_b * last(b_group)
    groups[a_place], groups[b_place] = a_group, b_group
    docs[a_place], docs[b_place] = found.doc[found.a_closes], found.doc[found.b_closes]
    sides[b_place] = 1
    texts = tokens.listed()
    return [texts[c] for c in code.tolist()], groups, docs, sides


def _open_group(texts: list[str], sides: np.ndarray) -> str:
    """``a1,a2|b1`` of a group that is not whole; either side may be empty."""
    parts = [",".join(text[:-1] for text, s in zip(texts, sides, strict=True) if s == side) for side in (0, 1)]
    return "|".join(parts)


_PART = (
    "doc_id {id}, row bigint, part int, parts int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, head string, through boolean, middle string, tail string, groups_sha256 string"
)
_SUMS = ("n_groups", "n_links", "n_best", "count_sum")


def _parts(tokens: Tokens, row: dict, counts: list[np.ndarray], texts_too: bool) -> Iterator[dict]:
    """The documents of a piece, with sums and groups of what lies in it; ``counts`` are its pairs, counts and best."""
    docs = [d for d in row["docs"] if d["parts"]]
    for d in row["docs"]:
        if not d["parts"]:
            yield d | dict.fromkeys(_SUMS, 0) | {"middle": "", "groups_sha256": ""}
    if not docs:
        return
    found = overlaps(tokens, row)
    order = np.argsort(counts[0])
    pair, count, best = (column[order] for column in counts)
    at = np.searchsorted(pair, found.pair)
    both = found.a_closes & found.b_closes
    bounds = np.searchsorted(found.doc, np.arange(len(docs) + 1))
    measured = [both, np.ones(len(both), np.int64), best[at], count[at]]
    sums = [np.diff(np.concatenate(([0], m.cumsum()))[bounds]).tolist() for m in measured]
    texts, groups, owners, sides = _listed(tokens, found)
    places = np.searchsorted(owners, np.arange(len(docs) + 1)).tolist()
    last_group = int(both.sum())
    for i, d in enumerate(docs):
        result = d | dict(zip(_SUMS, (s[i] for s in sums), strict=True))
        x, y = places[i], places[i + 1]
        if d["parts"] == 1:
            listing = "".join(texts[x:y])[:-1]
            result["groups_sha256"] = hashlib.sha256(listing.encode()).hexdigest()
            yield result | ({"middle": listing} if texts_too else {})
            continue
        head = tail = None
        through = False
        if i == 0 and found.starts_open:
            n = int(np.searchsorted(groups[x:y], 0, side="right"))
            head, through = _open_group(texts[x:x + n], sides[x:x + n]), last_group == 0
            x += n
        if i == len(docs) - 1 and not both[-1] and not through:
            n = y - x - int(np.searchsorted(groups[x:y], last_group))
            tail = _open_group(texts[y - n:y], sides[y - n:y])
            y -= n
        yield result | {"head": head, "through": through, "middle": "".join(texts[x:y])[:-1], "tail": tail}


def stitched(parts: list[dict]) -> str:
    """The groups of a document from its parts in order."""
    whole: list[str] = []
    open_: tuple[list[str], list[str]] = ([], [])

    def more(group: str) -> None:
        for side, ids in zip(open_, group.split("|"), strict=True):
            if ids:
                side.append(ids)

    for part in parts:
        if part["head"] is not None:
            more(part["head"])
            if part["through"]:
                continue
            whole.append("|".join(map(",".join, open_)))
            open_ = ([], [])
        if part["middle"]:
            whole.append(part["middle"])
        if part["tail"] is not None:
            more(part["tail"])
    return ";".join(whole)


def aligned(cut: DataFrame, found: DataFrame, counts: DataFrame, tokenizers: tuple[str | None, str | None] = (None, None), groups: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) of every document."""
    own = found.where("row is null").select("piece", "pair").join(counts, "pair")
    own = own.groupBy("piece").agg(F.collect_list(F.struct("pair", "count", "best")).alias("counts"))
    met = cut.join(own, "piece", "left").select(*_COLUMNS, "counts")
    kind = dict(cut.select(F.col("docs")[0]["doc_id"].alias("doc_id")).dtypes)["doc_id"]
    schema = _PART.format(id=kind)

    def list_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(*tokenizers)
        for batch in batches:
            key = batch.schema.field("docs").type.value_type.field("doc_id").type
            fields = [("doc_id", key), *((name, _ARROW[name]) for name in _ARROW)]
            counts = batch.column("counts")
            for at, row in enumerate(_rows(batch.drop_columns(["counts"]))):
                own = counts.slice(at, 1).flatten()
                known = [own.field(name).to_numpy(zero_copy_only=False) for name in ("pair", "count", "best")]
                yield pa.RecordBatch.from_pylist(list(_parts(tokens, row, known, groups)), pa.schema(fields))

    parts = materialize(met.mapInArrow(list_, schema), "document-parts")
    wanted = ["doc_id", "n_a", "n_b", *_SUMS, "groups_sha256", *(["groups"] if groups else [])]
    single = parts.where("parts <= 1").withColumn("groups", F.col("middle")).select(*wanted)

    def stitch(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        listing = stitched(rows)
        one = {name: sum(r[name] for r in rows) for name in _SUMS} | {"n_a": rows[0]["n_a"], "n_b": rows[0]["n_b"]}
        one |= {"groups_sha256": hashlib.sha256(listing.encode()).hexdigest(), "groups": listing if groups else None}
        plain = [name for name in wanted if name != "doc_id"]
        columns = [table.column("doc_id").slice(0, 1)]
        columns += [pa.array([one[n]], pa.int64() if n.startswith(("n_", "c")) else pa.string()) for n in plain]
        return pa.table(columns, names=wanted)

    result = single.schema
    return single.union(parts.where("parts > 1").groupBy("row").applyInArrow(stitch, result))


_ARROW = {
    "row": pa.int64(), "part": pa.int32(), "parts": pa.int32(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
    "n_links": pa.int64(), "n_best": pa.int64(), "count_sum": pa.int64(), "head": pa.string(), "through": pa.bool_(),
    "middle": pa.string(), "tail": pa.string(), "groups_sha256": pa.string(),
}


def lexicon(documents: DataFrame, tokenizers: tuple[str | None, str | None] = (None, None), work: int = WORK) -> DataFrame:
    """(a, b, documents, best) of every id pair that is linked in the corpus."""
    counts = pair_counts(occurrences(pieces(documents, tokenizers, work), tokenizers))
    return counts.select(
        F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"),
        F.col("count").alias("documents"), "best",
    )


def alignment_report(documents: DataFrame, tokenizers: tuple[str | None, str | None] = (None, None), work: int = WORK, groups: bool = False) -> DataFrame:
    cut = pieces(documents, tokenizers, work)
    found = occurrences(cut, tokenizers)
    return aligned(cut, found, pair_counts(found), tokenizers, groups)
