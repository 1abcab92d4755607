"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are bins of simple measures of itself and of both neighbour
lines: length, shares of capitals, digits, bars, exclamation marks and odd symbols, symbols per word,
word length, words that repeat the word before. Forward-backward gives each line's chance to be good,
and the length-weighted mean of these is the document's.

Only documents have labels. Lines of good documents are taken as good; for lines of bad documents a
first model, trained with the document's label on each line, decides which of them are bad, and the
field is trained on the result. A logistic curve turns the mean into the chance of label 1.

The model is fitted on the driver from at most ``TRAIN_DOCUMENTS`` labelled documents, chosen by a
hash of their id; only bin numbers reach the driver. Training and scoring read whole texts: if the
sample has more than ``TRAIN_LINES`` lines, fewer documents are taken (``enough``), never parts of one. Without labelled documents of both kinds every score is 0.5.

A null or empty text has no letters to weigh and gets the share of good documents in the sample.
Repeated rows get the same score; other columns pass through or are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import columns_of, fold, numbered, own_prefix, python_tasks, raw_texts, sampled, worker_cache
from adtally.llm.crf import fit, forward_backward, logistic, summed
from adtally.llm.hashing import hashed_words
from adtally.session import materialize

#: A line of the sample takes about 1.5 KB of the driver while the field is fitted.
TRAIN_DOCUMENTS, TRAIN_LINES, LEAST_EACH = 8000, 300_000, 50
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
BAD, GOOD = 0, 1

#: Kinds of bytes: line end, small or foreign letter, capital, digit, blank, common mark, "!", "|", other.
_KINDS = np.full(256, 8, np.uint8)
_KINDS[10] = 0
_KINDS[97:123] = 1
_KINDS[128:] = 1
_KINDS[65:91] = 2
_KINDS[48:58] = 3
_KINDS[[9, 11, 12, 13, 32]] = 4
_KINDS[[ord(c) for c in ".,;:'\"()-?/"]] = 5
_KINDS[ord("!")] = 6
_KINDS[ord("|")] = 7
#: Upper edges of the bins of each measure.
_EDGES = [
    [0.5, 3.5, 10, 30, 80, 200, 500],  # bytes
    [0.001, 0.03, 0.1, 0.3, 0.6],  # capitals to letters
    [0.001, 0.03, 0.1, 0.3],  # digits
    [0.001, 0.01, 0.03, 0.1],  # bars
    [0.001, 0.01, 0.03, 0.1],  # exclamation marks
    [0.001, 0.01, 0.03, 0.1, 0.3],  # odd symbols
    [0.001, 0.1, 0.5, 1, 2],  # odd symbols, bars and exclamation marks to words
    [2.5, 4, 5.5, 7, 9, 12],  # bytes to words
    [0.001, 0.05, 0.2, 0.5],  # repeated words
]
_STARTS = np.cumsum([0] + [len(e) + 1 for e in _EDGES])
BINS = int(_STARTS[-1])
#: Own bins, those of the line before and after, and one feature that all lines have.
FEATURES = 3 * BINS + 1


def line_bins(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin numbers (lines, measures), bytes of every line, lines of every text."""
    joined = b"\n".join(t or b"" for t in texts)
    counts = np.array([(t or b"").count(b"\n") + 1 for t in texts], np.int64)
    raw = np.frombuffer(joined, np.uint8)
    ends = np.concatenate((np.flatnonzero(raw == 10), [len(raw)]))
    starts = np.concatenate(([0], ends[:-1] + 1))
    kinds, sizes = _KINDS[raw], ends - starts

    def of(kind: int) -> np.ndarray:
        sums = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(kinds == kind, out=sums[1:])
        return sums[ends] - sums[starts]

    small, capital, digit, bar, bang, odd = (of(k) for k in (1, 2, 3, 7, 6, 8))
    hashes, word_starts, _ = hashed_words(joined)
    line_of = np.searchsorted(starts, word_starts, "right") - 1
    n_words = np.bincount(line_of, minlength=len(starts))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    repeated = np.bincount(line_of, same, minlength=len(starts))
    size, words = np.maximum(sizes, 1), np.maximum(n_words, 1)
    measures = [
        sizes, capital / np.maximum(small + capital, 1), digit / size, bar / size, bang / size, odd / size,
        (odd + bar + bang) / words, size / words, repeated / words,
    ]
    bins = np.stack([at + np.digitize(m, e) for at, m, e in zip(_STARTS, measures, _EDGES, strict=False)], 1)
    return bins, sizes, counts


def with_neighbours(bins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Feature numbers of every line: own, before, after, always; ``FEATURES`` where there is none."""
    n = len(bins)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    ends = np.cumsum(counts)
    first[(ends - counts)[counts > 0]] = True
    last[ends[counts > 0] - 1] = True
    before, after = np.roll(bins, 1, 0) + BINS, np.roll(bins, -1, 0) + 2 * BINS
    before[first], after[last] = FEATURES, FEATURES
    return np.concatenate([bins, before, after, np.full((n, 1), FEATURES - 1)], 1)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    intercept: float
    share: float


def _goodness(weights, transitions, features, sizes, counts) -> np.ndarray:
    """Length-weighted mean chance of good of every text, not a number where nothing has length."""
    marginals, _ = forward_backward(weights[features].sum(1), counts, transitions)
    doc = np.repeat(np.arange(len(counts)), counts)
    total = np.bincount(doc, sizes, len(counts))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.bincount(doc, sizes * marginals[:, GOOD], len(counts)) / total


def _logit(share: np.ndarray) -> np.ndarray:
    p = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def train(rows: list[tuple[int, bytes, bytes]]) -> Model | None:
    """From (label, bins, sizes) of labelled documents."""
    rows = [r for r in rows if len(r[2])]
    labels = np.array([r[0] for r in rows])
    if len(set(labels.tolist())) < 2:
        return None
    measures = len(_EDGES)
    bins = np.concatenate([np.frombuffer(b, np.int16).reshape(-1, measures) for _, b, _ in rows]).astype(np.int64)
    sizes = np.concatenate([np.frombuffer(s, np.int32) for _, _, s in rows])
    counts = np.array([len(s) // 4 for _, _, s in rows])
    features = with_neighbours(bins, counts)
    row = np.arange(len(bins))
    own, own_row = bins.ravel(), np.repeat(row, measures)
    every, every_row = features.ravel(), np.repeat(row, features.shape[1])
    gold = np.repeat(labels, counts)
    # Each line alone: chains of one.
    alone = np.ones(len(gold), np.int64)
    first, none = fit(own, own_row, BINS, gold, alone, 2, rounds=40)
    seems, _ = forward_backward(summed(first, own, own_row, len(gold)), alone, none)
    good_share = np.average(seems[gold == GOOD, GOOD], weights=np.maximum(sizes[gold == GOOD], 1))
    gold = np.where((gold == BAD) & (seems[:, GOOD] < good_share / 2), BAD, GOOD)
    weights, transitions = fit(every, every_row, FEATURES + 1, gold, counts, 2, rounds=60)
    weights[FEATURES] = 0
    goodness = _goodness(weights, transitions, features, sizes, counts)
    known = ~np.isnan(goodness)
    x = np.stack([_logit(goodness[known]), np.ones(known.sum())], 1)
    slope, intercept = logistic(x, labels[known])
    return Model(weights, transitions, float(slope), float(intercept), float(labels.mean()))


def enough(rows: list[tuple[int, int, int]]) -> dict[int, int]:
    """The last place to take of each label, from (place, label, lines) of whole documents.

    In the order of places documents are taken until they have ``TRAIN_LINES`` lines; ``LEAST_EACH`` of each label in any case.
    """
    last, seen, total = {}, {}, 0
    for place, label, lines in sorted(rows):
        if total < TRAIN_LINES or seen.get(label, 0) < LEAST_EACH:
            last[label] = place
            seen[label] = seen.get(label, 0) + 1
        total += lines
    return last


def fitted(documents: DataFrame, labels: DataFrame) -> Model | None:
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("quality")
        for batch in batches:
            bins, sizes, counts = line_bins(raw_texts(batch.column(2)))
            ends = np.cumsum(counts)
            parts = list(zip((ends - counts).tolist(), ends.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array([bins[a:b].astype(np.int16).tobytes() for a, b in parts], pa.binary()),
                pa.array([sizes[a:b].astype(np.int32).tobytes() for a, b in parts], pa.binary()),
            ], ["place", "y", "n", "bins", "sizes"])

    python_tasks(documents.sparkSession)
    rows = sampled(documents, labels, "quality", FOLDS, HELD_OUT, TRAIN_DOCUMENTS)
    binned = rows.select(F.xxhash64("doc_id").alias("place"), "y", "text").mapInArrow(measured, "place bigint, y int, n bigint, bins binary, sizes binary")
    binned = materialize(binned, "labelled-lines")
    last = enough([tuple(r) for r in binned.select("place", "y", "n").collect()])
    taken = [(F.col("y") == label) & (F.col("place") <= place) for label, place in last.items()]
    return train([tuple(r) for r in binned.where(reduce(or_, taken, F.lit(False))).select("y", "bins", "sizes").collect()])


def score_texts(model: Model | None, texts: list[bytes | None]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    bins, sizes, counts = line_bins(texts)
    goodness = _goodness(model.weights, model.transitions, with_neighbours(bins, counts), sizes, counts)
    scores = 1 / (1 + np.exp(-(model.slope * _logit(np.nan_to_num(goodness, nan=0.5)) + model.intercept)))
    return np.where(np.isnan(goodness), model.share, scores)


def scored(documents: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """All columns of ``documents`` and the score."""
    python_tasks(documents.sparkSession)
    sent, at = documents.sparkSession.sparkContext.broadcast(model), documents.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("quality")
        for batch in batches:
            values = pa.array(score_texts(sent.value, raw_texts(batch.column(at))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, "score"])

    plain, types = numbered(documents)
    return plain.mapInArrow(score, f"{types}, score double").toDF(*documents.columns, name)


def quality_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = scored(documents.select("doc_id", "text"), fitted(documents, labels))
    return rows.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    score = f"{own_prefix(documents)}score"
    rows = scored(documents, fitted(documents, labels), score)
    return rows.where(F.col(score) >= THRESHOLD).select(*columns_of(documents))
