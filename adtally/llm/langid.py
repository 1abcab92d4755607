"""Language of every word by a linear-chain conditional random field, and of the document by their sum.

A word's features are its letter pairs and triples with the blanks around it (so that first and last
letters count as affixes), its first and last three letters with the blank, and its place in the
lexicon of words that are frequent in the sample. Transitions between languages are learned from
code-switched chains: passages of documents of different languages in a row. Forward-backward gives
each word's chance per language; the document's share of a language is the mean of its words' chances,
weighted by their length, and the prediction is the language with the largest share. ``word_languages`` gives the
labels themselves: runs of words of one language, with their places in the original text.

The model is fitted on the driver from about ``PER_LANGUAGE`` documents of each language, chosen by a
hash of their id. Texts of more than ``DRAWN`` times ``DRAWN_WORDS`` words give so many passages, drawn by a
hash of the text, one from each equal part of the whole; others are read whole. Each language brings its own
``LEXICON`` words and ``CHAINS`` passages' beginnings, however many there are. Prediction reads whole texts: a long text is
cut into chains of ``CHAIN`` words, each run with ``CONTEXT`` words of its neighbours on both sides,
whose own chances are not used twice.

A null text and one without a letter are ``und`` with score 0; so is every text if no language could
be learned. A null language is not learned from. Repeated rows get the same result; other columns are
not used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import fold, python_tasks, raw_texts, worker_cache
from adtally.llm.crf import fit, forward_backward, summed
from adtally.llm.hashing import hashed_words, mixed, small_letters

FOLDS, HELD_OUT = 4, 2
PER_LANGUAGE, DRAWN, DRAWN_WORDS = 400, 8, 160
#: Code-switched chains and words of the lexicon for each language.
CHAINS, CHAIN_WORDS, PASSAGE = 300, 80, (4, 40)
LEXICON, LEXICON_LEAST = 750, 5
CHAIN, CONTEXT = 512, 16
UNKNOWN = "und"

#: Numbers of hashed pairs, triples and affixes, in this order, then the lexicon and one for all words.
PAIRS, TRIPLES, AFFIXES = 1 << 12, 1 << 15, 1 << 15
FIRST_TRIPLE, FIRST_AFFIX, FIRST_WORD = PAIRS, PAIRS + TRIPLES, PAIRS + TRIPLES + AFFIXES


@dataclass(frozen=True)
class Words:
    """Words of a batch and their features: those of letters with their word, those of words."""

    sizes: np.ndarray
    starts: np.ndarray
    hashes: np.ndarray
    letters: list[np.ndarray]
    first_letter: np.ndarray
    affixes: list[np.ndarray]


def words_of(text: bytes) -> Words:
    """``text`` holds small letters and blanks."""
    hashes, starts, ends = hashed_words(text)
    chars = np.frombuffer(b"   " + text + b"   ", np.uint8).astype(np.uint64)
    at = np.flatnonzero(np.frombuffer(text, np.uint8) != 32) + 3
    left, here, right = chars[at - 1], chars[at], chars[at + 1]
    eight = np.uint64(8)
    pairs = mixed(left << eight | here) % np.uint64(PAIRS)
    triples = mixed((left << eight | here) << eight | right) % np.uint64(TRIPLES)

    def affix(first: np.ndarray, side: int) -> np.ndarray:
        code = np.full(len(first), side, np.uint64)
        for step in range(4):
            code = code << eight | chars[first + step]
        return (mixed(code) % np.uint64(AFFIXES)).astype(np.int64) + FIRST_AFFIX

    sizes = ends - starts
    return Words(
        sizes, starts, hashes, [pairs.astype(np.int64), triples.astype(np.int64) + FIRST_TRIPLE],
        np.cumsum(sizes) - sizes, [affix(starts + 2, 1), affix(ends, 2)],
    )


@dataclass(frozen=True)
class Model:
    languages: list[str]
    lexicon: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray

    def lexical(self, hashes: np.ndarray) -> np.ndarray:
        """Lexicon features; words that are not in it share the last but one number."""
        none = FIRST_WORD + len(self.lexicon)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), max(len(self.lexicon) - 1, 0))
        return np.where(self.lexicon[at] == hashes, FIRST_WORD + at, none) if len(self.lexicon) else np.full(len(hashes), none)

    def scores(self, words: Words) -> np.ndarray:
        total = self.weights[self.lexical(words.hashes)] + self.weights[-1]
        for ids in words.affixes:
            total += self.weights[ids]
        letters = self.weights[words.letters[0]]
        for ids in words.letters[1:]:
            letters += self.weights[ids]
        return total + np.add.reduceat(letters, words.first_letter, axis=0)


def frequent_words(hashes: np.ndarray) -> np.ndarray:
    known, counts = np.unique(hashes, return_counts=True)
    frequent = np.argsort(-counts, kind="stable")[:LEXICON]
    return known[frequent[counts[frequent] >= LEXICON_LEAST]]


def train(rows: list[tuple[str, bytes]]) -> Model | None:
    """From (language, text)."""
    languages = sorted({lang for lang, _ in rows})
    held: dict[str, list[list[bytes]]] = {lang: [] for lang in languages}
    for lang, text in rows:
        if words := small_letters(text or b"").split():
            held[lang].append(words)
    languages = [lang for lang in languages if held[lang]]
    if not languages:
        return None
    rng = np.random.default_rng(7)
    texts, gold, lengths = [], [], []
    for _ in range(CHAINS * len(languages)):
        chain: list[bytes] = []
        while len(chain) < CHAIN_WORDS:
            state = int(rng.integers(len(languages)))
            document = held[languages[state]][int(rng.integers(len(held[languages[state]])))]
            first = int(rng.integers(len(document)))
            passage = document[first:first + int(rng.integers(*PASSAGE))]
            chain += passage
            gold += [state] * len(passage)
        texts.append(b" ".join(chain))
        lengths.append(len(chain))
    words, truth = words_of(b" ".join(texts)), np.array(gold)
    lexicon = np.unique(np.concatenate([frequent_words(words.hashes[truth == state]) for state in range(len(languages))]))
    size = FIRST_WORD + len(lexicon) + 2
    bare = Model(languages, lexicon, np.zeros((size, len(languages))), np.zeros((len(languages), len(languages))))
    row = np.arange(len(truth))
    letter_row = np.repeat(row, words.sizes)
    features = np.concatenate([*words.letters, *words.affixes, bare.lexical(words.hashes), np.full(len(row), size - 1)])
    owner = np.concatenate([letter_row] * len(words.letters) + [row] * (len(words.affixes) + 2))
    weights, transitions = fit(features, owner, size, truth, np.array(lengths), len(languages), rounds=25, rate=0.1)
    return Model(languages, lexicon, weights, transitions)


def drawn(text: bytes) -> bytes:
    """The words of the text, or those of passages from all of it. A word's features do not reach beyond it."""
    words = small_letters(text).split()
    if len(words) <= DRAWN * DRAWN_WORDS:
        return b" ".join(words)
    rng = np.random.default_rng(zlib.crc32(text))
    edges = np.linspace(0, len(words), DRAWN + 1).astype(int).tolist()
    firsts = [int(rng.integers(a, b - DRAWN_WORDS + 1)) for a, b in pairwise(edges)]
    return b" ".join(word for first in firsts for word in words[first:first + DRAWN_WORDS])


def fitted(documents: DataFrame) -> Model | None:
    python_tasks(documents.sparkSession)
    own = documents.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    usable = own.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    counts = {r.lang: r["count"] for r in usable.select("lang").groupBy("lang").count().collect()}
    if not counts:
        return None
    # A hash of the id between 0 and 1 picks about so many of each language.
    place = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 20)) / float(1 << 20)
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, 1.2 * PER_LANGUAGE / n)))])
    chosen = usable.select(place.alias("place"), "lang", "text").where(F.col("place") < share[F.col("lang")])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([drawn(t) for t in raw_texts(batch.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["place", "lang", "text"])

    # Words are drawn first, so that only they are ordered; the bound matters where an id repeats very often.
    most = 2 * PER_LANGUAGE * len(counts)
    words = chosen.mapInArrow(draw, "place double, lang string, text binary").orderBy("place", "lang", "text").limit(most)
    return train(sorted((r.lang, bytes(r.text)) for r in words.collect()))


def _chains(counts: np.ndarray):
    """Numbers of the words of every chain, chain lengths, and which of them count."""
    index, lengths, core = [], [], []
    ends = np.cumsum(counts)
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        begin = end - n
        if n <= CHAIN + 2 * CONTEXT:
            pieces = [(begin, end)] if n else []
        else:
            pieces = [(at, min(at + CHAIN, end)) for at in range(begin, end, CHAIN)]
        for a, b in pieces:
            low, high = max(begin, a - CONTEXT), min(end, b + CONTEXT)
            index.append((low, high))
            lengths.append(high - low)
            core.append((a, b))
    size = np.array(lengths, np.int64)
    places = np.repeat(np.array([low for low, _ in index], np.int64) - (np.cumsum(size) - size), size) + np.arange(size.sum())
    own = (places >= np.repeat([a for a, _ in core], size)) & (places < np.repeat([b for _, b in core], size))
    return places, size, own


def labelled(model: Model, texts: list[bytes | None]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts, the text of each and where it begins there (in bytes), and its chance of every language."""
    plain = [small_letters(t or b"") for t in texts]
    words = words_of(b" ".join(plain))
    ends = np.cumsum([len(p) + 1 for p in plain])
    doc = np.searchsorted(ends, words.starts, "right")
    chances = np.zeros((len(words.sizes), len(model.languages)))
    if len(words.sizes):
        places, lengths, own = _chains(np.bincount(doc, minlength=len(texts)))
        marginals, _ = forward_backward(model.scores(words)[places], lengths, model.transitions)
        chances[places[own]] = marginals[own]
    return words, doc, words.starts - (ends - [len(p) + 1 for p in plain])[doc], chances


def shares(model: Model, texts: list[bytes | None]) -> np.ndarray:
    """Share of every language in every text; zeros for a text without words."""
    result = np.zeros((len(texts), len(model.languages)))
    if not texts:
        return result
    words, doc, _, chances = labelled(model, texts)
    weighted = chances * words.sizes[:, None]
    for state in range(len(model.languages)):
        result[:, state] = np.bincount(doc, weighted[:, state], len(texts))
    return result / np.maximum(result.sum(1, keepdims=True), 1e-300)


def runs(model: Model, texts: list[bytes | None]) -> list[list[tuple[int, int, str, int, float]]]:
    """(start, end, language, words, score) of the runs of words of one language in every text.

    Places are code points of the original text, end exclusive; the score is the mean chance of the words.
    """
    found: list[list] = [[] for _ in texts]
    if not texts:
        return found
    words, doc, starts, chances = labelled(model, texts)
    if not len(doc):
        return found
    best = chances.argmax(1)
    first = np.flatnonzero(np.concatenate(([True], (np.diff(best) != 0) | (np.diff(doc) != 0))))
    last = np.concatenate((first[1:], [len(doc)])) - 1
    point = {d: np.concatenate(([0], np.cumsum((np.frombuffer(texts[d], np.uint8) & 0xC0) != 0x80))) for d in np.unique(doc).tolist()}
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        d = int(doc[a])
        start, end = point[d][[starts[a], starts[b] + words.sizes[b]]].tolist()
        found[d].append((start, end, model.languages[best[a]], b - a + 1, float(chances[a:b + 1, best[a]].mean())))
    return found


def word_languages(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, spans) of every document: the runs of words of one language; none without a model or words."""
    python_tasks(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select("doc_id", "text")
    names = [("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string()), ("words", pa.int64()), ("score", pa.float64())]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("language")
        for batch in batches:
            texts = raw_texts(batch.column(1))
            found = runs(sent.value, texts) if sent.value else [[] for _ in texts]
            spans = [[dict(zip((n for n, _ in names), run, strict=True)) for run in each] for each in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.struct(names)))], ["doc_id", "spans"])

    span = "struct<start: bigint, end: bigint, lang: string, words: bigint, score: double>"
    return rows.mapInArrow(label, f"doc_id {dict(rows.dtypes)['doc_id']}, spans array<{span}>")


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return any(65 <= b <= 90 or 97 <= b <= 122 for b in text[:200]) or any(map(str.isalpha, text.decode()))


def identified(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, shares) of every document."""
    python_tasks(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select("doc_id", "text")

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("language")
        known = sent.value
        for batch in batches:
            texts = raw_texts(batch.column(1))
            lettered = np.array([known is not None and has_letter(t) for t in texts], bool)
            values = shares(known, texts) if known else np.zeros((len(texts), 1))
            best = values.argmax(1)
            names = [known.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
            top = np.where(lettered, np.minimum(values[np.arange(len(texts)), best], 1), 0)
            each = [dict(zip(known.languages, v, strict=True)) if ok else {} for v, ok in zip(values.tolist(), lettered.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(top, pa.float64()),
                 pa.array([list(e.items()) for e in each], pa.map_(pa.string(), pa.float64()))],
                ["doc_id", "lang_pred", "score", "shares"],
            )

    return rows.mapInArrow(identify, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double, shares map<string,double>")


def language_report(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    rows = identified(documents, fitted(documents))
    return rows.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
