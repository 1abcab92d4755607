"""Toxicity of restored text: a noisy-channel decoder undoes leetspeak, spacing and repetition first.

1. *Language model.* Letter triples of all documents are counted by the tasks and summed; with
   interpolation they give the chance of a letter after two others. The counts cover the whole corpus;
   the table has one row per triple of 28 signs, whatever the corpus.
2. *Lattice.* A suspicious token (a digit or sign beside a letter, a letter three times in a row, a doubled
   letter that is rare under the model, several doubled letters, letters spaced out one by one) is a
   lattice: each character is one of the letters it may stand for, or nothing (a separator, a mark at the
   rim, a repeat of the letter before), each at the cost of the channel. Viterbi over (last two letters)
   finds the likeliest word under model and channel, and a second time with separators that may also
   end a word; all words of both are looked up. Where letters are spaced out one by one the ends of words
   show too little in letter triples, so every part of ``LEAST_PART`` letters or more is looked up too.
3. *Score.* Toxic words and word beginnings are learned from labelled documents one at a time: each is
   the one that tells most of the toxic documents which no earlier one explains, so that the harmless
   words of a copied toxic text are not learned. Their counts in the text and in the restored tokens
   go into a logistic regression.

Word counts for training come from at most ``TRAIN_DOCUMENTS`` labelled documents, chosen by a hash of
their id. Training and scoring read whole texts: the tasks count in how many toxic and other documents
each word is, and only hashes of words that can be learned reach the driver. Without labelled documents of both kinds every score is 0.5.

A null or empty text has no toxic word and gets the score of such. Repeated rows get the same score;
other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import fold, python_tasks, raw_texts, sampled, worker_cache
from adtally.llm.crf import logistic
from adtally.llm.hashing import hashed_prefixes, small_letters
from adtally.session import materialize

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
TRAIN_DOCUMENTS = 10_000
#: Beginnings of words, in bytes, that may be learned like words.
PREFIXES = (5, 6, 7)
LEAST_DOCUMENTS, LEAST_SHARE = 4, 0.15
REMEMBERED = 200_000

SIGNS = 28  # 0: anything else, 1-26: letters, 27: bytes beyond ASCII
_SIGN = np.zeros(256, np.int32)
_SIGN[97:123] = np.arange(1, 27)
_SIGN[65:91] = np.arange(1, 27)
_SIGN[128:] = 27

#: Letters that a character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou",
}
SEPARATORS = " .-_*'~\t\n"
#: Costs of the channel, in nats: a sign read as a letter, one left out, a repeat left out, a separator left out.
#: Leaving a sign out must cost about what a letter costs under the model, else the shortest word wins.
SUBSTITUTE, LEAVE_OUT, REPEAT, SEPARATE = 1.0, 9.0, 1.5, 0.2


def triples(documents: DataFrame) -> DataFrame:
    """(code, n): how often each triple of signs occurs in all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("toxicity")
        total = np.zeros(SIGNS ** 3, np.int64)
        for batch in batches:
            signs = _SIGN[np.frombuffer(b"  ".join(t or b"" for t in raw_texts(batch.column(0))), np.uint8)]
            if len(signs) > 2:
                total += np.bincount((signs[:-2] * SIGNS + signs[1:-1]) * SIGNS + signs[2:], minlength=SIGNS ** 3)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["code", "n"])

    python_tasks(documents.sparkSession)
    return documents.select("text").mapInArrow(count, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def letter_costs(counts: list[tuple[int, int]]) -> np.ndarray:
    """Negative log chance of a sign after two others, interpolated with the shorter contexts."""
    n3 = np.zeros(SIGNS ** 3)
    for code, n in counts:
        n3[code] = n
    n3 = n3.reshape(SIGNS, SIGNS, SIGNS)
    n2, n1 = n3.sum(0), n3.sum((0, 1))
    p1 = (n1 + 1) / (n1.sum() + SIGNS)
    p2 = (n2 + 50 * p1) / (n2.sum(1, keepdims=True) + 50)
    p3 = (n3 + 20 * p2) / (n3.sum(2, keepdims=True) + 20)
    return -np.log(p3)


def decode(token: str, costs: np.ndarray, ends_words: bool = False) -> str:
    """The likeliest word behind a token: Viterbi over its lattice, states being the last two letters.

    With ``ends_words`` a separator may be real, and the result has blanks between words.
    """
    table = costs
    # (last but one, last letter, last character if it was a letter) -> (cost, word)
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    text = token.lower()
    for at, char in enumerate(text):
        fresh: dict[tuple[int, int], tuple[float, str]] = {}
        letter = "a" <= char <= "z"
        options = [(char, 0.0)] if letter else [(c, SUBSTITUTE + math.log(len(LEET[char]))) for c in LEET.get(char, "")]
        if letter:
            silent = REPEAT if at and text[at - 1] == char else None
        elif char in SEPARATORS:
            silent = SEPARATE
        else:
            silent = LEAVE_OUT if char.isascii() else SEPARATE
        for (a, b), (cost, word) in states.items():
            ends = [((b, 0), cost + table[a, b, 0], word + " ")] if ends_words and char in SEPARATORS and b else []
            moves = ends + [((b, ord(c) - 96), cost + extra + table[a, b, ord(c) - 96], word + c) for c, extra in options]
            # A repeat may be left out where the letter before was read as the same letter.
            same = not letter and options and any(ord(c) - 96 == b for c, _ in options) and at and text[at - 1] == char
            if silent is not None and (not letter or b == ord(char) - 96):
                moves.append(((a, b), cost + (min(silent, REPEAT) if same else silent), word))
            for state, total, longer in moves:
                if state not in fresh or total < fresh[state][0]:
                    fresh[state] = (total, longer)
        if fresh:
            states = fresh
    return min((cost + table[a, b, 0], word) for (a, b), (cost, word) in states.items())[1].strip()


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "@$!|+*"]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Lengths of the parts of a spaced-out run that are looked up.
LEAST_PART, MOST_PART = 4, 24
#: A doubled letter that costs more than this, in nats, is one letter in fifty or less after the two before.
RARE = math.log(50)
_RIM = "!?.,;:#%&*()[]{}\"'<>/\\=~^`|"


def suspicious(text: bytes, costs: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Byte ranges of tokens that the decoder should look at; with ``costs`` also those of doubled letters."""
    if not text:
        return []
    low = text.lower()
    raw = np.frombuffer(b"  " + low + b"      ", np.uint8)
    letter, digit, mark, blank = _LETTER[raw], _DIGIT[raw], _MARK[raw], _BLANK[raw]
    flag = np.zeros(len(raw), bool)
    flag[1:-1] = (digit[1:-1] & (letter[2:] | letter[:-2])) | (mark[1:-1] & letter[2:])
    flag[:-2] |= letter[:-2] & (raw[:-2] == raw[1:-1]) & (raw[1:-1] == raw[2:])
    if costs is not None:
        double = np.flatnonzero(letter[1:] & (raw[1:] == raw[:-1])) + 1
        signs, token = _SIGN[raw], np.cumsum(blank)[double]
        rare = costs[signs[double - 2], signs[double - 1], signs[double]] > RARE
        flag[double[rare | (np.bincount(token, minlength=1)[token] > 1)]] = True
    one = np.zeros(len(raw), bool)
    single = letter | digit | mark
    one[1:-1] = single[1:-1] & ~single[:-2] & ~single[2:]
    spaced = np.zeros(len(raw), bool)
    spaced[:-4] = one[:-4] & one[2:-2] & one[4:] & (letter[:-4] | letter[2:-2] | letter[4:])
    found = []
    if flag.any():
        gaps = np.flatnonzero(blank)
        at = np.flatnonzero(flag)
        after = np.searchsorted(gaps, at)
        found = sorted({(int(gaps[i - 1]) - 1, int(gaps[i]) - 2) for i in after.tolist()})
    if spaced.any():
        member = spaced.copy()
        for step in (2, 4):
            member[step:] |= spaced[:-step]
        at = np.flatnonzero(member)
        for run in np.split(at, np.flatnonzero(np.diff(at) > 2) + 1):
            found.append((int(run[0]) - 2, int(run[-1]) - 1))
    return [(max(a, 0), min(b, len(text))) for a, b in found]


@dataclass(frozen=True)
class Model:
    costs: np.ndarray
    words: np.ndarray
    weights: np.ndarray
    remembered: dict[str, tuple[str, np.ndarray]] = field(default_factory=dict)

    def read(self, token: str) -> tuple[str, np.ndarray]:
        """The restored token, and the lexicon entries in all its readings."""
        known = self.remembered.get(token)
        if known is None:
            known = self._read(token.strip(_RIM))
            if len(self.remembered) < REMEMBERED:
                self.remembered[token] = known
        return known

    def _read(self, token: str) -> tuple[str, np.ndarray]:
        word = decode(token, self.costs)
        found = [_first_known(hashed_prefixes(word.encode(), PREFIXES)[0], self.words)]
        if any(c in SEPARATORS for c in token):
            ended = decode(token, self.costs, ends_words=True)
            found.append(_first_known(hashed_prefixes(ended.encode(), PREFIXES)[0], self.words))
            if found[-1].any() and not found[0].any():
                word = ended
        if len(token) > 4 and not any(c.isalnum() for c in token[1::2]):
            longest, letters = "", word.replace(" ", "")
            for at in range(0, len(letters), 1000):
                starts = range(at, min(at + 1000, len(letters)))
                parts = [letters[a:b] for a in starts for b in range(a + LEAST_PART, min(a + MOST_PART, len(letters)) + 1)]
                hashes = hashed_prefixes(" ".join(parts).encode(), PREFIXES)[0]
                found.append(_first_known(hashes, self.words))
                longest = max([longest, *(parts[n] for n in np.flatnonzero(found[-1]).tolist() if len(parts[n]) < 8)], key=len)
            if longest and " " not in word:
                word = " ".join(x for x in word.partition(longest) if x)
        hits = np.unique(np.concatenate(found))
        return word, hits[hits > 0]

    def restored(self, token: str) -> str:
        return self.read(token)[0]


def restored_text(text: bytes, model: Model) -> str:
    """The text with every suspicious token decoded."""
    parts, done, sure = [], 0, set(suspicious(text))
    for a, b in sorted(suspicious(text, model.costs)):
        word, hits = model.read(text[a:b].decode(errors="replace")) if a >= done else ("", [])
        # Doubled letters are common: they stay, unless a word that is known as toxic comes of it.
        if a >= done and ((a, b) in sure or len(hits)):
            parts += [text[done:a].decode(errors="replace"), word]
            done = b
    return "".join([*parts, text[done:].decode(errors="replace")])


def _inputs(hits: np.ndarray, distinct: np.ndarray, words: np.ndarray) -> np.ndarray:
    density = np.log1p(100 * hits / np.maximum(words, 1))
    return np.stack([np.ones(len(hits)), np.log1p(hits), distinct, density, hits == 1], 1).astype(float)


def _measured(texts: list[bytes | None], lexicon: np.ndarray, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Toxic words, distinct ones and words of every text; ``lexicon`` is sorted."""
    plain = [small_letters(t or b"") for t in texts]
    hashes, starts, _ = hashed_prefixes(b" ".join(plain), PREFIXES)
    doc = np.searchsorted(np.cumsum([len(p) + 1 for p in plain]), starts, "right")
    words = np.bincount(doc, minlength=len(texts))
    first = _first_known(hashes, lexicon)
    at = np.flatnonzero(first)
    docs, hit = [doc[at]], [first[at]]
    if model is not None:
        tokens = [(i, t[a:b]) for i, t in enumerate(texts) for a, b in suspicious(t or b"", model.costs)]
        # What a token says as it stands is counted already.
        for i, token in tokens:
            read = model.read(token.decode(errors="replace"))[1]
            fresh = read[~np.isin(read, _first_known(hashed_prefixes(small_letters(token), PREFIXES)[0], lexicon))] if len(read) else read
            docs.append(np.full(len(fresh), i))
            hit.append(fresh)
    docs, hit = np.concatenate(docs).astype(np.int64), np.concatenate(hit)
    pairs = np.unique(np.stack([docs.astype(np.uint64), hit]), axis=1)
    return np.bincount(docs, minlength=len(texts)), np.bincount(pairs[0].astype(np.int64), minlength=len(texts)), words


def _first_known(hashes: list[np.ndarray], lexicon: np.ndarray) -> np.ndarray:
    """The lexicon entry that each word is or begins with, else 0."""
    found = np.zeros(len(hashes[0]), np.uint64)
    for each in hashes:
        found = np.where((found == 0) & np.isin(each, lexicon), each, found)
    return found


def distinct_words(text: bytes | None) -> np.ndarray:
    """Hashes of all words and word beginnings of a text, each once."""
    hashes = np.unique(np.concatenate(hashed_prefixes(small_letters(text or b""), PREFIXES)[0]))
    return hashes[hashes > 0]


def learnable(chosen: DataFrame, base: float) -> np.ndarray:
    """Hashes that ``toxic_words`` may pick from (y, text): later picks can only lower a word's toxic share."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = [distinct_words(t) for t in raw_texts(batch.column(1))]
            words, at = np.unique(np.concatenate(docs), return_inverse=True)
            toxic = np.bincount(at, np.repeat(batch.column(0).to_numpy(), [len(d) for d in docs]), len(words))
            columns = [words.view(np.int64), toxic.astype(np.int64), np.bincount(at, minlength=len(words))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["word", "toxic", "n"])

    counts = chosen.select("y", "text").mapInArrow(count, "word bigint, toxic bigint, n bigint").groupBy("word")
    sums = counts.agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    usable = sums.where((F.col("toxic") >= LEAST_DOCUMENTS) & (F.col("toxic") / F.col("n") >= max(LEAST_SHARE, 2 * base)))
    return np.sort(np.array([r.word for r in usable.select("word").collect()], np.int64).view(np.uint64))


def toxic_words(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Hashes of words, each the best for the toxic documents that the earlier ones leave over, while one has enough of them."""
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    vocabulary, word = np.unique(np.concatenate(docs), return_inverse=True)
    n = len(vocabulary)
    clean = np.bincount(word, labels[owner] == 0, n)
    # A word that is no likelier in toxic documents than anywhere tells nothing.
    base = labels.mean()
    open_, picked = labels == 1, []
    while True:
        toxic = np.bincount(word, open_[owner], n)
        share = toxic / np.maximum(toxic + clean, 1)
        usable = (toxic >= LEAST_DOCUMENTS) & (share >= max(LEAST_SHARE, 2 * base))
        if not usable.any():
            break
        best = int(np.argmax(np.where(usable, toxic * np.log(np.maximum(share, 1e-9) / base), -1)))
        picked.append(best)
        open_[owner[word == best]] = False
    return np.sort(vocabulary[picked])


def fitted(documents: DataFrame, labels: DataFrame) -> Model | None:
    python_tasks(documents.sparkSession)
    costs = letter_costs([tuple(r) for r in triples(documents).collect()])

    spark = documents.sparkSession

    def words_of(rows: DataFrame, vocabulary: np.ndarray) -> list[np.ndarray]:
        """Distinct hashes of each text that are in the vocabulary."""
        sent = spark.sparkContext.broadcast(vocabulary)

        def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = [distinct_words(t) for t in raw_texts(batch.column(0))]
                words = [w[np.isin(w, sent.value)] for w in words]
                yield pa.RecordBatch.from_arrays([pa.array([w.tobytes() for w in words], pa.binary())], ["words"])

        return [np.frombuffer(r.words, np.uint64) for r in rows.select("text").mapInArrow(distinct, "words binary").collect()]

    chosen = sampled(documents, labels, "toxic", FOLDS, HELD_OUT, TRAIN_DOCUMENTS).select("y", "text")
    chosen = materialize(chosen, "labelled-texts")
    counts = {r.y: r["count"] for r in chosen.groupBy("y").count().collect()}
    if not counts.get(1) or not counts.get(0):
        return None
    vocabulary = learnable(chosen, counts[1] / (counts[0] + counts[1]))
    toxic, clean = (words_of(chosen.where(F.col("y") == y), vocabulary) for y in (1, 0))
    lexicon = toxic_words(toxic + clean, np.repeat([1, 0], [len(toxic), len(clean)]))
    bare = Model(costs, lexicon, np.zeros(5))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array(c, pa.int64()) for c in _measured(raw_texts(batch.column(1)), bare.words, bare)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["y", "hits", "each", "n"])

    measures = np.array([tuple(r) for r in chosen.mapInArrow(measure, "y int, hits bigint, each bigint, n bigint").collect()], np.int64)
    return Model(costs, lexicon, logistic(_inputs(*measures[:, 1:].T), measures[:, 0], prior=0.1))


def score_texts(model: Model | None, texts: list[bytes | None]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    return 1 / (1 + np.exp(-np.clip(_inputs(*_measured(texts, model.words, model)) @ model.weights, -30, 30)))


def scored(documents: DataFrame, model: Model | None, restore: bool = False) -> DataFrame:
    """(doc_id, score[, restored]) of every document."""
    python_tasks(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select("doc_id", "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw_texts(batch.column(1))
            columns, names = [batch.column(0), pa.array(score_texts(sent.value, texts), pa.float64())], ["doc_id", "score"]
            if restore:
                whole = [None if t is None else restored_text(t, sent.value) if sent.value else t.decode() for t in texts]
                columns, names = [*columns, pa.array(whole, pa.string())], [*names, "restored"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(score, f"doc_id {dict(rows.dtypes)['doc_id']}, score double" + (", restored string" if restore else ""))


def toxicity_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = scored(documents, fitted(documents, labels))
    return rows.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
