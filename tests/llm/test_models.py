"""Chains against enumeration; the models on held-out rows and odd texts."""

import itertools
import math
import random
import zlib

import numpy as np
import pytest

from adtally.llm import langid, lines, quality, toxicity
from adtally.llm.common import table
from adtally.llm.crf import forward_backward
from adtally.llm.hashing import hashed_words, small_letters

SF = "/root/testdata/sf0.01"


def test_forward_backward_is_exact():
    rng = np.random.default_rng(2)
    lengths, states = np.array([4, 1, 0, 6, 2]), 3
    scores, step = rng.normal(size=(13, states)), rng.normal(size=(states, states))
    got, pairs = forward_backward(scores, lengths, step)
    want, want_pairs, at = np.zeros_like(scores), np.zeros_like(step), 0
    for n in lengths:
        total = 0.0
        own, own_pairs = np.zeros((n, states)), np.zeros_like(step)
        for path in itertools.product(range(states), repeat=int(n)) if n else ():
            w = np.exp(sum(scores[at + i, s] for i, s in enumerate(path)) + sum(step[a, b] for a, b in itertools.pairwise(path)))
            total += w
            for i, s in enumerate(path):
                own[i, s] += w
            for a, b in itertools.pairwise(path):
                own_pairs[a, b] += w
        if n:
            want[at:at + n] = own / total
            want_pairs += own_pairs / total
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_word_hashes():
    text = "Don't  x\tÉé\nx don't".encode()
    hashes, starts, ends = hashed_words(text)
    assert [text[a:b].decode() for a, b in zip(starts, ends, strict=True)] == ["Don't", "x", "Éé", "x", "don't"]
    assert hashes[0] == hashes[4] and hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3
    assert small_letters("Ab3É×ñ!".encode()).decode() == "ab é×ñ "


ODD = [(1, None), (2, ""), (3, "  \n\n "), (4, "?!"), (5, "é"), (6, "word " * 50_000), (None, "no id here"), (7, "same text"), (7, "same text"), (8, "12 — 34"), (9, "Привет мир")]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'en' as lang", "1 as score", "2 as y", "3 as held_out")


def with_odd(spark):
    known = table(spark, SF, "documents").select("doc_id", "text", "lang")
    return known.unionByName(odd(spark).selectExpr("doc_id + 100000 as doc_id", "text", "lang"))


@pytest.mark.parametrize("report", [toxicity.toxicity_report, quality.quality_report])
def test_scores_of_odd_rows(spark, report):
    labels = table(spark, SF, "labels").selectExpr("*", "'x' as text")
    rows = [r for r in report(with_odd(spark), labels).collect() if r.doc_id is None or r.doc_id > 100000]
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    empty = report(odd(spark), labels.limit(0)).collect()
    assert {r.score for r in empty} == {0.5} and len(empty) == len(ODD)
    assert report(odd(spark).limit(0), labels).collect() == []


def test_held_out_folds(spark):
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    for report, folds, out in ((quality.quality_report, 5, 0), (toxicity.toxicity_report, 4, 2)):
        for r in report(documents, labels).collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out)


def test_toxic_held_out(spark):
    path = "/root/testdata/sf0.1"
    labels = table(spark, path, "labels")
    rows = toxicity.toxicity_report(table(spark, path, "documents"), labels).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == t] for t in (1, 0))
    assert np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.02


def test_decoder(spark):
    """Leetspeak, spacing and repetition of a word that the corpus knows."""
    path = "/root/testdata/sf0.1"
    model = toxicity.fitted(table(spark, path, "documents"), table(spark, path, "labels"))
    for hidden in ("m0r0n", "m o r o n", "mooooron", "m-o-r-o-n", "1d10t", "i.d.i.o.t", "st*pid", "$tupid", "l0ser"):
        spans = toxicity.suspicious(f"The {hidden} of it".encode())
        words = [model.restored(f"The {hidden} of it"[a:b]) for a, b in spans]
        assert set(words) & {"moron", "idiot", "stupid", "loser"}, (hidden, words)
    assert toxicity.suspicious(b"The THE!! moron### plain, words. it a an") == []
    assert toxicity.restored_text(b"A m0r0n, 7 or so", model) == "A moron 7 or so"
    clean, hidden = toxicity.score_texts(model, [b"to the reand of it" * 9, b"to the reand of it " * 9 + b" 1d10t m0r0n l0ser"])
    assert clean < 0.3 <= hidden


def test_language(spark):
    documents = with_odd(spark)
    rows = langid.language_report(documents).collect()
    known = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    held = [r.lang_pred == known[r.doc_id] for r in rows if r.held_out and r.doc_id in known]
    assert np.mean(held) >= 0.97
    got = {r.doc_id and r.doc_id - 100000: r for r in rows if r.doc_id is None or r.doc_id > 100000}
    assert all(got[d].lang_pred == "und" and got[d].score == 0 for d in (1, 2, 3, 4, 8))
    assert all(got[d].lang_pred in {"en", "de", "fr", "es"} for d in (5, 6, 7, 9, None))
    none = langid.language_report(odd(spark).drop("lang").selectExpr("*", "cast(null as string) as lang")).collect()
    assert {r.lang_pred for r in none} == {"und"} and langid.language_report(odd(spark).limit(0)).collect() == []


def test_switched_text():
    """A text of two languages has shares near those of its parts; chains of long texts agree at their seams."""
    rows = [("en", b"the and that with from this have will been they " * 30), ("de", "und der die das nicht sich auch eine für über ".encode() * 30)]
    model = langid.train(rows * 3)
    shares = langid.shares(model, [b"the and that with from this have will been they " * 40 + "und der die das nicht sich auch eine für über ".encode() * 20])
    assert abs(shares[0, model.languages.index("en")] - 0.68) < 0.05
    long = rows[0][1] * 20
    assert langid.shares(model, [long])[0, model.languages.index("en")] > 0.99


def test_lines(spark):
    rows = [(i, f"own {i}\nshared\n\nshared", f"s{i % 6}") for i in range(1, 9)] + [
        (20, "few sites", "s1"), (21, "few sites", "s2"), (30, None, "s1"), (31, "", None), (None, "shared\nlast", None), (32, "shared", "s1"), (32, "shared", "s1"),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "length(text) as n_chars", "1 as line", "2 as first", "3 as at")
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in lines.deduped(documents).collect()), key=str)
    want = [(1, "own 1\nshared\n", 13)] + [(i, f"own {i}\n", 6) for i in range(2, 9)] + [
        (20, "few sites", 9), (21, "few sites", 9), (30, None, None), (31, "", 0), (None, "last", 4),
    ]
    assert got == sorted(want, key=str)
    report = {(r.doc_id, r.n_lines, r.n_removed) for r in lines.line_report(documents).collect()}
    assert {(1, 4, 1), (2, 4, 2), (30, 0, 0), (31, 1, 0), (32, 1, 1), (None, 2, 1)} <= report
    assert lines.line_report(documents.limit(0)).collect() == []


def test_sketches_far_from_the_limit(spark):
    """More sites than the sketch holds exactly: far lines by estimate, near ones by count."""
    sites = [(n, "wide\nnear" if n < 295 else "wide", f"s{n}") for n in range(3000)] + [(5000 + n, "near2", f"s{n}") for n in range(305)]
    documents = spark.createDataFrame(sites, "doc_id long, text string, source string")
    held = lines.lines_of(documents, "source")
    assert lines.boilerplate(held, 300).count() == 2


def test_toxic_words_deep_in_long_texts(spark):
    """Every toxic word lies behind thousands of harmless ones."""
    long = " ".join(f"w{n % 700}" for n in range(3000))
    rows = [(n, long + (" vilest" if n % 3 == 0 else " kindest"), int(n % 3 == 0)) for n in range(60)]
    table_ = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fitted(table_.drop("toxic"), table_.drop("text"))
    low, high = toxicity.score_texts(model, [long.encode() + b" kindest", long.encode() + b" vilest"])
    assert low < 0.3 <= high


def test_bad_lines_far_down(spark):
    """Bad documents begin like good ones; the field and its curve see their ends."""
    good, bad = "A plain line of text here.", "|||| $$$$ #### !!!! ||||"
    rows = [(n, "\n".join([good] * 220 + [bad if n % 2 else good] * 200), 1 - n % 2) for n in range(80)]
    table_ = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality.fitted(table_.drop("quality"), table_.drop("text"))
    whole, junk = quality.score_texts(model, [rows[0][1].encode(), rows[1][1].encode()])
    assert junk < quality.THRESHOLD <= whole


def test_fewer_documents_rather_than_parts(monkeypatch):
    monkeypatch.setattr(quality, "TRAIN_LINES", 100)
    monkeypatch.setattr(quality, "LEAST_EACH", 2)
    rows = [(n, int(n > 0), 30) for n in range(10)] + [(20, 0, 5), (21, 0, 5)]
    assert quality.enough(rows) == {0: 20, 1: 3} and quality.enough([]) == {}


def test_language_is_learned_from_all_of_a_text(spark):
    """A header of another language is longer than the old prefix of 1500 characters."""
    english, german = "the and that with from this have will been they ", "und der die das nicht sich auch eine für über "
    rows = [(n, english * 200, "en") for n in range(30)] + [(100 + n, english * 40 + german * 400, "de") for n in range(30)]
    model = langid.fitted(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    shares = langid.shares(model, [german.encode() * 20, english.encode() * 20])
    assert [model.languages[at] for at in shares.argmax(1)] == ["de", "en"] and shares.max(1).min() > 0.8
    text = " ".join(f"a{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}" for n in range(20_000)).encode()
    assert langid.drawn(text) == langid.drawn(text) and len(langid.drawn(text).split()) == langid.DRAWN * langid.DRAWN_WORDS


def test_words_in_spaced_out_runs_and_doubled_letters():
    """Words beside an insult are spaced out too; letters are doubled, not tripled."""
    prose = b"the man is a good one and you are what he will be, an idiot or moron or loser to hate; we need all committee books " * 50
    signs = toxicity._SIGN[np.frombuffer(prose, np.uint8)]
    counts = np.bincount((signs[:-2] * toxicity.SIGNS + signs[1:-1]) * toxicity.SIGNS + signs[2:])
    model = toxicity.Model(toxicity.letter_costs(list(enumerate(counts))), np.sort(hashed_words(b"moron idiot hate")[0]), np.zeros(5))

    def hits(text):
        return toxicity._measured([text], model.words, model)[0][0]

    for hidden in (b"he is a m o r o n", b"y o u i d i o t", b"a n i d i o t", b"I h a t e y o u", b"a 1 d 1 0 t i s", b"a m-o-r-o-n"):
        assert hits(hidden) == 1, hidden
    for hidden in (b"a moorron", b"iiddiioott"):
        assert hits(hidden) == 1, hidden
    assert hits(b"all good books we need, a committee of a b c d e f g") == 0
    assert toxicity.restored_text(b"he is a m o r o n", model) == "he is a moron"
    assert toxicity.restored_text(b"the committee needs good moorron books", model) == "the committee needs good moron books"


def test_words_of_mixed_texts_have_their_language(spark):
    """Runs cover all words in order, in the original text, and change where the language does."""
    english = "the and that with from this have will been they which would there their about "
    german = "und der die das nicht sich auch eine für über werden wurde nach durch große "
    rows = [(f"{'en' if i % 2 else 'de'}", ((english if i % 2 else german) * (3 + i % 5)).encode()) for i in range(60)]
    model = langid.train(rows)
    mixed = "Über " + german + "- " + english.upper() + "ÄÖÜ! 12 " + german
    table = spark.createDataFrame([(1, mixed), (2, None), (3, "12 !"), (4, "")], "doc_id long, text string").selectExpr("*", "'x' as spans")
    got = {r.doc_id: r.spans for r in langid.word_languages(table, model).collect()}
    assert got[2] == got[3] == got[4] == []
    spans = got[1]
    assert [s.lang for s in spans][:2] == ["de", "en"] and spans[-1].lang == "de"
    assert mixed[spans[0].start:].startswith("Über und") and mixed[spans[1].start:].startswith("THE AND") and mixed[:spans[-1].end].endswith("große")
    assert all(a.end < b.start for a, b in zip(spans, spans[1:], strict=False)) and all(0.5 <= s.score <= 1.0001 for s in spans)
    assert sum(s.words for s in spans) == len(langid.small_letters(mixed.encode()).split())
    assert langid.word_languages(table, None).where("size(spans) > 0").isEmpty()


def test_every_language_has_its_own_lexicon():
    rows = [(f"l{n}", " ".join(f"w{n}x{i % 9}" for i in range(400)).translate(str.maketrans("0123456789", "abcdefghij")).encode()) for n in range(12)]
    model = langid.train(rows)
    assert len(model.lexicon) == 12 * 9


def every_reading(token, costs, ends_words):
    """(cost, word) of all paths of a token's lattice, with the rules written out once more."""
    found, text = [], token.lower()

    def go(at, a, b, cost, word):
        if at == len(text):
            found.append((cost + costs[a, b, 0], word.strip()))
            return
        char = text[at]
        again = at > 0 and text[at - 1] == char
        if "a" <= char <= "z":
            go(at + 1, b, ord(char) - 96, cost + costs[a, b, ord(char) - 96], word + char)
            if again and b == ord(char) - 96:
                go(at + 1, a, b, cost + toxicity.REPEAT, word)
            return
        letters = toxicity.LEET.get(char, "")
        for c in letters:
            go(at + 1, b, ord(c) - 96, cost + toxicity.SUBSTITUTE + math.log(len(letters)) + costs[a, b, ord(c) - 96], word + c)
        silent = toxicity.SEPARATE if char in toxicity.SEPARATORS or not char.isascii() else toxicity.LEAVE_OUT
        if again and any(ord(c) - 96 == b for c in letters):
            silent = min(silent, toxicity.REPEAT)
        go(at + 1, a, b, cost + silent, word)
        if ends_words and char in toxicity.SEPARATORS and b:
            go(at + 1, b, 0, cost + costs[a, b, 0], word + " ")

    go(0, 0, 0, 0.0, "")
    return found


def test_decoder_finds_the_cheapest_of_all_paths():
    rng = random.Random(8)
    counts = [(rng.randrange(toxicity.SIGNS ** 3), rng.randint(1, 500)) for _ in range(4000)]
    costs = toxicity.letter_costs(counts)
    tokens = ["", "a", "1", "m0r0n", "i d i o t", "$tup1d", "aaa", "!!1", "é", "h-a-t-e", "**"]
    tokens += ["".join(rng.choice("abim01!$| .-*3aé") for _ in range(rng.randint(1, 8))) for _ in range(300)]
    for token in tokens:
        for ends_words in (False, True):
            paths = every_reading(token, costs, ends_words)
            cheapest = min(cost for cost, _ in paths)
            word = toxicity.decode(token, costs, ends_words)
            assert min(cost for cost, w in paths if w == word) <= cheapest + 1e-9, (token, word)
