"""Alignment against a plain walk over both token lists."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adtally.llm import alignment
from adtally.llm.queries import op12_token_alignment

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "a", " lead", "trail ", "two  blanks   three", "line\nnext\n\nafter\r\n\ttab \n x", "▁mark", "a▁b", "it's  'LL",
    "<|endoftext|> <s> </s> <unk> <0x0A>", "é ﬁ ½ 　 x y ​", "a\x00b", "x!\x1cy \x1f", "x" * 3000, "日本語 テキスト 中文", "🙂🙃 ok🙂",
    "ab " * 2000, "Mixed ÄÖü слово 12,345.67", "\n", "\t \n", "a b \u0085c", "!\x1c \x1d?",
    "a;\r\n{\r b\t\tc \td", "x" + " " * 5000 + "y", " \n" * 3000,
]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain(both, text):
    """(A ids, B ids, groups, links) by walking along; empty where the bytes differ."""
    a, b = both
    if not text:
        return [], [], [], []
    letters = alignment._byte_letters()
    found = a.encode(" " + text, add_special_tokens=False)
    a_ids, a_parts = found.ids, [bytes(letters[c] for c in token) for token in found.tokens]
    b_ids = b.encode(text)
    b_parts = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids
    ]
    if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
        return [], [], [], []
    groups, links, own, i, j, at_a, at_b = [], [], ([], []), 0, 0, 0, 0
    while i < len(a_ids) and j < len(b_ids):
        links.append((a_ids[i], b_ids[j]))
        a_end, b_end = at_a + len(a_parts[i]), at_b + len(b_parts[j])
        if a_end <= b_end:
            own[0].append(a_ids[i])
        if b_end <= a_end:
            own[1].append(b_ids[j])
        if a_end == b_end:
            groups.append(own)
            own = ([], [])
        i, at_a = (i + 1, a_end) if a_end <= b_end else (i, at_a)
        j, at_b = (j + 1, b_end) if b_end <= a_end else (j, at_b)
    return a_ids, b_ids, groups, links


def expected(both, rows):
    found = [(doc_id, *plain(both, text)) for doc_id, text in rows]
    counts = Counter(pair for *_, links in found for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    result = []
    for doc_id, a, b, groups, links in found:
        listing = ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in groups)
        result.append((
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(listing.encode()).hexdigest() if a else "",
        ))
    return result, counts, most


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def listed(result):
    return sorted((tuple(r[c] for c in COLUMNS) for r in result.collect()), key=str)


def test_query(spark, both):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    result = op12_token_alignment(spark, SF)
    assert result.columns == COLUMNS
    assert listed(result) == sorted(expected(both, rows)[0], key=str)


def test_odd_texts_need_no_other_ids(both):
    """The encoder by ranks gives what the tokenizer gives; so does the tokenizer for long runs of white space."""
    tokens = alignment.Tokens(None, None)
    assert tokens.ranks is not None
    for text in [*ODD, *(f"{x}{y}{x}" for x in ODD if x and len(x) < 100 for y in (" ", "\n", "", "  "))]:
        a, b, *_ = plain(both, text)
        found = tokens.ids(text)
        got = ([], []) if found is None else (np.frombuffer(found[0], "<u2").tolist(), np.frombuffer(found[1], "<u2").tolist())
        assert got == (a, b), repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab,.'s1 \n\t\r") + ["é", " ", "▁", "日", "🙂", "\x1c", " ", "\x00"]), max_size=25))
def test_any_text_needs_no_other_ids(both, text):
    tokens = test_any_text_needs_no_other_ids.__dict__.setdefault("tokens", alignment.Tokens(None, None))
    a, b, *_ = plain(both, text)
    found = tokens.ids(text)
    assert ([], []) == (a, b) if found is None else [np.frombuffer(f, "<u2").tolist() for f in found] == [a, b]


@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.lists(st.integers(1, 5), min_size=1, max_size=40), st.integers(1, 9))
def test_crossings(a, b, step):
    a_ends, b_ends = np.cumsum(a), np.cumsum(b)
    merged = sorted([(e, 0) for e in a_ends.tolist()] + [(e, 1) for e in b_ends.tolist()])
    diagonals = np.arange(0, len(merged) + 1, step)
    want = [sum(side == 0 for _, side in merged[:d]) for d in diagonals]
    assert alignment.crossings(a_ends, b_ends, diagonals).tolist() == want


@pytest.mark.parametrize("work", [2, 7, 1 << 20])
def test_pieces_of_any_size_give_the_same(spark, both, work):
    """Documents cut into many pieces, groups that cross them; repeated rows, a null id, clashing columns."""
    rows = [(n, text[:300] if text else text) for n, text in enumerate(ODD)]
    rows += [(None, "no id here"), (4, "a"), (4, "a"), (4, "another text of that id")]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as piece", "'z' as row", "2 as pair", "3 as groups")
    want, counts, most = expected(both, rows)
    result = alignment.alignment_report(table.repartition(3), work=work, groups=True)
    assert listed(result.drop("groups")) == sorted(want, key=str)
    for r in result.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "") and (r.n_a or r.groups == "")
    if work == 7:
        words = {(r.a, r.b): (r.documents, r.best) for r in alignment.lexicon(table, work=work).collect()}
        assert words == {p: (n, n == most[p[0]]) for p, n in counts.items()}


def test_long_text(spark, both):
    text = "".join(f"word{i % 977} 日本🙂{i}\n" for i in range(30000))
    table = spark.createDataFrame([(1, text), (2, "word1 日本")], "doc_id long, text string")
    assert listed(alignment.alignment_report(table, work=1 << 14)) == sorted(expected(both, [(1, text), (2, "word1 日本")])[0], key=str)


def test_empty_table_and_text_keys(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment_report(empty).collect() == []
    named = spark.createDataFrame([("x", None), ("y", "a b")], "doc_id string, text string")
    assert {r.doc_id: r.n_a for r in alignment.alignment_report(named).collect()} == {"x": 0, "y": 2}
