"""The stages against plain Python versions, each on the whole result of the one before."""

import re
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from adtally.llm import lines, packing, quality
from adtally.llm.common import table
from tests.llm.test_neardup import brute
from tests.llm.test_packing import check

SF = "/root/testdata/sf0.01"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_lines(rows):
    sites, first = defaultdict(set), {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        for line in r.text.split("\n"):
            sites[line].add(r.source)
            first.setdefault(line, r.doc_id)
    kept = {}
    for r in rows:
        seen, rest, gone = set(), [], 0
        for line in r.text.split("\n"):
            wide = re.search(r"[^ \t\n\v\f\r]", line) and len(sites[line]) >= lines.MIN_SITES
            if wide and (first[line] != r.doc_id or line in seen):
                gone += 1
            else:
                rest.append(line)
            seen.add(line)
        text = "\n".join(rest)
        if not gone or text.strip(" \t\n\v\f\r"):
            kept[r.doc_id] = text
    return kept


def plain_words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def plain_clean(texts, items):
    sets = defaultdict(set)
    for item in items:
        w = plain_words(item)
        for at in range(max(1, len(w) - 9) if w else 0):
            sets[len(w[at:at + 10])].add(tuple(w[at:at + 10]))
    kept = set()
    for d, text in texts.items():
        w = plain_words(text)
        if not any(tuple(w[i:i + k]) in windows for k, windows in sets.items() for i in range(len(w) - k + 1)):
            kept.add(d)
    return kept


def test_stages(spark):
    documents = table(spark, SF, "documents")
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        given = docs
        out[name] = (given.collect(), stage(spark, given, SF).collect())
        if name != "packing":
            result = stage(spark, given, SF)
            assert result.columns == documents.columns and result.dtypes == documents.dtypes
            path = corpus_pipeline.materialize(result, "test-stage")
            docs = path
    before, after = out["quality"]
    model = quality.fitted(documents, table(spark, SF, "labels"))
    scores = quality.score_texts(model, [r.text.encode() for r in before])
    assert {r.doc_id for r in after} == {r.doc_id for r, s in zip(before, scores, strict=True) if s >= quality.THRESHOLD}
    before, after = out["lines"]
    assert {r.doc_id: r.text for r in after} == plain_lines(before)
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = out["near_duplicates"]
    groups = brute([(r.doc_id, r.text) for r in before], corpus_pipeline.SHINGLE_WORDS)
    assert {r.doc_id for r in after} == {d for d, (_, c) in groups.items() if c == d} and len(after) < len(before)
    before, after = out["decontamination"]
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert {r.doc_id for r in after} == plain_clean({r.doc_id: r.text for r in before}, items) and len(after) < len(before)
    _, after = out["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    assert check(spark, tokenizer, docs, after) > 0.95


def test_good_documents_stay(spark):
    """Of the labelled documents that the model has not seen, nearly all good ones stay and bad ones go."""
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    report = quality.quality_report(documents, labels).where("held_out").join(labels, "doc_id")
    counts = {(r.quality, r.predicted): r["count"] for r in report.groupBy("quality", "predicted").count().collect()}
    good, bad = (counts.get((q, q), 0) / (counts.get((q, 0), 0) + counts.get((q, 1), 0)) for q in (1, 0))
    assert good >= 0.97 and bad >= 0.85


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"doc_id", "sequence_id", "offset", "length"} <= set(rows[0].asDict())


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None), (1, None, None, None, None), (None, "", "x", None, 0)]])
def test_odd_rows(spark, tmp_path, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, length int, line int, score double, _row int"
    docs = spark.createDataFrame([(*r, 1, 2, 3.0, 4) for r in rows], schema)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, str(tmp_path))
        assert result.count() == len(rows)
        if name != "packing":
            assert result.columns == docs.columns
            docs = result


def test_clashing_columns_pass_through(spark, tmp_path):
    """Names that the stages use themselves, with values that must come out as they went in."""
    names = ["_id", "_text", "_drop", "_drop_id", "_drop_text", "_n_lines", "_n_removed", "_lines", "_score", "_gone", "_hits", "_words", "_items", "a.b"]
    wanted = [f"'{n}' as `{n}`" for n in names]
    rows = [(i, f"shared line\nown words of number {i} and {i * 7} more {i * 31}", f"site{i}") for i in range(7)] + [(9, "one two three four", "s"), (10, "one two three four", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'en' as lang", "length(text) as n_chars", *wanted)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "own words of number 3 and 21 more 93")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    counts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, str(tmp_path))
        assert result.columns == docs.columns
        found = result.collect()
        assert all(r[n] == n for r in found for n in names)
        counts[name], docs = len(found), corpus_pipeline.materialize(result, "clash")
        if name == "lines":
            assert sorted(r.doc_id for r in found if "shared line" in r.text) == [0]
    assert counts == {"quality": 9, "lines": 9, "near_duplicates": 8, "decontamination": 7}


def test_texts_of_a_shared_id_are_kept(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (2, long), (2, "a unique text that nothing else resembles at all"), (1, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([rows[0], rows[3], rows[2]])
