import random

import pytest
from pyspark.sql import functions as F

from adtally.operators import ctr, features
from adtally.session import materialize
from adtally.sinks.exports import save_model
from adtally.sinks.files import write_lines
from adtally.sources.models import load_model, read_libsvm
from adtally.sources.packs import read_feature_columns, read_feature_index

COLUMNS = [("subchannel", "sc"), ("creative_id", "cr")]
SCHEMA = "click_uuid string, subchannel string, creative_id string, request_time long"


def rows(spark):
    return spark.createDataFrame([
        ("1", "N", "x", 1), ("2", "A", "y", 1), ("3", None, "x", 0), ("4", "Z", "z", None), ("5", "A", "a,b", 2),
    ], SCHEMA)


def test_index(spark):
    index = features.feature_index(features.feature_values(rows(spark), COLUMNS))
    got = [r.feature for r in index.orderBy("idx").collect()]
    assert got == ["sc_A", "sc_N", "cr_a,b", "cr_x", "cr_y"]
    assert sorted(r.idx for r in index.collect()) == [1, 2, 3, 4, 5]


def test_index_is_dense_over_many_slices(spark):
    frame = spark.range(20_000).select(
        F.concat(F.lit("v"), F.col("id")).alias("subchannel"), F.lit(None).cast("string").alias("creative_id"), F.lit(1).alias("request_time")
    )
    values = features.feature_values(frame, COLUMNS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = features.feature_index(values).orderBy("idx").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.idx for r in index] == list(range(1, 20_001))
    names = [r.feature for r in index]
    assert names == sorted(names)


def test_labels_and_duplicates(spark):
    conversions = spark.createDataFrame([("1", "d"), ("1", "d"), ("9", "d")], "format_uuid string, d string")
    got = features.labelled_rows(rows(spark), conversions)
    assert sorted((r.click_uuid, r.label) for r in got.collect()) == [("1", 1), ("1", 1), ("2", 0), ("3", 0), ("5", 0)]
    single = features.labelled_rows(rows(spark), conversions, dedupe=True)
    assert single.columns == got.columns
    assert sorted((r.click_uuid, r.label) for r in single.collect()) == [("1", 1), ("2", 0), ("3", 0), ("5", 0)]


def test_hot_click_is_labelled_whole(spark):
    """A third of the deliveries belong to one click, converted twice."""
    hot = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("click_uuid"),
        F.col("id").cast("string").alias("subchannel"), F.lit("x").alias("creative_id"), F.lit(1).alias("request_time"),
    )
    conversions = spark.createDataFrame([("hot",), ("hot",), ("1",)], "format_uuid string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        once = features.labelled_rows(hot, conversions, dedupe=True)
        plan = once._jdf.queryExecution().executedPlan().toString()
        sides = [line.strip(" :+-") for line in plan[plan.index("SortMergeJoin"):].splitlines()[1:]]
        right = [i for i, line in enumerate(sides) if line.startswith("Sort [")]
        assert all(sides[i + 1].startswith("Exchange") for i in right) and len(right) == 2
        assert sorted((r.label, r["count"]) for r in once.groupBy("label").count().collect()) == [(0, 599), (1, 301)]
        assert features.labelled_rows(hot, conversions).count() == 1200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines(spark, tmp_path):
    index = spark.createDataFrame([("cr_x", 1), ("sc_A", 2), ("sc_N", 3)], "feature string, idx long")
    labelled = rows(spark).withColumn("label", F.lit(1))
    lines = features.libsvm_lines(features.encode(labelled, index, COLUMNS))
    assert sorted(r.value for r in lines.collect()) == ["1", "1 1:1", "1 1:1 3:1", "1 2:1", "1 2:1"]
    write_lines(lines, str(tmp_path / "rows"))
    back = read_libsvm(spark, str(tmp_path / "rows"), 3)
    assert sorted(str(r.features) for r in back.collect()) == ["(3,[0,2],[1.0,1.0])", "(3,[0],[1.0])", "(3,[1],[1.0])", "(3,[1],[1.0])", "(3,[],[])"]


def test_configuration_files(spark, tmp_path):
    (tmp_path / "columns").write_text("subchannel,sc\ncreative_id,cr\n")
    assert features.column_list(read_feature_columns(spark, str(tmp_path / "columns"))) == COLUMNS
    index = spark.createDataFrame([("cr_a,b", 7)], "feature string, idx long")
    write_lines(features.index_lines(index), str(tmp_path / "index"))
    assert read_feature_index(spark, str(tmp_path / "index")).collect() == index.collect()


def test_model(spark, tmp_path):
    random.seed(2)
    texts = [(f"{int(random.random() < (0.9 if i % 2 else 0.1))} {1 + i % 2}:1",) for i in range(600)]
    write_lines(spark.createDataFrame(texts, "value string"), str(tmp_path / "rows"))
    trained = ctr.train(read_libsvm(spark, str(tmp_path / "rows"), 2))
    assert trained.area_under_roc > 0.8 and trained.area_under_pr > 0.7
    assert trained.model.intercept == 0.0
    index = materialize(spark.createDataFrame([("sc_A", 1), ("sc_N", 2)], "feature string, idx long"), "index")
    weights = {r.feature: r.weight for r in ctr.weights(spark, trained.model, index, "m").collect()}
    assert weights["sc_A"] < -1 and weights["sc_N"] > 1
    save_model(spark, trained, str(tmp_path / "model"))
    assert load_model(str(tmp_path / "model" / "model")).coefficients == trained.model.coefficients
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "model" / "auc")).collect())
    assert [text.split("=")[0] for text in lines] == ["auPRC", "auROC"]
    assert float(lines[1].split("=")[1]) == pytest.approx(trained.area_under_roc)


def test_encode_joins_once(spark):
    """The number of exchanges does not depend on the number of columns."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = []
        for n in (1, 10):
            names = [f"c{i}" for i in range(n)]
            rows = spark.range(20).select(F.lit(1).alias("label"), *[F.col("id").cast("string").alias(c) for c in names])
            index = spark.createDataFrame([(f"{c}_{v}", i * 20 + v + 1) for i, c in enumerate(names) for v in range(20)], "feature string, idx long")
            encoded = features.encode(rows, index, [(c, c) for c in names])
            assert sorted(len(r.indices) for r in encoded.collect()) == [n] * 20
            counts.append(encoded._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        assert counts[0] == counts[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_equal_rows_are_encoded_once(spark, monkeypatch):
    """They come back as often as they were there, in more than one sequence and task."""
    monkeypatch.setattr(features, "CHUNK", 7)
    rows = spark.range(0, 200, 1, 3).select((F.col("id") % 2).cast("int").alias("label"), F.lit("a").alias("c"))
    index = spark.createDataFrame([("s_a", 1)], "feature string, idx long")
    encoded = features.encode(rows, index, [("c", "s")])
    assert sorted((r.label, r.indices, r["count"]) for r in encoded.groupBy("label", "indices").count().collect()) == [(0, [1], 100), (1, [1], 100)]
    assert len([n for n in encoded.rdd.glom().map(len).collect() if n]) > 1


def test_rows_are_read_once_for_a_fit(spark, tmp_path):
    """A fit and its measures pass over distinct rows; all rows are read by one pass."""
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    random.seed(3)
    texts = [(f"{int(random.random() < (0.9 if i % 2 else 0.1))} {1 + i % 2}:1",) for i in range(400)]
    write_lines(spark.createDataFrame(texts, "value string"), str(tmp_path / "rows"))
    watched = F.udf(count, "double").asNondeterministic()
    rows = read_libsvm(spark, str(tmp_path / "rows"), 2).select(watched("label").alias("label"), "features")
    trained = ctr.train(rows)
    assert seen.value == 400 and trained.area_under_roc > 0.8
    index = spark.createDataFrame([("sc_A", 1), ("sc_N", 2)], "feature string, idx long")
    plain = read_libsvm(spark, str(tmp_path / "rows"), 2)
    means = [
        sorted((r.feature, round(r.mean_label, 9), round(r.mean_score, 9)) for r in ctr.feature_means(trained.model, part, index).collect())
        for part in (plain, ctr.equal_rows(plain))
    ]
    assert means[0] == means[1] and len(means[0]) == 2
