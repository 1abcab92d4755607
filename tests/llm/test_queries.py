"""The registered queries against their SQL twins, and the form of all results."""

import pytest

from adtally.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_twin(spark, name):
    differences, rows = compare(spark, connect(SF), name, SF)
    assert not differences and rows


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))


FORMS = {
    "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.mark.parametrize("name", list(FORMS))
def test_scores(spark, name):
    rows = QUERIES[name](spark, SF)
    assert dict(rows.dtypes) == FORMS[name]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows.count() == documents.count()
    assert rows.where("score is null or score < 0 or score > 1").isEmpty()


def test_pii_stays_in_the_engine(spark):
    plan = QUERIES["op2_pii"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
