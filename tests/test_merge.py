from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adtally.operators import merge

SCHEMA = "k string, j int, n long, v decimal(20,4)"
KEYS, MEASURES = ["k", "j"], ["n", "v"]


def frame(spark, rows):
    return spark.createDataFrame([(k, j, n, None if n is None else Decimal(n)) for k, j, n in rows], SCHEMA)


def bag(df):
    return sorted(((r.k, r.j, r.n, float(r.v)) for r in df.collect()), key=str)


def test_new_and_known_keys(spark):
    target = frame(spark, [("k1", 1, 5)])
    delta = frame(spark, [("k1", 1, 2), ("k2", 1, 1)])
    merged = merge.additive_merge(target, delta, KEYS, MEASURES)
    assert bag(merged) == [("k1", 1, 7, 7.0), ("k2", 1, 1, 1.0)]
    assert merged.schema["v"].dataType == target.schema["v"].dataType
    assert bag(merge.new_rows(delta, target, KEYS)) == [("k2", 1, 1, 1.0)]
    assert bag(merge.updated_rows(delta, target, KEYS, MEASURES)) == [("k1", 1, 7, 7.0)]
    beside = {(r.k, r.n, r.stored_n) for r in merge.stored_beside(delta, target, KEYS, MEASURES).collect()}
    assert beside == {("k1", 2, 5), ("k2", 1, None)}


def test_null_keys_are_keys(spark):
    target, delta = frame(spark, [(None, None, 5)]), frame(spark, [(None, None, 2), (None, 1, 3)])
    assert bag(merge.additive_merge(target, delta, KEYS, MEASURES)) == [(None, 1, 3, 3.0), (None, None, 7, 7.0)]
    assert bag(merge.new_rows(delta, target, KEYS)) == [(None, 1, 3, 3.0)]
    assert bag(merge.updated_rows(delta, target, KEYS, MEASURES)) == [(None, None, 7, 7.0)]


def test_one_source_for_both_sides(spark):
    rows = frame(spark, [("a", 1, 1), ("b", 2, 2)])
    target, delta = rows.where("j = 1"), rows
    assert bag(merge.new_rows(delta, target, KEYS)) == [("b", 2, 2, 2.0)]
    assert bag(merge.updated_rows(delta, target, KEYS, MEASURES)) == [("a", 1, 2, 2.0)]


def test_counted_sides_are_added_in_tasks_of_their_own(spark):
    """The hash tables of the merge are not in the tasks that still hold those of the aggregates."""
    rows = frame(spark, [("a", 1, 1), ("b", 2, 2), (None, 2, 3)])
    sides = [rows.where(where).groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("v").alias("v")) for where in ("j > 0", "j = 2")]
    merged = merge.additive_merge(*sides, KEYS, MEASURES, counted=True)
    assert bag(merged) == [("a", 1, 1, 1.0), ("b", 2, 4, 4.0), (None, 2, 6, 6.0)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    above = plan[plan.index("== Initial Plan ==") if "== Initial Plan ==" in plan else 0:]
    assert "REPARTITION_BY_NUM" in above[:above.index("Union")]


ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2), st.integers(-9, 9)), max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(t=ROWS, a=ROWS, b=ROWS)
def test_merging_twice_is_merging_the_union(spark, t, a, b):
    t, a, b = (frame(spark, rows) for rows in (t, a, b))
    twice = merge.additive_merge(merge.additive_merge(t, a, KEYS, MEASURES), b, KEYS, MEASURES)
    once = merge.additive_merge(t, a.unionByName(b), KEYS, MEASURES)
    assert bag(twice) == bag(once)
