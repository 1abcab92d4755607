import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from adtally.operators import anomaly, profiles

SCHEMA = "user_id string, ip string, time_i long, width int, height int, d string"


def seconds(day, hour):
    return int(dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc).timestamp())


def bids(spark, rows):
    return spark.createDataFrame(
        [(user, ip, seconds(day, hour), w, h, f"202401{day:02d}") for user, ip, day, hour, w, h in rows], SCHEMA
    )


def sample(n=400):
    """Random views; one device and one address make up a third of them each."""
    random.seed(1)
    rows = []
    for i in range(n):
        user = "d-0" if i % 3 == 0 else f"d-{random.randint(1, 12)}"
        ip = "ip0" if i % 3 == 1 else random.choice([f"ip{random.randint(1, 9)}", None])
        rows.append((user, ip, random.randint(1, 5), random.randint(0, 23), 640, 480))
    return rows


def half_up(a, b):
    return (200 * a + b) // (2 * b) / 100


def brute(rows, key, partner):
    out = {}
    for k in {r[key] for r in rows}:
        mine = [r for r in rows if r[key] == k]
        days = {r[2] for r in mine}
        hours = {r[3] for r in mine}
        partners = {r[partner] for r in mine}
        out[k] = (
            len(partners), len(mine),
            max(len({r[partner] for r in mine if r[2] == d}) for d in days),
            max(sum(r[2] == d for r in mine) for d in days), len(days), hours,
        )
    return out


def test_profiles_against_brute_force(spark):
    rows = sample()
    usage = profiles.device_usage(bids(spark, rows))
    want = {
        k: (p, n, pm, nm, days, half_up(n, days), half_up(n, p), len(hours), half_up(p, days))
        for k, (p, n, pm, nm, days, hours) in brute(rows, 0, 1).items()
    }
    got = {r[0]: tuple(r)[1:] for r in profiles.device_profile(usage).collect()}
    assert got == want
    want = {
        k: (p, n, nm, days, half_up(n, days), sum(1 << h for h in hours))
        for k, (p, n, pm, nm, days, hours) in brute(rows, 1, 0).items()
    }
    got = {r[0]: tuple(r)[1:] for r in profiles.ip_profile(usage).collect()}
    assert got == want


def test_usage_filters(spark):
    rows = bids(spark, [
        ("d-1", "a", 1, 0, 640, 480), ("d-1", "a", 1, 0, 640, 481), ("imei", "a", 1, 0, 640, 480),
        (None, "a", 1, 0, 640, 480), ("d-1", "a", 2, 3, 640, 480),
    ])
    assert [(r.idfa, r.ip, r.videos, r.mask) for r in profiles.device_usage(rows, "20240101", "20240101").collect()] == [("d-1", "a", 1, 1)]
    assert profiles.device_usage(rows).count() == 2


def test_hour_mask(spark):
    rows = bids(spark, [("d-1", "a", 1, h, 640, 480) for h in (0, 0, 3)])
    assert profiles.ip_profile(profiles.device_usage(rows)).first().hour_mask == 9


def density(x, mean, var):
    return math.exp(-((x - mean) ** 2) / (2 * var)) / math.sqrt(2 * math.pi * var)


def test_scores(spark):
    data = [("a", 1.0, 5.0, 7.0), ("b", 2.0, 5.0, 9.0), ("c", 4.0, 5.0, 8.5)]
    profile = spark.createDataFrame(data, "id string, x double, flat double, y double")
    got = {r.name: r for r in anomaly.scores(profile, "id", ["x", "flat", "y"], ["x", "flat", "y"]).collect()}
    stats = []
    for i in (1, 3):
        column = [r[i] for r in data]
        mean = sum(column) / 3
        stats.append((mean, sum((v - mean) ** 2 for v in column) / 3))
    for name, x, _, y in data:
        want = density(x, *stats[0]) * density(y, *stats[1])
        assert got[name].ln_flat is None
        assert got[name].probability == pytest.approx(want)
        assert got[name].ln_joint == pytest.approx(math.log(want))


def test_scores_do_not_underflow(spark):
    rows = [(str(i), 0.0) for i in range(5000)] + [("far", 1e6)]
    profile = spark.createDataFrame(rows, "id string, x double")
    far = anomaly.scores(profile, "id", ["x"], ["x"]).where("name = 'far'").first()
    assert far.ln_joint < -2000 and far.probability == 0.0


def bins_by_search(values, parts):
    """Upper edge of each value by binary search over the list of edges."""
    top = max(values)
    edges = [i * top / parts for i in range(parts)] + [top]

    def index(x):
        if x == 0:
            return 1
        low, high = 0, parts
        while low <= high:
            mid = (low + high) // 2
            if x > edges[mid]:
                low = mid + 1
            elif x < edges[mid]:
                high = mid - 1
            else:
                return mid
        return low

    counts = {}
    for v in values:
        counts[index(v)] = counts.get(index(v), 0) + 1
    return [(i, edges[i], n) for i, n in sorted(counts.items(), reverse=True)]


@pytest.mark.parametrize("parts", [1, 2, 3, 7, 20])
def test_histogram(spark, parts):
    random.seed(parts)
    top = 0.2611596261244592
    values = [0.0, top, top / 3] + [i * top / parts for i in range(parts)] + [random.random() * top for _ in range(300)]
    frame = spark.createDataFrame([(v,) for v in values], "probability double")
    got = [tuple(r) for r in anomaly.histogram(frame, parts).collect()]
    assert got == bins_by_search(values, parts)
    assert sum(n for _, _, n in got) == len(values)


def test_histogram_small_cases(spark):
    frame = spark.createDataFrame([(v,) for v in (0.0, 0.5, 1.0, 2.0)], "probability double")
    assert [tuple(r)[1:] for r in anomaly.histogram(frame, 2).collect()] == [(2.0, 1), (1.0, 3)]
    zero = spark.createDataFrame([(0.0,), (0.0,)], "probability double")
    assert [(r.bin, r.n) for r in anomaly.histogram(zero, 4).collect()] == [(1, 2)]


def test_blocklists(spark):
    ips = spark.createDataFrame([("1", 5, 50), ("2", 50, 5), ("3", 5, 5)], "ip string, vcount long, idfacount long")
    assert sorted(map(tuple, anomaly.ip_blocklist(ips, 10, 10).collect())) == [("blk:1", 5, 50), ("blk:2", 50, 5)]
    devices = spark.createDataFrame([("a", 5), ("b", 11)], "idfa string, vcount long")
    blocked = anomaly.with_expiry(anomaly.device_blocklist(devices, 10), "20240131")
    assert list(map(tuple, blocked.collect())) == [("b", 11, "20240301")]
    scored = spark.createDataFrame([("a", 0.1), ("b", 0.3), ("c", None)], "name string, probability double")
    assert [r.name for r in anomaly.low_probability(scored, 0.2, "blk:").collect()] == ["blk:a"]


def test_statistics_are_computed_once(spark):
    profile = spark.range(10).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("x"))
    plan = anomaly.scores(profile, "k", ["x"], ["x"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") == 1
    assert "Join" not in plan
