import random

import numpy as np
from pyspark.sql import functions as F

from meterlake.catalog import ANOMALY_FLAGS
from meterlake.operators.anomaly import cost_statistics, flag_cost_anomalies

ID = ["id"]


def frame(spark, groups):
    data = [
        (i, org, service, cost)
        for i, (org, service, cost) in enumerate((o, s, c) for (o, s), costs in groups.items() for c in costs)
    ]
    return spark.createDataFrame(data, "id bigint, org_id string, service string, cost_usd_increment double")


def brute_force(costs):
    """The flags of one group, from the definitions."""
    x = np.array(costs)
    pick = lambda values, p: np.sort(values)[max(int(np.ceil(p * len(values))) - 1, 0)]
    low, median, high = pick(x, 0.01), pick(x, 0.5), pick(x, 0.99)
    mad = pick(np.abs(x - median), 0.5)
    z = (x - x.mean()) / x.std() if x.std() else np.zeros_like(x)
    mz = 0.6745 * (x - median) / mad if mad else np.zeros_like(x)
    tests = [np.abs(z) > 3, (mad >= 0.01) & (np.abs(mz) > 3.5), (x < low) | (x > high), x > 2 * high]
    return np.array([*tests, np.any(tests, axis=0)]).T.tolist()


def test_flags_equal_brute_force(spark):
    pick = random.Random(7)
    groups = {
        ("o1", "compute"): [round(pick.expovariate(0.1), 2) for _ in range(400)] + [900.0, -50.0],
        ("o1", "genai"): [round(pick.gauss(20, 3), 2) for _ in range(250)],
        ("o2", "compute"): [5.0] * 30,
        ("o2", "storage"): [1.0],
    }
    flagged = flag_cost_anomalies(frame(spark, groups), spread_by=ID).orderBy("id").collect()
    found = [[r[f] for f in ANOMALY_FLAGS] for r in flagged]
    assert found == [flags for costs in groups.values() for flags in brute_force(costs)]
    assert any(f[4] for f in found)


def test_no_spread_means_no_anomaly(spark, rows):
    flagged = flag_cost_anomalies(frame(spark, {("o", "compute"): [3.0] * 200}), spread_by=ID)
    assert flagged.where("is_cost_anomaly").count() == 0


def test_mad_floor(spark):
    """A deviation below the floor is not used, at the floor it is."""
    for spread, expected in ((0.009, False), (0.02, True)):
        costs = [10 - spread, 10.0, 10 + spread] * 40 + [11.0]
        flagged = flag_cost_anomalies(frame(spark, {("o", "compute"): costs}), spread_by=ID)
        assert flagged.orderBy(F.desc("id")).first()["is_cost_anomaly_mad"] is expected


def test_the_percentile_itself_is_not_outside(spark, rows):
    costs = [float(i) for i in range(1, 201)]
    flagged = flag_cost_anomalies(frame(spark, {("o", "compute"): costs}), spread_by=ID)
    assert rows(flagged.where("is_cost_anomaly_percentile"), "cost_usd_increment") == [(1.0,), (199.0,), (200.0,)]


def test_rows_without_group_or_cost_get_false(spark, rows):
    df = frame(spark, {("o", None): [1.0, 2.0], ("o", "compute"): [1.0, None]})
    flagged = flag_cost_anomalies(df, spread_by=ID)
    assert rows(flagged, "is_cost_anomaly", "is_cost_anomaly_percentile") == [(False, False)] * 4


def test_statistics_of_another_population(spark, rows):
    df = frame(spark, {("o", "compute"): [1.0] * 49 + [1000.0]})
    calm = flag_cost_anomalies(df, spread_by=ID, population=df.where("cost_usd_increment < 10"))
    assert rows(calm.where("is_cost_anomaly_p99_x"), "cost_usd_increment") == [(1000.0,)]
    assert rows(flag_cost_anomalies(df, spread_by=ID).where("is_cost_anomaly_p99_x")) == []


def test_statistics_aggregate_before_the_shuffle(spark, plan):
    text = plan(cost_statistics(frame(spark, {("o", "compute"): [1.0]})))
    assert "partial_percentile_approx" in text
