from fractions import Fraction

import statistics

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyward.operators import running, skew, stats
from tallyward.plans import features


@pytest.fixture
def hot(spark):
    """One user and the null user hold most rows."""
    rows = [
        (f"T{i:05d}", "HOT" if i % 3 == 0 else None if i % 3 == 1 else f"U{i % 17}", float(i % 97) + 0.25, i % 5 == 0,
         f"2024-01-{1 + i % 28:02d} {i % 24:02d}:{i % 60:02d}:00")
        for i in range(1200)
    ]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, amount double, is_vpn boolean, t string")
    return df.withColumn("ts", F.to_timestamp_ntz("t")).drop("t").repartition(5)


def test_against_plain_python(spark, hot):
    by_user = {}
    for r in hot.collect():
        by_user.setdefault(r.user_id, []).append(r)
    got = {r.user_id: r for r in stats.user_stats(hot).collect()}
    assert set(got) == set(by_user) - {None}
    for user, rows in by_user.items():
        if user is None:
            continue
        amounts = [r.amount for r in rows]
        assert got[user].user_transaction_count == len(rows)
        assert got[user].user_avg_amount == pytest.approx(statistics.fmean(amounts), abs=1e-12)
        assert got[user].user_amount_std == pytest.approx(statistics.stdev(amounts), abs=1e-9)
        assert (got[user].user_min_amount, got[user].user_max_amount) == (min(amounts), max(amounts))
        assert got[user].user_vpn_ratio == pytest.approx(sum(r.is_vpn for r in rows) / len(rows))


def test_equal_amounts_are_never_unusual(spark):
    df = spark.createDataFrame(
        [(f"T{i}", "U1", 0.1, False) for i in range(7)], "transaction_id string, user_id string, amount double, is_vpn boolean"
    )
    for r in features.behaviour(df).collect():
        assert (r.user_amount_std, r.amount_zscore, r.is_unusual_amount, r.is_largest_tx) == (0.0, 0.0, 0, 1)


def test_single_row_user(record):
    df = record({"transaction_id": "T1", "user_id": "U1", "amount": 12.5, "is_vpn": True})
    r = features.behaviour(df).first()
    assert (r.user_amount_std, r.amount_zscore, r.is_unusual_amount, r.is_new_user, r.is_largest_tx) == (0.0, 0.0, 0, 1, 1)


def test_null_user_has_null_statistics(record):
    df = record({"transaction_id": "T1", "amount": 12.5, "is_vpn": True})
    r = features.behaviour(df).first()
    assert r.user_transaction_count is None and r.user_avg_amount is None
    assert (r.is_new_user, r.is_largest_tx, r.is_unusual_amount, r.amount_to_max_ratio) == (0, 0, 0, 0.0)


def test_partials_add_up_in_any_cut(spark, hot):
    whole = rows_of(stats.user_stats(hot))
    for cut in (F.col("amount") < 40, F.col("is_vpn"), F.hour("ts") % 3 == 0):
        merged = stats.merge_partials(stats.partials(hot.filter(cut)), stats.partials(hot.filter(~cut)))
        assert rows_of(stats.finish(merged)) == whole


def test_attach_is_a_join_that_can_be_split(spark, hot):
    side = stats.user_stats(hot)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ours = skew.attach(hot, side, "user_id")
        plan = ours._jdf.queryExecution().executedPlan().toString()
        assert ours.count() == 1200 and "SortMergeJoin" in plan and "LeftOuter" in plan
        assert ours.filter("user_id is null and user_transaction_count is null").count() == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_running_profile_equals_a_plain_window(spark, hot, ranges):
    w = Window.partitionBy("user_id").orderBy("ts", "transaction_id").rowsBetween(Window.unboundedPreceding, 0)
    plain = hot.select(
        "transaction_id", F.count(F.lit(1)).over(w).alias("running_count"), F.avg("amount").over(w).alias("running_avg")
    )
    ours = running.running_profile(hot, ranges).select("transaction_id", "running_count", "running_avg")
    theirs = {r.transaction_id: r for r in plain.collect()}
    got = ours.collect()
    assert len(got) == 1200
    for r in got:
        assert r.running_count == theirs[r.transaction_id].running_count
        assert r.running_avg == pytest.approx(theirs[r.transaction_id].running_avg, abs=1e-9)


def test_a_busy_user_spreads_over_ranges(spark, hot):
    """Half of the rows belong to one user and one second; a null user and lone users lie beside it."""
    busy = hot.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    parts = running.ranged(busy, 12).filter("user_id = 'HOT'").groupBy("_range").count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 200
    got = sorted((r.transaction_id, r.running_count) for r in running.running_profile(busy, 12).filter("user_id = 'HOT'").collect())
    assert [n for _, n in got] == list(range(1, 401))


def test_running_average_of_absent_amounts(record, spark):
    rows = [{"transaction_id": f"T{i}", "user_id": "U", "amount": a} for i, a in enumerate([None, 4.0, None, float("nan")])]
    df = record(*rows).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    for ranges in (1, 4):
        got = [r.running_avg for r in running.running_profile(df, ranges).orderBy("transaction_id").collect()]
        assert got == [None, 2.0, pytest.approx(4 / 3), 1.0]


@pytest.mark.parametrize("amounts", [
    [9e8] * 12_000, [1e12, 1e12 + 0.25, 1e12 - 0.25], [0.0000001, 0.0000003], [999.999999, 1000.000001, 1000.0], [-5.5, 5.5, 123456789.123],
    [9e14, -9e14, 1.0], [1e12 + 0.0005 * k for k in range(50)],
])
def test_amounts_of_any_size(spark, amounts):
    df = spark.createDataFrame([(f"T{i}", "U", a, True) for i, a in enumerate(amounts)], "transaction_id string, user_id string, amount double, is_vpn boolean")
    r = stats.user_stats(df).first()
    exact = [Fraction(round(Fraction(a) * 10**9), 10**9) for a in amounts]
    mean = sum(exact) / len(exact)
    std = float(sum((x - mean) ** 2 for x in exact) / (len(exact) - 1)) ** 0.5
    assert r.user_avg_amount == pytest.approx(float(mean), rel=1e-15) and r.user_amount_std == pytest.approx(std, rel=1e-9)


def test_amounts_beyond_the_limit_are_none(spark):
    rows = [("a", 1e15), ("b", float("nan")), ("c", float("-inf")), ("d", None), ("e", 3.0)]
    r = stats.user_stats(spark.createDataFrame([(i, "U", a, None) for i, a in rows], "transaction_id string, user_id string, amount double, is_vpn boolean")).first()
    assert (r.user_transaction_count, r.user_avg_amount, r.user_max_amount) == (5, 3.0, 3.0)
