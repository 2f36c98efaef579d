import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.operators import correlate, evaluate, scale


def frame(spark, pairs):
    return spark.createDataFrame([(float(s), bool(y)) for s, y in pairs], "score double, is_fraud boolean")


def auc_by_pairs(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    won = sum(Fraction(2 if p > n else 1 if p == n else 0, 2) for p in pos for n in neg)
    return float(won / (len(pos) * len(neg)))


def roc_by_hand(pairs):
    p, n = sum(y for _, y in pairs), sum(not y for _, y in pairs)
    points, tps, fps = [], 0, 0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        tps += sum(1 for t, y in pairs if t == s and y)
        fps += sum(1 for t, y in pairs if t == s and not y)
        points.append((fps, tps, s))
    keep = [
        i for i in range(len(points))
        if i in (0, len(points) - 1)
        or points[i - 1][0] + points[i + 1][0] != 2 * points[i][0]
        or points[i - 1][1] + points[i + 1][1] != 2 * points[i][1]
    ]
    return [(float("inf"), 0.0, 0.0)] + [(float(points[i][2]), points[i][0] / n, points[i][1] / p) for i in keep]


def check(spark, pairs):
    df = frame(spark, pairs)
    assert evaluate.roc_auc(df).first().roc_auc == pytest.approx(auc_by_pairs(pairs), abs=1e-12)
    got = sorted(((r.threshold, r.fpr, r.tpr) for r in evaluate.roc_points(df).collect()), reverse=True)
    want = roc_by_hand(pairs)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a == pytest.approx(b)


def test_many_scores_over_many_slices(spark):
    rng = random.Random(5)
    check(spark, [(round(rng.random() ** 3, 3), rng.random() < 0.3) for _ in range(600)])


def test_one_score_holds_a_third(spark):
    rng = random.Random(6)
    check(spark, [(0.25 if i % 3 == 0 else round(rng.random(), 4), rng.random() < 0.5) for i in range(500)])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([-0.5, 0.0, 0.1, 0.5, 0.9, 1.0]), st.booleans()), min_size=2, max_size=25))
def test_random_small_frames(spark, pairs):
    if len({y for _, y in pairs}) == 2:
        check(spark, pairs)


def test_all_tied(spark):
    assert evaluate.roc_auc(frame(spark, [(0.4, 1), (0.4, 0), (0.4, 0)])).first().roc_auc == 0.5


def test_one_class_has_no_auc(spark):
    r = evaluate.roc_auc(frame(spark, [(0.4, 0), (0.6, 0)])).first()
    assert (r.roc_auc, r.positives, r.negatives) == (None, 0, 2)


def test_threshold_itself(spark):
    df = frame(spark, [(0.5, 1)])
    assert df.select(evaluate.predicted(F.col("score")), evaluate.predicted(F.col("score"), strict=True)).first() == (True, False)


def test_nothing_to_divide_by(spark):
    cm = evaluate.confusion(frame(spark, [(0.1, 0), (0.2, 0)]).withColumn("flagged", F.lit(False)))
    b = evaluate.business(cm).first()
    assert (b.detection_rate, b.false_alarm_rate, b.precision) == (0.0, 0.0, 0.0)
    assert evaluate.positive_rates(cm).first() == (2, 0.0, 0.0)
    lines = {(r.label, r.metric): r.value for r in evaluate.report(cm).collect()}
    assert lines["1", "f1-score"] == 0.0 and lines["0", "recall"] == 1.0 and lines["accuracy", "accuracy"] == 1.0


def test_empty_frame(spark):
    cm = evaluate.confusion(frame(spark, []).withColumn("flagged", F.lit(False)))
    assert cm.first() == (0, 0, 0, 0)


def test_recommended(spark):
    pairs = [(0.95, 1), (0.85, 1), (0.75, 1), (0.65, 1), (0.35, 1), (0.85, 0), (0.15, 0), (0.05, 0)]
    sweep = evaluate.threshold_sweep(frame(spark, pairs))
    best = evaluate.recommended_threshold(sweep).collect()
    assert [(r.threshold, r.detection_rate) for r in best] == [(0.2, 1.0)]
    assert evaluate.recommended_threshold(sweep, 1.1).collect() == []


def test_first_per_class(spark):
    df = spark.range(40).select(F.col("id").cast("string").alias("transaction_id"), (F.col("id") % 2 == 0).alias("is_fraud"))
    got = evaluate.first_per_class(df, n=3).collect()
    assert len(got) == 6
    plan = evaluate.first_per_class(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before the shuffle and after it


def test_correlation_of_present_pairs_only(spark):
    rows = [(float(i), None if i % 4 == 0 else float(i * i), 7.0, i % 2 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double, is_fraud boolean").repartition(5)
    got = {(r.feature_x, r.feature_y): r["corr"] for r in correlate.pairwise(df, ["is_fraud", "a", "b", "c"]).collect()}
    import numpy as np

    some = [r for r in rows if r[1] is not None]
    assert got["a", "b"] == pytest.approx(np.corrcoef([r[0] for r in some], [r[1] for r in some])[0, 1], abs=1e-12)
    assert got["a", "b"] == got["b", "a"]
    assert got["a", "c"] is None and got["c", "c"] is None
    assert got["a", "a"] == pytest.approx(1.0)


def test_correlation_far_from_zero(spark):
    """A mean a billion times the spread must not wash the correlation out."""
    import numpy as np

    x = np.arange(200.0)
    y = np.sin(x)
    df = spark.createDataFrame([(1e9 + float(a), float(b)) for a, b in zip(x, y, strict=True)], "a double, b double").repartition(4)
    got = {(r.feature_x, r.feature_y): r["corr"] for r in correlate.pairwise(df, ["a", "b"]).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)


def test_scaler_is_population(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    scales = scale.fit(df, ["a", "b"])
    assert [tuple(r) for r in scale.transform(df, scales).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]
