import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyward.operators import split


def brute_force(ids, seed, take):
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))
    return set(order[:take])


@pytest.fixture
def labelled(spark):
    rows = [(f"T{i:06d}", i % 7 == 0) for i in range(2003)]
    return spark.createDataFrame(rows, "transaction_id string, is_fraud boolean").repartition(6)


@pytest.mark.parametrize("small", [100_000, 1])
def test_stratified_split_is_exact(labelled, monkeypatch, small):
    monkeypatch.setattr(split, "_SMALL_BUCKET", small)  # 1: every bucket is refined again
    got = split.stratified_split(labelled).collect()
    sizes = Counter(r.is_fraud for r in got)
    test = Counter(r.is_fraud for r in got if r.split == "test")
    want = split.proportional(0.2)(dict(sizes))
    assert sum(want.values()) == math.ceil(0.2 * 2003)
    for c in (True, False):
        ids = [r.transaction_id for r in got if r.is_fraud == c]
        assert {r.transaction_id for r in got if r.is_fraud == c and r.split == "test"} == brute_force(ids, 42, want[c])
    assert dict(test) == want


def test_split_does_not_depend_on_the_layout(labelled):
    a = {(r.transaction_id, r.split) for r in split.three_way_split(labelled).collect()}
    b = {(r.transaction_id, r.split) for r in split.three_way_split(labelled.orderBy("transaction_id").coalesce(1)).collect()}
    assert a == b
    assert Counter(s for _, s in a) == {"test": 401, "validation": 321, "train": 1281}


def test_rows_are_not_shuffled(labelled):
    plan = split.stratified_split(labelled)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "Aggregate" not in plan


def test_proportional_quota():
    assert split.proportional(0.2)({False: 8388, True: 1612}) == {False: 1678, True: 322}
    assert split.proportional(0.5)({False: 3, True: 3}) == {False: 2, True: 1}
    big = split.proportional(0.2)({False: 9 * 10**11 + 1, True: 10**11})
    assert sum(big.values()) == math.ceil((10**12 + 1) * 0.2)


def test_hot_id_stays_together(spark):
    """A third of the rows share one id: all on one side, the quota never exceeded."""
    rows = [("SAME" if i % 3 == 0 else f"T{i}", False) for i in range(300)]
    df = spark.createDataFrame(rows, "transaction_id string, is_fraud boolean")
    got = split.stratified_split(df).collect()
    assert len(got) == 300
    assert len({r.split for r in got if r.transaction_id == "SAME"}) == 1
    assert sum(r.split == "test" for r in got) <= 60


def test_whole_and_empty_classes(labelled):
    got = split.class_ratio_sample(labelled, 400, 1.0)  # more frauds than there are, no others
    assert Counter(r.is_fraud for r in got.collect()) == {True: 287}


def test_class_ratio(labelled):
    got = split.class_ratio_sample(labelled, 50, 0.3).collect()
    assert Counter(r.is_fraud for r in got) == {True: 15, False: 35}
    again = split.class_ratio_sample(labelled, 50, 0.3).collect()
    assert [r.transaction_id for r in got] == [r.transaction_id for r in again]
    assert [r.transaction_id for r in got] != sorted(r.transaction_id for r in got)


def test_seeds_differ(labelled):
    a = split.stratified_split(labelled, seed=1).filter("split = 'test'").select("transaction_id")
    b = split.stratified_split(labelled, seed=2).filter("split = 'test'").select("transaction_id")
    assert 0 < a.join(b, "transaction_id").count() < a.count()


def test_too_many_classes(labelled):
    with pytest.raises(ValueError, match="classes"):
        split.stratified_split(labelled.withColumn("is_fraud", F.col("transaction_id")))


def one_after_the_other(df):
    parted = split.stratified_split(df)
    marked = split.plain_split(parted, 0.2, 42, "v", F.col("split") == "train")
    return {(r.transaction_id, r.is_fraud, "validation" if r.v else r.split) for r in marked.collect()}


@pytest.mark.parametrize("small", [100_000, 300, 1])
@pytest.mark.parametrize("kind", ["plain", "classes", "repeated", "hot", "one", "empty"])
def test_both_quotas_from_joint_counts(spark, labelled, monkeypatch, small, kind):
    monkeypatch.setattr(split, "_SMALL_BUCKET", small)
    n = F.substring("transaction_id", 2, 6).cast("int")
    df = {
        "plain": labelled,
        "classes": labelled.withColumn("is_fraud", F.when(n % 5 == 0, F.lit(None)).when(n % 5 < 3, F.lit("a")).otherwise(F.lit("b"))),
        "repeated": labelled.withColumn("transaction_id", F.concat(F.lit("R"), (n % 97).cast("string"))),
        "hot": labelled.withColumn("transaction_id", F.when(n % 3 == 0, F.lit("SAME")).otherwise(F.col("transaction_id"))),
        "one": labelled.limit(1),
        "empty": labelled.limit(0),
    }[kind]
    got = split.three_way_split(df).collect()
    assert len(got) == df.count()
    assert {(r.transaction_id, r.is_fraud, r.split) for r in got} == one_after_the_other(df)


def test_both_quotas_take_two_passes(labelled, monkeypatch):
    seen = []
    looked = split._open_rows
    monkeypatch.setattr(split, "_open_rows", lambda keyed, at: seen.append(at.bits) or looked(keyed, at))
    split.three_way_split(labelled)
    assert seen == [60, 52]
    seen.clear()
    monkeypatch.setattr(split, "_SMALL_BUCKET", 60)  # some 16 of 2,003 rows are open after a pass, and 13 in two parts
    split.three_way_split(labelled)
    assert seen == [60, 52]


def test_rows_without_an_id_train(labelled):
    none = labelled.limit(10).withColumn("transaction_id", F.lit(None).cast("string"))
    got = split.three_way_split(labelled.unionByName(none)).collect()
    assert Counter(r.split for r in got) == {"test": 401, "validation": 321, "train": 1291}
    assert {r.split for r in got if r.transaction_id is None} == {"train"}
