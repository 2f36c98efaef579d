import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.operators import columns, encode, rates
from tallyward.plans import features


@pytest.fixture
def places(record):
    return record(
        {"transaction_id": "T1", "location": "Texas, USA", "device_type": "mobile", "card_type": "gift", "is_fraud": True},
        {"transaction_id": "T2", "location": "Texas, USA", "device_type": "mobile", "card_type": "gift", "is_fraud": False},
        {"transaction_id": "T3", "location": None, "device_type": None, "card_type": None, "is_fraud": False},
        {"transaction_id": "T4", "location": "Oslo, Norway", "device_type": "watch", "card_type": "debit", "is_fraud": False},
    )


def test_missing_location_gets_the_overall_rate(places):
    got = {r.transaction_id: r for r in rates.encode(places, rates.fit(places)).collect()}
    assert got["T1"].location_fraud_rate == 0.5 and got["T4"].location_fraud_rate == 0.0
    assert got["T3"].location_fraud_rate == 0.25
    assert got["T3"].device_fraud_rate is None and got["T3"].card_fraud_rate is None


def test_value_not_seen_when_fitted(places):
    fitted = rates.fit(places.filter("transaction_id in ('T1', 'T2')"))
    got = {r.transaction_id: r for r in rates.encode(places, fitted).collect()}
    assert got["T4"].location_fraud_rate == 0.5 and got["T4"].device_fraud_rate is None


def test_too_many_values_stay_distributed(places):
    """Past the limit the table is attached by shuffle, with the same result."""
    wide, small = rates.fit(places, limit=2), rates.fit(places)
    assert small.small and not wide.small and wide.overall == small.overall
    names = ["transaction_id", *S.RATE_FEATURES.values()]
    assert rows_of(rates.encode(places, wide).select(names)) == rows_of(rates.encode(places, small).select(names))


def test_defaults_on_miss(places):
    got = {r.transaction_id: r for r in rates.encode_or_default(places, rates.defaults(places.sparkSession)).collect()}
    three = lambda r: (r.location_fraud_rate, r.device_fraud_rate, r.card_fraud_rate)
    assert three(got["T1"]) == (0.02, 0.03, 0.05)
    assert three(got["T3"]) == (0.09, 0.02, 0.02)
    assert three(got["T4"]) == (0.05, 0.02, 0.01)


def test_location_risk(places):
    got = {r.transaction_id: r.location_risk for r in rates.with_location_risk(places).collect()}
    assert got == {"T1": 0.2, "T2": 0.2, "T3": 0.9, "T4": 0.7}


def test_one_hot_of_null_and_unseen(places):
    got = {r.transaction_id: r for r in encode.one_hot(places, encode.FIXED).collect()}
    assert got["T1"].location_texas_usa == 1 and got["T1"].device_type_mobile == 1
    assert not any(v for n, v in got["T3"].asDict().items() if columns.is_one_hot(n))
    assert "location" not in got["T1"].asDict()


def test_vocabulary_is_sorted_and_bounded(places):
    assert encode.vocabulary(places)["location"] == ["Oslo, Norway", "Texas, USA"]
    with pytest.raises(ValueError, match="location"):
        encode.vocabulary(places, limit=1)


def test_manifest_leaves_the_rate_out_of_the_one_hot_block():
    made = columns.manifest_of(["amount", "location_fraud_rate", "location_london_uk", "status_approved"])
    assert made["categorical_features"] == ["location_london_uk", "status_approved"]
    assert made["numeric_features"] == ["amount", "location_fraud_rate"]


def test_columns(places):
    with pytest.raises(ValueError, match="nope"):
        columns.require(places, ["amount", "nope"])
    assert columns.available(["amount", "gone", "amount"], places) == (["amount"], ["gone"])
    assert columns.numeric_columns(places) == ["amount"]
    merged = columns.merge(
        places.select("transaction_id", "is_fraud"),
        places.select("transaction_id", F.lit("x").alias("is_fraud")), "transaction_id",
    )
    assert {r.is_fraud for r in merged.collect()} == {"x"}


def test_public_entries(spark):
    df = spark.createDataFrame([({"a": "1", "_b": "2"},)], "m map<string,string>")
    assert df.select(columns.public_entries(F.col("m"))).first()[0] == {"a": "1"}


def test_extractor_defaults(spark, record):
    """An unknown user, and one whose earlier amounts were all the same or zero."""
    stats = spark.createDataFrame(
        [("U1", 5, 10.0, 0.0, 10.0, 10.0, 0.0), ("U2", 2, 0.0, 0.0, 0.0, 0.0, 0.0)], S.USER_STATS
    )
    df = record(
        {"transaction_id": "T1", "user_id": "U1", "amount": 30.0},
        {"transaction_id": "T2", "user_id": "U2", "amount": 30.0},
        {"transaction_id": "T3", "user_id": "U3", "amount": 30.0},
        {"transaction_id": "T4", "amount": None},
    ).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    for side in (stats, F.broadcast(stats)):
        got = {r.transaction_id: r for r in features.extractor(df, side).collect()}
        assert (got["T1"].amount_zscore, got["T1"].amount_to_max_ratio, got["T1"].is_largest_tx, got["T1"].is_new_user) == (0.0, 3.0, 1, 0)
        assert (got["T2"].amount_to_max_ratio, got["T2"].is_new_user, got["T2"].user_amount_std) == (1.0, 1, 0.0)
        assert (got["T3"].user_transaction_count, got["T3"].user_amount_std, got["T3"].is_largest_tx) == (1, 1.0, 1)
        assert (got["T4"].amount, got["T4"].month, got["T4"].hour_of_day, got["T4"].status_approved) == (0.0, 1, 0, 1)
        assert got["T4"].location_unknown == 1


def test_folds_leave_out_a_rows_own_label(spark):
    """Turning one row's label changes no rate of its own fold, and a value that only one fold has gets the overall rate."""
    rows = [(f"T{i}", "London, UK" if i else "Lone", "mobile", None if i == 3 else "gift", i % 3 == 0) for i in range(60)]
    names = "transaction_id string, location string, device_type string, card_type string, is_fraud boolean"
    df, turned = (spark.createDataFrame([(*r[:4], r[4] ^ (t and r[0] == "T7")) for r in rows], names) for t in (False, True))
    made = [{r.transaction_id: r for r in rates.encode(d, rates.fit_folds(d, rates.COLUMNS, folds=4)).collect()} for d in (df, turned)]
    fold = {r.transaction_id: r.f for r in df.select("transaction_id", rates.Folds(4, 42, F.lit(True)).of_row().alias("f")).collect()}
    same = [i for i in fold if made[0][i].device_fraud_rate == made[1][i].device_fraud_rate]
    assert set(same) == {i for i in fold if fold[i] == fold["T7"]} and len(set(fold.values())) == 4
    assert made[0]["T0"].location_fraud_rate == pytest.approx(sum(r[4] for r in rows if fold[r[0]] != fold["T0"]) / sum(f != fold["T0"] for f in fold.values()))
    assert made[0]["T3"].card_fraud_rate is None
    small, large = rates.fit_folds(df, rates.COLUMNS), rates.fit_folds(df, rates.COLUMNS, limit=3)
    assert small.small and not large.small and small.overall == large.overall
    assert rows_of(rates.encode(df, small)) == rows_of(rates.encode(df, large))
    served = rates.served(small)
    assert served.folds is None and "fold" not in served.table.columns and rates.encode(df, served).filter("device_fraud_rate is null").count() == 0
