import time
import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.operators import alerts, rates, scoring, stats, store
from tallyward.plans import queries as q
from tallyward.session import new_folder
from tallyward.sources import envelopes, history, side_files
from tallyward.streaming import profile, scoring_stream
from tallyward.streaming.scorer import Scorer


def now():
    return q.at(q.NOW)


def scored(record, **over):
    row = {
        "transaction_id": "T1", "user_id": "U1", "timestamp": "2024-01-01T00:00:00Z", "amount": 2.675,
        "device_type": "mobile", "location": "London, UK", "is_vpn": True, "card_type": "gift", "status": "approved",
        **over,
    }
    return record(row, schema=S.TRANSACTION).withColumns(
        {"fraud_probability": F.lit(0.9), "is_fraud": F.lit(True), "error": F.lit(None).cast("string")}
    )


def test_alert_text(record):
    r = alerts.alerts(scored(record)).first()
    assert r.subject == "FRAUD ALERT: Transaction T1"
    assert r.risk_factors[1:] == ["Location: London, UK", "Device: mobile", "VPN: True", "Card Type: gift"]
    assert json.loads(r.message)["risk_factors"] == r.risk_factors


def test_alert_of_a_bare_record(record):
    bare = scored(record, user_id=None, location=None, is_vpn=None, amount=None)
    r = alerts.alerts(bare).first()
    assert r.user_id is None
    assert r.risk_factors == ["Amount: $0.00", "Location: Unknown", "Device: mobile", "VPN: False", "Card Type: gift"]


@pytest.mark.parametrize(
    ("p", "fallback", "strict", "expected"),
    [
        (0.5, "rule", True, (0.5, False, None)), (0.5, "rule", False, (0.5, True, None)),
        (None, "rule", True, (0.75, True, scoring.MODEL_FAILED)),
        (None, "shipped", True, (0.5, False, scoring.MODEL_FAILED)),
        (None, "half", False, (0.5, True, scoring.MODEL_FAILED)),
    ],
)
def test_decision(spark, p, fallback, strict, expected):
    df = spark.createDataFrame([(p, 0.75)], "p double, risk_score double")
    r = scoring.decide(df, "p", strict=strict, fallback=fallback).first()
    assert (r.fraud_probability, r.is_fraud, r.error) == expected


def test_repeated_batch_changes_nothing(spark, record):
    path = new_folder(spark, "store")
    first = store.stored_form(scored(record), now())
    store.append(first, 0, path)
    store.append(first, 0, path)
    assert spark.read.parquet(path).count() == 1
    store.append(store.stored_form(scored(record, amount=9.0), now()), 1, path)
    got = store.read(spark, path, now()).collect()
    assert [(r.amount, r.version) for r in got] == [(9.0, 1)]


def test_expired_rows_are_gone(spark, record):
    path = new_folder(spark, "store")
    store.append(store.stored_form(scored(record), q.at("2024-01-01 12:00:00")), 0, path)
    assert store.read(spark, path, q.at("2024-01-31 11:59:59")).count() == 1
    assert store.read(spark, path, q.at("2024-01-31 12:00:00")).count() == 0
    plan = store.read(spark, path, q.at("2024-02-05 00:00:00"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "expiry_date" in plan


def test_compact_keeps_what_is_current(spark, record):
    path, target = new_folder(spark, "store"), new_folder(spark, "compact")
    store.append(store.stored_form(scored(record, transaction_id="OLD"), q.at("2023-12-01 00:00:00")), 0, path)
    for i in range(1, 4):
        store.append(store.stored_form(scored(record, amount=float(i)), now()), i, path)
    store.compact(spark, path, target, now())
    assert spark.read.parquet(target).count() == 1
    assert [(r.transaction_id, r.amount) for r in store.read(spark, target, now()).collect()] == [("T1", 3.0)]
    assert store.of_user(spark, target, "U1", now()).count() == 1


def test_merges_leave_one_row_per_id(spark, record):
    """Versions before, across and after merges; an older query that still writes; a merged batch written again."""
    path = new_folder(spark, "store")
    put = lambda batch, query="a", started=0, **row: store.append(
        store.stored_form(scored(record, **row), now()), batch, path, query, started)
    put(0, transaction_id="T1", amount=1.0)
    put(1, transaction_id="T2", amount=2.0)
    store.merge(spark, path, now())
    put(2, transaction_id="T1", amount=3.0)
    put(0, "b", 5, transaction_id="T3", amount=4.0)
    put(1, transaction_id="T2", amount=2.0)
    store.merge(spark, path, now())
    put(3, transaction_id="T3", amount=99.0)  # of the query that started earlier
    put(1, "b", 5, transaction_id="T1", amount=6.0, user_id="U2")
    assert {r.transaction_id: r.amount for r in store.read(spark, path, now()).collect()} == {"T1": 6.0, "T2": 2.0, "T3": 4.0}
    base = store._epoch(spark, path)
    assert base[0] == 2 and spark.read.parquet(base[1]).count() == 3
    assert store._since(spark, path, base[2], now()).count() == 2
    assert [r.transaction_id for r in store.of_user(spark, path, "U2", now()).collect()] == ["T1"]
    assert sorted(r.transaction_id for r in store.of_user(spark, path, "U1", now()).collect()) == ["T2", "T3"]


def test_new_checkpoint_loses_nothing(spark, record, tx):
    places = places_for(spark, tx, record({"transaction_id": "T1", "user_id": "U1", "amount": 1.0}))
    scorer = Scorer(rates.defaults(spark))
    scoring_stream.replay(spark, places, scorer, now())
    again = scoring_stream.Places(places.root)
    again.at = lambda name: f"{places.root}/{'other-checkpoint' if name == 'checkpoint' else 'other-envelopes' if name == 'envelopes' else name}"
    envelopes.publish(record({"transaction_id": "T2", "user_id": "U1", "amount": 2.0}, {"transaction_id": "T1", "user_id": "U1", "amount": 9.0}), again.at("envelopes"))
    got = scoring_stream.replay(spark, again, scorer, now())
    assert sorted((r.transaction_id, r.amount) for r in got.collect()) == [("T1", 9.0), ("T2", 2.0)]
    assert spark.read.json(places.at("summaries")).agg(F.sum("processed_count")).first()[0] == 3
    assert store.of_user(spark, places.at("store"), "U1", now()).count() == 2
    stored = dict(spark.read.parquet(places.at("store")).dtypes)
    assert stored["amount"] == stored["fraud_probability"] == "decimal(38,18)"


def test_hostile_amounts_do_not_stop_a_learning_stream(spark, record, tx):
    places = places_for(spark, tx, record({"transaction_id": "T1", "user_id": "UX", "amount": 5.0}))
    bad = [(f'{{"transaction": {{"transaction_id": "B{i}", "user_id": "UX", "amount": "{a}"}}}}',) for i, a in enumerate(["1e17", "NaN", "Infinity", "-1e300"])]
    spark.createDataFrame(bad, "value string").write.mode("append").text(places.at("envelopes"))
    got = scoring_stream.replay(spark, places, Scorer(rates.defaults(spark)), now(), learn=True)
    assert [r.transaction_id for r in got.collect()] == ["T1"]
    assert {r.reason for r in spark.read.json(places.at("rejects")).collect()} == {"bad_amount"}
    assert all('"UX"' in r.raw for r in spark.read.json(places.at("rejects")).collect())
    learned = profile.current(spark, places.at("profile")).first()
    assert (learned.user_transaction_count, learned.user_avg_amount) == (1, 5.0)


def test_redelivery_is_learned_once_and_stored_anew(spark, record, tx):
    row = {"transaction_id": "T1", "user_id": "UX", "amount": 4.0}
    places = places_for(spark, tx, record(row, row))
    scorer = Scorer(rates.defaults(spark))
    for more in ([], [{**row, "amount": 9.0}, {**row, "transaction_id": "T2"}], [{**row, "amount": 11.0}]):
        if more:
            envelopes.publish(record(*more), places.at("envelopes"))
        got = scoring_stream.replay(spark, places, scorer, now(), learn=True)
    assert {r.transaction_id: (r.amount, r.feature_values.user_transaction_count) for r in got.collect()} == {"T1": (11.0, 2), "T2": (4.0, 1)}
    r = profile.current(spark, places.at("profile")).first()
    assert (r.user_transaction_count, r.user_avg_amount) == (2, 4.0)


def test_merges_keep_the_sums(spark, tx):
    """Batches of two queries, merged in between, one of them repeated after its merge."""
    path = new_folder(spark, "profile")
    parts = [tx.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(7)) == k) for k in range(7)]
    for k, part in enumerate(parts):
        profile.learn(part, k // 2, path, query="ab"[k % 2], merge_every=2)
    profile.learn(parts[2], 1, path, query="a", merge_every=2)
    assert profile._epoch(spark, path)[0] >= 2
    assert rows_of(profile.current(spark, path)) == rows_of(stats.user_stats(tx))
    users = tx.select("user_id").filter("user_id < 'U10010'")
    assert rows_of(profile.current(spark, path, users=users)) == rows_of(stats.user_stats(tx.join(users.distinct(), "user_id", "left_semi")))


def test_records_are_checked_once_and_learned_by_what_the_sums_need(spark, record, tx):
    """A filter on the reason brings no second check of a record's text; the learning stream deals the fields of the sums only."""
    rows = record(*[{"transaction_id": f"T{i}", "user_id": "UX", "amount": 4.0, "location": "London, UK"} for i in range(3)])
    places = places_for(spark, tx, rows)
    accepted = envelopes.accepted(envelopes.decode(envelopes.read(spark, places.at("envelopes"))))
    plan = accepted._jdf.queryExecution().optimizedPlan().toString()
    every = envelopes.decode(envelopes.read(spark, places.at("envelopes")))._jdf.queryExecution().optimizedPlan().toString()
    # the envelope, the rest of it, the record; and, in the reason alone, why a record gave nothing
    assert plan.count("jsonObjectKeys") <= 3 and every.count("jsonObjectKeys") <= 4
    query = scoring_stream.start_learning(spark, places, once=True)
    query.awaitTermination()
    assert "location" not in query._jsq.streamingQuery().lastExecution().optimizedPlan().output().toString()
    assert profile.current(spark, places.at("profile")).first().user_transaction_count == 3


def test_the_state_forgets_what_is_older_than_the_horizon(spark, record, tx):
    row = {"transaction_id": "T1", "user_id": "UX", "amount": 4.0}
    places = places_for(spark, tx, record(row))
    for k in range(4):
        scoring_stream.start_learning(spark, places, once=True, horizon="1 second").awaitTermination()
        query = scoring_stream.start_learning(spark, places, once=True, horizon="1 second")
        query.awaitTermination()
        time.sleep(1.2)
        envelopes.publish(record({**row, "transaction_id": f"N{k}"}), places.at("envelopes"))
    query = scoring_stream.start_learning(spark, places, once=True, horizon="1 second")
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert kept and kept[-1] <= 2
    assert profile.current(spark, places.at("profile")).first().user_transaction_count == 5


def test_a_lookup_reads_in_proportion_to_its_users(spark, monkeypatch):
    """The same users out of a table a hundred times as large: as many folders of the same size."""
    monkeypatch.setattr(side_files, "FOLDER_USERS", 50)
    read = []
    for size in (200, 20_000):
        users = spark.range(size).select(F.format_string("U%06d", "id").alias("user_id"))
        table = users.select("user_id", *[F.lit(1).cast(f.dataType).alias(f.name) for f in side_files.S.USER_STATS.fields[1:]])
        side_files.write_user_stats(table, path := new_folder(spark, "stats"))
        asked = users.filter("user_id in ('U000003', 'U000077', 'U000150')")
        found = side_files.read_user_stats(spark, path, asked)
        assert found.count() == 3
        files = [f for f in found.inputFiles() if "bucket=" in f]
        read.append(spark.read.parquet(*files).count())
        assert len({f.split("bucket=")[1].split("/")[0] for f in files}) <= 3
    assert read[1] < 3 * 2 * 50 and read[0] <= 200


def test_upsert_survives_a_hot_key(spark):
    old = spark.createDataFrame([(f"T{i}", 0, 0) for i in range(20)], "transaction_id string, version int, v int")
    new = spark.createDataFrame([("T1", i, i) for i in range(1, 400)], old.schema)
    got = {r.transaction_id: r.v for r in store.upsert(old, new).collect()}
    assert len(got) == 20 and got["T1"] == 399
    plan = store.latest(new)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_exact_floats(record):
    r = store.exact_floats(scored(record).select("amount")).first()
    assert str(r.amount) == "2.675000000000000000"


def places_for(spark, tx, published):
    places = scoring_stream.Places(new_folder(spark, "stream"))
    side_files.write_user_stats(stats.user_stats(tx.filter(F.col("ts") < "2024-01-16")), places.at("user_stats"))
    envelopes.publish(published, places.at("envelopes"))
    return places


FIELDS = ["transaction_id", "user_id", "amount", "fraud_probability", "is_fraud", "ttl", "error"]


def test_stream_equals_batch_and_loses_nothing(spark, tx):
    rows = history.wire_form(tx)
    places = places_for(spark, tx, rows)
    scorer = Scorer(rates.defaults(spark))
    got = scoring_stream.replay(spark, places, scorer, now(), files_per_batch=2)
    batch = scorer.score(rows, side_files.read_user_stats(spark, places.at("user_stats")), now())
    assert rows_of(got.select(FIELDS)) == rows_of(batch.select(FIELDS))
    trip = store.round_trip(rows, got).first()
    assert (trip.sent, trip.processed, trip.complete_enough) == (1000, 1000, True)
    assert store.missing(got, rows.select("transaction_id")).count() == 0


def test_restart_takes_up_where_it_stopped(spark, tx):
    rows = history.wire_form(tx)
    places = places_for(spark, tx, rows.filter("amount < 50"))
    scorer = Scorer(rates.defaults(spark))
    query = scoring_stream.start(spark, places, scorer, now(), learn=True, once=True)
    query.awaitTermination()
    scoring_stream.start_learning(spark, places, once=True).awaitTermination()
    before = store.read(spark, places.at("store"), now()).count()
    envelopes.publish(rows.filter("amount >= 50"), places.at("envelopes"))
    query = scoring_stream.start(spark, places, scorer, now(), learn=True, once=True)
    query.awaitTermination()
    scoring_stream.start_learning(spark, places, once=True).awaitTermination()
    assert 0 < before < 1000
    assert store.read(spark, places.at("store"), now()).count() == 1000
    summaries = spark.read.json(places.at("summaries"))
    assert summaries.agg(F.sum("processed_count")).first()[0] == 1000
    # what the stream learned is what the whole history says, to the last bit
    learned = profile.current(spark, places.at("profile"))
    assert rows_of(learned) == rows_of(stats.user_stats(tx))
    target = new_folder(spark, "profile")
    profile.compact(spark, places.at("profile"), target)
    assert rows_of(profile.current(spark, target)) == rows_of(learned)


def test_same_id_in_one_batch_is_stored_once(spark, record, tx):
    row = {"transaction_id": "TX", "user_id": "U1", "amount": 1.0, "timestamp": "2024-01-20T00:00:00Z"}
    late = {**row, "amount": 2.0, "timestamp": "2024-01-21T00:00:00Z"}
    places = places_for(spark, tx, record(late, row))
    got = scoring_stream.replay(spark, places, Scorer(rates.defaults(spark)), now()).collect()
    assert [(r.transaction_id, r.amount) for r in got] == [("TX", 2.0)]


def test_bad_records_do_not_stop_the_batch(spark, record, tx):
    places = places_for(spark, tx, record({"transaction_id": "TX", "amount": 1.0}))
    lines = [('{"Records": [{"kinesis": {"data": "@@"}}]}',), ("junk",)]
    spark.createDataFrame(lines, "value string").write.mode("append").text(places.at("envelopes"))
    assert scoring_stream.replay(spark, places, Scorer(rates.defaults(spark)), now()).count() == 1
    assert sorted(r.reason for r in spark.read.json(places.at("rejects")).collect()) == ["bad_base64", "invalid_envelope"]
