import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.functions import clock
from tallyward.operators import columns, rates
from tallyward.session import new_folder, shared_folder
from tallyward.sources import documents, envelopes, history, side_files

GOOD = {
    "transaction_id": "T0000000A", "user_id": "U10001", "timestamp": "2024-02-03T04:05:06Z", "amount": 12.5,
    "device_type": "mobile", "location": "London, UK", "is_vpn": True, "card_type": "gift", "status": "declined",
    "is_fraud": True,
}


def test_array_document(spark, tmp_path):
    path = tmp_path / "transactions.json"
    path.write_text(json.dumps([GOOD, {**GOOD, "transaction_id": "T0000000B", "is_fraud": False}], indent=2))
    df = history.read_json(spark, str(path), array_document=True)
    assert df.count() == 2
    r = df.filter("is_fraud").first()
    assert (r.user_id, r.amount, r.is_vpn, r.ts.hour) == ("U10001", 12.5, True, 4)
    assert history.profile(df).first() == (2, 50.0)
    assert [r.transaction_id for r in history.head(df, 1).collect()] == ["T0000000A"]


def test_unusable_records(spark, tmp_path):
    bad = [{**GOOD, "is_vpn": "yes"}, {k: v for k, v in GOOD.items() if k != "is_fraud"}, {**GOOD, "timestamp": "soon"}, {**GOOD, "amount": 1e18}]
    document, lines = tmp_path / "d.json", tmp_path / "l.json"
    document.write_text(json.dumps([GOOD, *bad], indent=4))
    lines.write_text("\n".join([json.dumps(GOOD), "", "{broken", *map(json.dumps, bad)]))
    for path, n in ((document, 4), (lines, 5)):
        out = str(tmp_path / f"out-{n}")
        assert [len(x) for x in documents.by_form(spark, str(path))] == [n == 4, n == 5]
        got = history.ingest(spark, str(path), out)
        assert [(r.transaction_id, r.is_fraud, r.ts.hour) for r in got.collect()] == [("T0000000A", True, 4)]
        rejects = spark.read.json(f"{out}/rejects").collect()
        assert sorted(r.reason for r in rejects) == sorted(["bad_json", "no_label", "bad_time", "bad_amount", *["bad_json"] * (n - 4)])
        assert all("T0000000A" in r.raw or r.raw == "{broken" for r in rejects)
        with pytest.raises(ValueError, match="unusable"):
            history.ingest(spark, str(path), out, unreadable="fail")
        with pytest.raises(Exception, match="unusable record"):
            history.read_json(spark, str(path), array_document=n == 4).collect()


def test_no_record_is_lost(spark, tmp_path):
    """A folder of both forms, documents cut into small byte ranges, texts with more than one record."""
    def rec(k, **more):
        return json.dumps({**GOOD, "transaction_id": f"T{k:08}", **more}, indent=k % 3 or None)

    odd = {"location": 'a "quoted}, [{ \\" place', "status": "\\", "device_type": "}]"}
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a b.json").write_text("\ufeff [" + ",\n".join(rec(k, **odd) for k in range(400)) + "]\n")
    (folder / "cut.json").write_text("[" + ",".join(rec(k) for k in range(400, 420)) + ', {"transaction_id": "T000')
    (folder / "more.json").write_text("[" + rec(420) + "," + rec(421) + "] [" + rec(422) + "]")
    (folder / "nocomma.json").write_text("[" + rec(423) + rec(424) + ", 5, null, " + rec(425) + "]")
    (folder / "empty.json").write_text("[]")
    (folder / "blank.json").write_text(" \n")
    flat = [json.dumps({**GOOD, "transaction_id": f"T{k:08}"}) for k in range(500, 506)]
    (folder / "lines.json").write_text("\n".join([flat[0], flat[1] + flat[2], flat[3] + " garbage", flat[4] + "," + flat[5], flat[4] + '],"r":[' + flat[5], flat[5]]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        assert documents._pieces(spark, [str(folder / "a b.json")]).select("block").distinct().count() > 20
        got = history.ingest(spark, str(folder), str(tmp_path / "out"))
        ids = sorted(int(r.transaction_id[1:]) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ids == [*range(420), 420, 421, 423, 425, 500, 505]
    assert {r.location for r in got.filter("transaction_id < 'T00000400'").collect()} == {odd["location"]}
    rejects = sorted((r.reason, r.raw[:8]) for r in spark.read.json(str(tmp_path / "out" / "rejects")).collect())
    assert [r for r, _ in rejects] == ["bad_json"] * 2 + ["cut_off"] + ["extra_data"] * 6


def test_texts_are_put_together_once(spark, tmp_path):
    """Where no record is too long, pieces meet their places once, and what looks at the texts reads them as written."""
    path = tmp_path / "a.json"
    path.write_text('[{"a": "x\\"]}{[", "b": [1, {"c": "]"}]}, {"a": "\\\\"}]')
    found = documents.records(spark, [str(path)])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "array_join" not in plan
    assert sorted(r.value for r in found.collect()) == ['{"a": "\\\\"}', '{"a": "x\\"]}{[", "b": [1, {"c": "]"}]}']


def test_long_records_are_given_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "RECORD_BYTES", 2000)
    path = tmp_path / "d.json"
    path.write_text("[" + json.dumps(GOOD) + ', {"open": "' + ", ".join(json.dumps(GOOD) for _ in range(20)).replace('"', "") + "]")
    found = documents.records(spark, [str(path)]).collect()
    assert sorted({r.problem for r in found}, key=str) == [None, "cut_off"] and sum(r.problem is None for r in found) == 1
    assert sum(len(r.value) for r in found if r.problem) > 3000


def test_history_without_labels_or_documents(spark, tmp_path):
    path = tmp_path / "x.json"
    for text in (json.dumps([{k: v for k, v in GOOD.items() if k != "is_fraud"}]), "[{", "{}"):
        path.write_text(text)
        with pytest.raises(ValueError, match="unusable"):
            history.ingest(spark, str(path), str(tmp_path / "out"))


def test_offsets_are_applied(spark):
    texts = ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00+02:00", "2024-01-01T10:00:00-0530", "2024-01-01", "nonsense"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in df.select(clock.parse_or_null(F.col("t")).cast("string").alias("x")).collect()]
    assert got == ["2024-01-01 10:00:00", "2024-01-01 08:00:00", "2024-01-01 15:30:00", "2024-01-01 00:00:00", None]
    assert df.limit(3).select(clock.parse(F.col("t")).cast("string").alias("x")).collect()[1].x == "2024-01-01 08:00:00"


def test_label_is_required(spark, record):
    with pytest.raises(ValueError, match="is_fraud"):
        history.with_time(record(GOOD).drop("is_fraud"))


def test_write_only_once(spark, tx):
    path = new_folder(spark, "once")
    history.land(tx.limit(10), path)
    history.land(tx, path)
    back = spark.read.parquet(path)
    assert back.count() == 10 and "day" in back.columns
    history.land(tx, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 1000


def test_day_filter_prunes(spark, tx):
    path = new_folder(spark, "days")
    history.land(tx, path)
    plan = spark.read.parquet(path).filter("day = date'2024-01-05'").select("amount")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text and "ReadSchema: struct<amount:double>" in text


def test_side_files_fall_back(spark):
    gone = new_folder(spark, "nothing")
    assert side_files.read_manifest(spark, gone)["feature_names"] == []
    assert side_files.model_width(side_files.read_manifest(spark, gone)) == 38
    assert side_files.read_rates(spark, gone).seen["card_type"] == S.CARD_TYPES


def test_side_files_come_back(spark, tx):
    path = new_folder(spark, "side")
    fitted = rates.fit(tx, rates.COLUMNS)
    side_files.write_rates(fitted, f"{path}/rates")
    back = side_files.read_rates(spark, f"{path}/rates")
    assert rows_of(back.table) == rows_of(fitted.table)
    made = columns.manifest_of(["amount", "status_pending"])
    side_files.write_small(side_files.manifest_row(spark, made), f"{path}/manifest")
    assert side_files.read_manifest(spark, f"{path}/manifest") == made
    row = side_files.metadata_row(spark, "m", "j", {"maxDepth": 7, "_seed": 1}, made, 1.5)
    side_files.write_small(row, f"{path}/metadata")
    got = spark.read.json(f"{path}/metadata").first()
    assert got.hyperparameters.asDict() == {"maxDepth": "7"} and got.feature_info.numeric_features == ["amount"]


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def _line(payload=None, **other):
    import base64

    if payload is None:
        return (json.dumps(other),)
    raw = payload if isinstance(payload, bytes) else json.dumps(payload).encode()
    return (json.dumps({"Records": [{"kinesis": {"data": base64.b64encode(raw).decode()}}]}),)


def decoded(spark, *lines):
    df = envelopes.parse(spark.createDataFrame(list(lines), "value string"))
    return envelopes.decode(df)


def test_reasons(spark):
    wire = {k: v for k, v in GOOD.items() if k != "is_fraud"}
    got = decoded(
        spark, _line(wire), _line({**wire, "amount": "7.25"}), _line({**wire, "amount": "much"}),
        _line({k: v for k, v in wire.items() if k != "transaction_id"}), _line(b"{not json"), _line(b"\xff\xfe"),
        _line(Records=[{"kinesis": {"data": "@@"}}]), _line(transaction=wire), _line(Records=[]), _line(other=1),
        ("not even json",), _line({**wire, "is_vpn": "yes"}), _line(Records=[{"kinesis": {}}]),
    )
    reasons = sorted((r.route, r.reason) for r in got.collect())
    assert reasons == sorted([
        ("records", "valid"), ("records", "valid"), ("records", "bad_amount"), ("records", "no_transaction_id"),
        ("records", "bad_json"), ("records", "bad_base64"), ("records", "bad_base64"), ("direct", "valid"),
        ("invalid", "invalid_envelope"), ("invalid", "invalid_envelope"), ("invalid", "invalid_envelope"),
        ("records", "bad_json"), ("records", "bad_base64"),
    ])
    assert sorted(r.amount for r in envelopes.accepted(got).collect()) == [7.25, 12.5, 12.5]
    rejects = {(r.reason, r.raw) for r in envelopes.rejected(got).collect()}
    assert envelopes.rejected(got).count() == 10
    assert {("invalid_envelope", "not even json"), ("bad_base64", "@@"), ("bad_json", "{not json")} <= rejects
    assert all(raw for _, raw in rejects)


def test_both_routes_have_the_same_rules(spark):
    wire = {k: v for k, v in GOOD.items() if k != "is_fraud"}
    damage = [({"is_vpn": "yes"}, "bad_json"), *[({"amount": a}, "bad_amount") for a in ("NaN", "Infinity", "1e17", -1e15, "x")],
              ({"transaction_id": None}, "no_transaction_id"), ({"amount": "999999999.5"}, "valid"), ({"amount": None}, "valid")]
    for change, reason in damage:
        got = decoded(spark, _line({**wire, **change}), _line(transaction={**wire, **change})).collect()
        assert [r.reason for r in got] == [reason, reason], change
        assert all((r.raw is None) == (reason == "valid") and (r.raw is None or json.loads(r.raw)["user_id"] == "U10001") for r in got)


def test_many_records_in_one_envelope(spark):
    import base64

    data = [base64.b64encode(json.dumps({"transaction_id": f"T{i}"}).encode()).decode() for i in range(100)]
    line = (json.dumps({"Records": [{"kinesis": {"data": d}} for d in data]}),)
    got = envelopes.accepted(decoded(spark, line))
    assert got.count() == 100
    filled = envelopes.with_defaults(got).first()
    assert (filled.amount, filled.device_type, filled.is_vpn, filled.location, filled.status) == (
        0.0, "unknown", False, "Unknown", "approved"
    )


def test_publish_is_read_back(spark, tx):
    path = new_folder(spark, "published")
    rows = history.wire_form(tx)
    envelopes.publish(rows, path)
    got = envelopes.accepted(envelopes.decode(envelopes.read(spark, path)))
    names = [f.name for f in S.TRANSACTION.fields]
    assert rows_of(got.select(names)) == rows_of(rows.select(names))


def test_libsvm_is_one_based(spark, record, tmp_path):
    path = str(tmp_path / "m")
    df = record(GOOD).select("is_fraud", F.lit(2.5).alias("a"), F.lit(None).cast("double").alias("b"), F.lit(3).alias("c"))
    history.write_matrix(df, ["a", "b", "c"], path)
    text = [r.value for r in spark.read.text(path).collect()]
    assert text == ["1.0 1:2.5 2:0.0 3:3.0"]
    assert history.read_matrix(spark, path, ["a", "b", "c"]).first() == (1, 2.5, 0.0, 3.0)
