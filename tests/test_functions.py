import pytest
from pyspark.sql import functions as F

from tallyward.functions import amounts, clock, codec


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-03-09T23:15:00Z", (23, 5, 3, 9, 1, 1)),
        ("2024-01-01T06:00:00Z", (6, 0, 1, 1, 0, 0)),
        ("2024-01-01T05:59:59Z", (5, 0, 1, 1, 0, 1)),
        (None, (0, 0, 1, 1, 0, 0)),
        ("yesterday", (0, 0, 1, 1, 0, 0)),
        ("2024-01-06T23:00:00.5Z", (0, 0, 1, 1, 0, 0)),
        ("2024-01-06T23:00:00+02:00", (0, 0, 1, 1, 0, 0)),
        ("2024-13-06T23:00:00Z", (0, 0, 1, 1, 0, 0)),
    ],
)
def test_stream_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert values(df, *clock.calendar_or_default(clock.parse_strict(F.col("t"))).values()) == [expected]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_time_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-03-10T02:30:00Z",)], "t string")
        ts = clock.parse(F.col("t"))
        now = F.to_timestamp(F.lit("2024-03-10 02:30:00+00:00"))
        assert values(df, F.hour(ts), clock.epoch(ts), clock.iso_now(now), clock.utc_date(clock.epoch_now(now))) == [
            (2, 1710037800, "2024-03-10T02:30:00", "2024-03-10")
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_batch_time_fails_on_bad_text(spark):
    df = spark.createDataFrame([("yesterday",)], "t string")
    with pytest.raises(Exception, match="yesterday"):
        df.select(clock.parse(F.col("t"))).collect()


def test_flat_user_in_both_modes(spark):
    df = spark.createDataFrame([(30.0, 20.0, 0.0, 0.0)], "a double, m double, s double, x double")
    a, m, s, x = (F.col(c) for c in "amsx")
    assert values(df, amounts.zscore(a, m, s), amounts.zscore(a, m, s, "extractor")) == [(10.0, 0.0)]
    assert values(df, amounts.max_ratio(a, x), amounts.max_ratio(a, x, "extractor")) == [(0.0, 1.0)]
    assert values(df, amounts.unusual(a, m, s), amounts.unusual(a, m, s, "extractor")) == [(1, 0)]


def test_unknown_user_has_no_flags(spark):
    df = spark.createDataFrame([(30.0, None, None, None)], "a double, m double, s double, x double")
    a, m, s, x = (F.col(c) for c in "amsx")
    assert values(df, amounts.zscore(a, m, s), amounts.max_ratio(a, x), amounts.unusual(a, m, s),
                  amounts.largest(a, x), amounts.new_user(F.lit(None).cast("long"))) == [(None, 0.0, 0, 0, 0)]


@pytest.mark.parametrize(
    ("amount", "vpn", "risk", "status", "expected"),
    [
        (5000.0, True, 0.9, "declined", 1.0),
        (-1000.0, False, 0.0, "approved", -0.3),
        (100.0, None, 0.2, None, 0.09),
        (None, True, 0.5, "declined", 0.55),
    ],
)
def test_rule_score(spark, amount, vpn, risk, status, expected):
    df = spark.createDataFrame([(amount, vpn, risk, status)], "a double, v boolean, r double, s string")
    got = values(df, amounts.rule_score(F.col("a"), F.col("v"), F.col("r"), F.col("s")))[0][0]
    assert got == pytest.approx(expected)


def test_small_helpers(spark):
    df = spark.createDataFrame([("tablet", "New York, USA", 700.0, "12.5", "x"), (None, None, None, None, None)],
                               "d string, l string, a double, n string, bad string")
    assert values(df, amounts.device_code(F.col("d"))) == [(2,), (3,)]
    assert values(df, amounts.clamp(F.col("a"), 5.0, 500.0)) == [(500.0,), (None,)]
    assert values(df, codec.short_name(F.col("l")), codec.plain_name(F.col("l"))) == [
        ("new york_usa", "new_york_usa"), (None, None)
    ]
    assert codec.plain_name_of("New York, USA") == "new_york_usa"
    assert values(df, amounts.to_number(F.col("n")), amounts.to_number(F.col("bad"))) == [(12.5, None), (None, None)]
    assert values(df, codec.percent(F.lit(0.12345)))[0] == ("12.35%",)


def test_base64_and_json(spark):
    df = spark.createDataFrame([("eyJhIjogMX0=",), ("@@",), ("/w==",), (None,)], "d string")
    assert values(df, codec.base64_text(F.col("d"))) == [('{"a": 1}',), (None,), (None,), (None,)]


def test_width(spark):
    df = spark.createDataFrame([(["1", "2", "3"],)], "v array<string>")
    assert values(df, codec.fit_width(F.col("v"), 5), codec.fit_width(F.col("v"), 2)) == [
        (["1", "2", "3", "0", "0"], ["1", "2"])
    ]


def test_csv_text(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "a int, b int, c double")
    assert values(df, codec.csv_text(["c", "gone", "b", "a"], df.columns)) == [("2.5,0,0,1",)]
