"""Transactions as a view over an ``events`` table.

Columns are narrow projections of the event columns, so a query that needs two of
them reads only what those two are made of.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# fixed values: how an event maps to a transaction
_USER = """
CASE WHEN event_id % 499 = 7 THEN NULL
     WHEN event_id % 211 = 0 THEN concat('U9', cast(event_id AS string))
     WHEN event_id % 199 = 0 THEN concat('U8', cast(cast(floor(event_id / 597.0) AS int) AS string))
     ELSE concat('U', cast(10000 + user_id AS string)) END"""
_DEVICE = "CASE WHEN k % 10 < 4 THEN 'mobile' WHEN k % 10 < 9 THEN 'desktop' ELSE 'tablet' END"
_LOCATION = """
CASE WHEN event_id % 97 = 0 THEN NULL
     WHEN event_id % 89 = 0 THEN 'Oslo, Norway'
     WHEN k >= 90 THEN CASE k % 5 WHEN 0 THEN 'London, UK' WHEN 1 THEN 'Paris, France'
          WHEN 2 THEN 'Berlin, Germany' WHEN 3 THEN 'Tokyo, Japan' ELSE 'Sydney, Australia' END
     ELSE CASE user_id % 5 WHEN 0 THEN 'California, USA' WHEN 1 THEN 'New York, USA'
          WHEN 2 THEN 'Texas, USA' WHEN 3 THEN 'Florida, USA' ELSE 'Illinois, USA' END END"""
_CARD = """
CASE WHEN (user_id + k) % 20 < 9 THEN 'credit' WHEN (user_id + k) % 20 < 19 THEN 'debit' ELSE 'gift' END"""
_STATUS = "CASE event_type WHEN 'error' THEN 'declined' WHEN 'signup' THEN 'pending' ELSE 'approved' END"
_FRAUD = "value > 150 OR (event_type = 'error' AND k >= 50) OR (k >= 90 AND k % 7 = 0)"


def from_events(events: DataFrame) -> DataFrame:
    """Labelled transactions; works on a table and on a stream of events."""
    keyed = events.withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))
    return keyed.selectExpr(
        "concat('T', lpad(cast(event_id AS string), 8, '0')) AS transaction_id",
        f"{_USER} AS user_id",
        "ts",
        "value AS amount",
        f"{_DEVICE} AS device_type",
        f"{_LOCATION} AS location",
        "k % 7 = 0 AS is_vpn",
        f"{_CARD} AS card_type",
        f"{_STATUS} AS status",
        f"({_FRAUD}) AS is_fraud",
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    return from_events(spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet"))


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(folder)
    return from_events(events)
