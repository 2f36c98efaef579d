"""Record envelopes: publish, route, decode, reject.

Bad input never fails a batch: each unreadable record becomes a row of the reject
table with a reason, and the rest goes on.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.functions import amounts, codec
from tallyward.sources import shard_log

VALID = "valid"


def publish_form(df: DataFrame) -> DataFrame:
    """(key, value) messages: transaction id and its JSON text."""
    names = [f.name for f in S.TRANSACTION.fields]
    return df.select(F.col("transaction_id").alias("key"), codec.json_text(*names).alias("value"))


def publish(df: DataFrame, path: str, mode: str = "append") -> None:
    """Messages as envelope lines, one record each, spread by key."""
    messages = publish_form(df).repartition("key")
    envelope(F.base64(F.encode("value", "UTF-8")), messages).write.mode(mode).text(path)


def envelope(data, df: DataFrame) -> DataFrame:
    return df.select(_line(data).alias("value"))


def _line(data) -> Column:
    record = F.struct(F.struct(data.alias("data")).alias("kinesis"))
    return F.to_json(F.struct(F.array(record).alias("Records")))


def publish_to_log(df: DataFrame, path: str, at: int | None = None) -> int:
    """Messages as envelope lines of a log in shards, see ``shard_log``."""
    messages = publish_form(df)
    return shard_log.append(messages.select("key", _line(F.base64(F.encode("value", "UTF-8"))).alias("value")), path, at)


def read_log(spark: SparkSession, path: str, start: str = "latest", hours: float | None = None,
             records: int = shard_log.RECORDS) -> DataFrame:
    """Envelope lines of a log in shards as a stream with positions of its own."""
    return parse(shard_log.read_stream(spark, path, start, hours, records).select("value"))


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Envelope lines as a stream, as text: a line that can't be read is kept."""
    return parse(spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    return parse(spark.read.text(path))


def parse(lines: DataFrame, column: str = "value") -> DataFrame:
    """Envelope text of one column to envelope fields; the text stays beside them."""
    # one value, but with a field of another type: what can be read of it counts
    read = codec.with_record(lines, F.col(column), S.ENVELOPE, "_envelope", lambda text: F.when(
        codec.is_one_value(text), F.from_json(text, S.ENVELOPE)))
    return read.select(*lines.columns, *[F.col(f"_envelope.{f.name}").alias(f.name) for f in S.ENVELOPE.fields])


def route(envelopes: DataFrame) -> DataFrame:
    """Adds ``route``: records, direct or invalid. An empty record list falls through."""
    some = F.coalesce(F.size("Records") > 0, F.lit(False))
    return envelopes.withColumn(
        "route",
        F.when(some, "records").when(F.col("transaction").isNotNull(), "direct").otherwise("invalid"),
    )


def decode(envelopes: DataFrame, line: str = "value") -> DataFrame:
    """All records of all routes as transactions, with ``reason`` = valid or why not.

    Both routes are read by the same rules. A record that is no JSON of the declared types, or with more text behind
    it, gives no fields; every reject keeps its text in ``raw``: the record's, or as much as there is of it (its base64, the whole line). One
    pass, no shuffle: each envelope is expanded in place.
    """
    def item(data, text):
        return F.struct(data.alias("data"), text.alias("text"))

    none = F.lit(None).cast("string")
    expanded = route(envelopes).withColumn(
        "_item",
        F.explode(
            F.when(F.col("route") == "records", F.transform(
                "Records", lambda r: item(r["kinesis"]["data"], codec.base64_text(r["kinesis"]["data"]))))
            .when(F.col("route") == "direct", F.array(item(none, F.col("transaction"))))
            .otherwise(F.array(item(none, none)))
        ),
    )
    text = F.col("_item.text")
    read = codec.with_record(expanded, text, S.WIRE_TRANSACTION, "_json")
    broken = F.col("_json").isNull()
    names = [f.name for f in S.WIRE_TRANSACTION.fields]
    fields = read.withColumns({n: F.when(~broken, F.col(f"_json.{n}")) for n in names})
    number = amounts.to_number(F.col("amount"))
    reason = (
        F.when(F.col("route") == "invalid", "invalid_envelope")
        .when(text.isNull(), "bad_base64")
        .when(broken, codec.unread(text, S.WIRE_TRANSACTION))
        .when(F.col("transaction_id").isNull(), "no_transaction_id")
        .when(F.col("amount").isNotNull() & number.isNull(), "bad_amount")
        .otherwise(VALID)
    )
    kept = F.coalesce(text, F.col("_item.data"), *([F.col(line)] if line in envelopes.columns else []))
    return (
        fields.withColumn("reason", reason)
        .withColumn("amount", number)
        .select(*names, "route", "reason", F.when(F.col("reason") != VALID, kept).alias("raw"))
    )


def accepted(decoded: DataFrame) -> DataFrame:
    """Valid transactions as they came; absent values stay absent."""
    return decoded.filter(F.col("reason") == VALID).drop("route", "reason", "raw")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason") != VALID).select("transaction_id", "route", "reason", "raw")


# fixed values: what an absent field counts as
ABSENT = {
    "amount": 0.0, "device_type": "unknown", "card_type": "unknown", "is_vpn": False,
    "location": "Unknown", "status": "approved",
}


def with_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in ABSENT.items()})
