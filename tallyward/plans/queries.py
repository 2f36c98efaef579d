"""The registered queries: every operator over the whole ``events`` table.

Queries give full doubles; ``rounded`` brings a result to the 10 decimals at which it
is compared with another engine.
"""

from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.functions import amounts, clock, codec
from tallyward.operators import (
    alerts, columns, correlate, encode, evaluate, rates, running, scale, scoring, split, stats, store,
)
from tallyward.plans import features, training
from tallyward.session import local_table, new_folder, parallelism
from tallyward.sources import envelopes, event_transactions, history, side_files
from tallyward.streaming import profile, scoring_stream
from tallyward.streaming.scorer import Scorer

DIGITS = 10
DOCUMENT_ROWS = 20_000

# Fixed times, so that a run can be repeated.
HISTORY_END = "2024-01-16 00:00:00"
NOW = "2024-02-01 00:00:00"


def tx(spark: SparkSession, folder: str) -> DataFrame:
    return event_transactions.read(spark, folder)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at 10 decimals; adding 0 leaves no negative zero."""
    doubles = [n for n, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, DIGITS) + F.lit(0.0) for c in doubles})


def at(text: str):
    """A fixed UTC moment, whatever zone the session is in."""
    return F.to_timestamp(F.lit(f"{text}+00:00"))


def number(column: str = "transaction_id"):
    """The event number in a transaction id."""
    return F.substring(column, 2, 20).cast("long")


def rule_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Label and a score that needs no training; ``flagged`` at 0.5, threshold included."""
    scored = scoring.with_rule_score(tx(spark, folder), "score")
    return scored.withColumn("flagged", evaluate.predicted(F.col("score")))


# --- features --------------------------------------------------------------


def load_profile(spark, folder):
    return history.profile(tx(spark, folder))


def time_features(spark, folder):
    return tx(spark, folder).select("transaction_id", *[c.alias(n) for n, c in clock.calendar(F.col("ts")).items()])


def time_features_text(spark, folder):
    """ISO text as it would come over the wire, some of it unreadable."""
    n, iso = number(), clock.to_text(F.col("ts"))
    text = (
        F.when(n % 131 == 0, F.lit(None).cast("string"))
        .when(n % 137 == 0, F.concat(F.substring(iso, 1, 19), F.lit(".250Z")))
        .when(n % 139 == 0, "not a time")
        .otherwise(iso)
    )
    read = tx(spark, folder).withColumn("ts", clock.parse_strict(text))
    return read.select(
        "transaction_id", F.col("ts").isNotNull().alias("readable"),
        *[c.alias(n) for n, c in clock.calendar_or_default(F.col("ts")).items()],
    )


def batch_time_text(spark, folder):
    """Batch parse of good ISO text, which fails on a bad one."""
    text = tx(spark, folder).select("transaction_id", clock.to_text(F.col("ts")).alias("timestamp"))
    return text.select(
        "transaction_id", clock.parse(F.col("timestamp")).cast("string").alias("parsed")
    )


def user_stats(spark, folder):
    return stats.user_stats(tx(spark, folder))


def user_stats_incremental(spark, folder):
    """Partial sums of two periods added up: equal to the statistics of both."""
    rows = tx(spark, folder)
    split_at = F.lit(HISTORY_END).cast("timestamp_ntz")
    old, new = rows.filter(F.col("ts") < split_at), rows.filter(F.col("ts") >= split_at)
    return stats.finish(stats.merge_partials(stats.partials(old), stats.partials(new)))


def user_stats_wide(spark, folder):
    """Statistics of three users with amounts of very different sizes: up to some 1e11 times as large as in the table, with
    many decimals, and all equal. Shown in proportion to each other."""
    n, rows = number(), tx(spark, folder)
    made = rows.select(
        "transaction_id", F.concat(F.lit("U"), (n % 3).cast("string")).alias("user_id"), "is_vpn",
        F.when(n % 3 == 0, F.col("amount") * 1e11).when(n % 3 == 1, F.round(F.col("amount") / 1e4, 7)).otherwise(9e8).alias("amount"))
    found = stats.user_stats(made)
    return found.select(
        "user_id", "user_transaction_count", (F.col("user_avg_amount") / F.col("user_max_amount")).alias("avg_to_max"),
        (F.col("user_amount_std") / F.col("user_avg_amount")).alias("std_to_avg"))


def feat_user_behavior(spark, folder):
    made = features.behaviour(tx(spark, folder))
    return made.select(
        "transaction_id", "user_id", "amount", "user_transaction_count", "user_avg_amount", "user_amount_std",
        "user_max_amount", "user_vpn_ratio", "amount_zscore", "amount_to_max_ratio", "is_unusual_amount",
        "is_new_user", "is_largest_tx",
    )


def category_fraud_rates(spark, folder):
    return rates.category_rates(tx(spark, folder))


def rate_encoded(spark, folder):
    rows = tx(spark, folder)
    made = rates.encode(rows, rates.fit(rows, rates.COLUMNS))
    return made.select("transaction_id", *S.RATE_FEATURES.values())


def rate_encoded_train_only(spark, folder):
    """Rates learned on train rows only, applied to all rows."""
    rows = split.stratified_split(tx(spark, folder))
    made = rates.encode(rows, rates.fit(rows.filter(F.col("split") == "train"), rates.COLUMNS))
    return made.select("transaction_id", "split", *S.RATE_FEATURES.values())


def rate_encoded_folds(spark, folder):
    """Each row by the labels of the other folds, test rows by all train rows."""
    rows = split.stratified_split(tx(spark, folder))
    fitted = rates.fit_folds(rows, rates.COLUMNS, among=F.col("split") == "train")
    return rates.encode(rows, fitted).select("transaction_id", "split", fitted.folds.of_row().alias("fold"), *S.RATE_FEATURES.values())


def rate_encoded_defaults(spark, folder):
    made = rates.encode_or_default(tx(spark, folder), rates.defaults(spark))
    return made.select("transaction_id", *S.RATE_FEATURES.values())


def one_hot_fitted(spark, folder):
    rows = tx(spark, folder)
    made = encode.one_hot(rows, encode.vocabulary(rows))
    return made.select("transaction_id", *columns.one_hot_columns(made.columns))


def one_hot_fixed(spark, folder):
    made = encode.one_hot(tx(spark, folder), encode.FIXED, keep_source=True)
    return made.select(
        "transaction_id", codec.short_name(F.col("location")).alias("location_short_name"),
        codec.plain_name(F.col("location")).alias("location_plain_name"),
        *columns.one_hot_columns(made.columns),
    )


def feature_frame(spark, folder):
    made = features.batch(tx(spark, folder))
    return features.model_frame(made).withColumn(S.LABEL, F.col(S.LABEL).cast("int"))


def location_risk(spark, folder):
    return rates.with_location_risk(tx(spark, folder)).select("transaction_id", "location_risk")


def rule_risk_score(spark, folder):
    return scoring.with_rule_score(tx(spark, folder)).select("transaction_id", "risk_score")


def clamped_amount(spark, folder):
    clamped = amounts.clamp(F.col("amount"), 5.0, 500.0)
    return tx(spark, folder).select("transaction_id", clamped.alias("clamped"))


def device_code(spark, folder):
    return tx(spark, folder).select("transaction_id", amounts.device_code(F.col("device_type")).alias("device_code"))


def _extracted(spark, folder) -> DataFrame:
    """Live features of all rows from the statistics of the time before ``HISTORY_END``."""
    rows = tx(spark, folder)
    earlier = rows.filter(F.col("ts") < F.lit(HISTORY_END).cast("timestamp_ntz"))
    return features.extractor(rows, stats.user_stats(earlier))


def extractor_features(spark, folder):
    made = _extracted(spark, folder)
    return made.select("transaction_id", *S.NUMERIC_FEATURES, *S.EXTRA_FEATURES)


_CSV = [
    "is_vpn", "hour_of_day", "day_of_week", "month", "day_of_month", "is_weekend", "is_night",
    "user_transaction_count", "is_unusual_amount", "is_new_user", "is_largest_tx", "not_a_feature",
    *[encode.column_name(c, v) for c in ("device_type", "card_type", "status", "location") for v in encode.FIXED[c]],
]


def feature_csv(spark, folder):
    """Feature text in manifest order; an unknown name is ``0``; padded to the model width."""
    made = _extracted(spark, folder)
    text = codec.csv_text(_CSV, made.columns)
    padded = codec.fit_width(F.split(text, ","), S.MODEL_WIDTH)
    cut = codec.fit_width(F.split(text, ","), 8)
    return made.select(
        "transaction_id", text.alias("csv"), F.concat_ws(",", padded).alias("padded"), F.concat_ws(",", cut).alias("cut")
    )


def running_user_profile(spark, folder):
    made = running.running_profile(tx(spark, folder))
    return made.select("transaction_id", "user_id", "running_count", "running_avg")


# --- evaluation ------------------------------------------------------------


def flags_at_threshold(spark, folder):
    scored = rule_scored(spark, folder)
    p = F.col("score")
    return scored.select(
        "transaction_id", "is_fraud", "score",
        evaluate.predicted(p, 0.5).alias("flag_batch"), evaluate.predicted(p, 0.5, strict=True).alias("flag_stream"),
        (evaluate.predicted(p, 0.5) == F.col("is_fraud")).alias("correct"),
    )


def confusion_matrix(spark, folder):
    return evaluate.confusion(rule_scored(spark, folder))


def classification_report(spark, folder):
    return evaluate.report(confusion_matrix(spark, folder))


def business_metrics(spark, folder):
    made = evaluate.business(confusion_matrix(spark, folder))
    return made.withColumn("detection_text", codec.percent(F.round("detection_rate", 4)))


def positive_rates(spark, folder):
    return evaluate.positive_rates(confusion_matrix(spark, folder))


def roc_auc(spark, folder):
    return evaluate.roc_auc(rule_scored(spark, folder))


def roc_points(spark, folder):
    return evaluate.roc_points(rule_scored(spark, folder))


def threshold_sweep(spark, folder):
    return evaluate.threshold_sweep(rule_scored(spark, folder))


def recommended_threshold(spark, folder):
    return evaluate.recommended_threshold(evaluate.threshold_sweep(rule_scored(spark, folder)))


def first5_per_class(spark, folder):
    scored = rule_scored(spark, folder)
    return evaluate.first_per_class(scored).select(
        "transaction_id", "is_fraud", "place", "score", "amount", "is_vpn",
        (F.col("flagged") == F.col("is_fraud")).alias("correct"),
    )


def _correlations(spark, folder) -> DataFrame:
    frame = features.batch(tx(spark, folder))
    return correlate.pairwise(frame, [S.LABEL, *columns.numeric_columns(frame)])


def correlation_with_label(spark, folder):
    return correlate.with_label(_correlations(spark, folder))


def correlation_top15(spark, folder):
    return correlate.top_matrix(_correlations(spark, folder))


# --- splits and samples ----------------------------------------------------


def stratified_split(spark, folder):
    return split.stratified_split(tx(spark, folder)).select("transaction_id", "is_fraud", "split")


def split_summary(spark, folder):
    return split.split_summary(split.stratified_split(tx(spark, folder)))


def validation_split(spark, folder):
    return split.three_way_split(tx(spark, folder)).select("transaction_id", "is_fraud", "split")


def class_ratio_sample(spark, folder):
    return split.class_ratio_sample(tx(spark, folder), 500, 0.2).select("transaction_id", "is_fraud")


def standard_scaled(spark, folder):
    """Fit on train rows, applied to all rows; shown at 6 decimals, as a fitted number's last bits follow the order of
    the rows."""
    rows = split.stratified_split(tx(spark, folder))
    frame = features.batch(rows)
    scales = scale.fit(frame.filter(F.col("split") == "train"), S.NUMERIC_FEATURES)
    scaled = scale.transform(frame, scales)
    return scaled.select("transaction_id", "split", *[F.round(c, 6).alias(c) for c in S.NUMERIC_FEATURES])


def sorted_timeline(spark, folder):
    return history.timeline(tx(spark, folder)).select(
        "transaction_id", clock.to_text(F.col("ts")).alias("timestamp"), "user_id", "amount"
    )


def head_n(spark, folder):
    return history.head(tx(spark, folder), 1000).select("transaction_id", "user_id", "amount", "status")


# --- store, alerts, envelopes ----------------------------------------------


def _predictions(spark, folder) -> DataFrame:
    """All rows decided by rules, as a stream without a model would."""
    scored = scoring.with_rule_score(tx(spark, folder))
    decided = scoring.decide(scored, F.lit(None).cast("double"))
    return store.stored_form(decided, at(NOW))


def alert_rows(spark, folder):
    """Alerts where the rule score stands in for a model, and their JSON text read back."""
    rows = scoring.with_rule_score(tx(spark, folder)).withColumn("timestamp", clock.to_text(F.col("ts")))
    made = alerts.alerts(scoring.decide(rows, "risk_score"))
    message = F.from_json("message", "subject string, amount double, risk_factors array<string>")
    return made.withColumn("_m", message).select(
        "subject", "transaction_id", "user_id", "amount", "timestamp", "fraud_probability",
        F.array_join("risk_factors", " | ").alias("risk_factors"),
        F.col("_m.subject").alias("message_subject"), F.col("_m.amount").alias("message_amount"),
        F.array_join("_m.risk_factors", " | ").alias("message_risk_factors"),
    )


def merged_store(spark, folder):
    """Transaction and prediction as one record; predicted ``is_fraud`` replaces the label."""
    rows = tx(spark, folder)
    given = rows.select("*", F.struct(*rows.columns).alias("given"))
    decided = store.stored_form(scoring.decide(scoring.with_rule_score(given), F.lit(None).cast("double")), at(NOW))
    prediction = F.struct("fraud_probability", "is_fraud", "prediction_timestamp", "ttl", "expiry_date", "error")
    merged = columns.merge_structs(decided.select("given", prediction.alias("prediction")), "given", "prediction")
    merged = merged.withColumn("amount_exact", amounts.exact(F.col("amount")))
    return merged.select(
        "transaction_id", "user_id", F.col("amount_exact").cast("string").alias("amount_exact"), "status",
        "fraud_probability", "is_fraud", "prediction_timestamp", "ttl", "expiry_date", "error",
    )


def _versions(spark, folder) -> DataFrame:
    """Three deliveries of stored rows: everything, declined rows again, VPN rows again."""
    rows = tx(spark, folder)

    def delivery(df, version, factor):
        return df.select(
            "transaction_id", "user_id", (F.col("amount") * factor).alias("amount"), F.lit(version).alias("version")
        )

    return (
        delivery(rows, 1, 1.0)
        .unionByName(delivery(rows.filter(F.col("status") == "declined"), 2, 2.0))
        .unionByName(delivery(rows.filter("is_vpn"), 3, 4.0))
    )


def appended_batches(spark, folder):
    """All deliveries, copies of a key included."""
    return _versions(spark, folder)


def latest_by_key(spark, folder):
    return store.latest(_versions(spark, folder))


def upserted(spark, folder):
    """Three deliveries appended to a store, the second by another query, one of them twice, with merges in between; then
    what is current."""
    path = new_folder(spark, "store")
    rows = store.stored_form(_versions(spark, folder), at(NOW)).withColumn("given", F.col("version"))
    for version, query, started in ((1, "a", 0), (2, "b", 7), (3, "a", 9), (3, "a", 9)):
        store.append(rows.filter(F.col("given") == version), version, path, query, started)
        if version != 2:
            store.merge(spark, path, at(NOW))
    current = store.read(spark, path, at(NOW))
    return current.select("transaction_id", "user_id", "amount", F.col("given").alias("version"))


def live_rows(spark, folder):
    """Rows stored at their own time that have not expired by ``NOW``."""
    stored = tx(spark, folder).select(
        "transaction_id", (clock.epoch(F.col("ts")) + S.TTL_SECONDS).alias("ttl")
    )
    return store.live(stored, at(NOW))


def rows_of_user(spark, folder):
    """All stored rows of the user with the smallest id, out of a store."""
    path = new_folder(spark, "store")
    store.append(_predictions(spark, folder), 0, path)
    first = tx(spark, folder).agg(F.min("user_id")).first()[0]
    return store.of_user(spark, path, first, at(NOW)).select(
        "transaction_id", "user_id", "amount", "fraud_probability", "is_fraud"
    )


def wire_lines(spark, folder) -> DataFrame:
    """Every transaction as one envelope line, some of them damaged.

    What is done to a line follows from its event number, so it can be told
    beforehand what must become of it.
    """
    rows = tx(spark, folder).withColumn("timestamp", clock.to_text(F.col("ts"))).withColumn("n", number())
    n = F.col("n")
    text = F.col("amount").cast("string")
    fields = [f.name for f in S.TRANSACTION.fields if f.name != "amount"]
    as_number = F.to_json(F.struct(*fields, "amount"))
    damaged = (
        F.when(n % 109 == 0, "n/a").when(n % 127 == 0, "NaN").when(n % 131 == 0, "Infinity").when(n % 137 == 0, "1e17")
        .otherwise(text)
    )
    as_text = F.to_json(F.struct(*fields, damaged.alias("amount")))
    other_vpn = [F.lit("yes").alias(f) if f == "is_vpn" else F.col(f) for f in fields]
    bad_vpn = F.to_json(F.struct(*other_vpn, "amount"))
    no_id = F.to_json(F.struct(*fields[1:], "amount"))
    payload = (
        F.when(n % 103 == 0, F.expr("substring(as_number, 1, length(as_number) - 5)"))
        .when(n % 107 == 0, no_id)
        .when(n % 139 == 0, bad_vpn)
        .when(n % 149 == 0, F.concat(F.col("as_number"), F.lit("\n"), F.col("as_number")))
        .when(n % 151 == 0, F.concat(F.col("as_number"), F.lit(" garbage")))
        .when((n % 109 == 0) | (n % 113 == 0) | (n % 127 == 0) | (n % 131 == 0) | (n % 137 == 0), F.col("as_text"))
        .otherwise(F.col("as_number"))
    )
    data = F.when(n % 101 == 0, "@@").otherwise(F.base64(F.encode(payload, "UTF-8")))
    prepared = rows.withColumns({"as_number": as_number, "as_text": as_text})
    record = F.struct(F.struct(data.alias("data")).alias("kinesis"))
    line = (
        F.when(n % 59 == 0, '{"Records": []}')
        .when(n % 53 == 0, F.concat(F.lit('{"transaction": '), F.when(n % 3 == 0, bad_vpn).when(
            n % 5 == 0, F.to_json(F.struct(*fields, F.lit("Infinity").alias("amount")))).otherwise(F.col("as_number")), F.lit("}")))
        .when(n % 157 == 0, F.concat(F.to_json(F.struct(F.array(record).alias("Records"))), F.lit("{}")))
        .otherwise(F.to_json(F.struct(F.array(record).alias("Records"))))
    )
    return prepared.select(F.col("transaction_id").alias("line_id"), line.alias("value"))


def route_envelopes(spark, folder):
    routed = envelopes.route(envelopes.parse(wire_lines(spark, folder)))
    return routed.select("line_id", "route", F.coalesce(F.size("Records"), F.lit(0)).alias("records"))


def decode_reject(spark, folder):
    decoded = envelopes.decode(envelopes.parse(wire_lines(spark, folder)))
    names_id = F.col("raw").rlike("T[0-9]{8}").alias("raw_names_id")
    return decoded.select("transaction_id", "user_id", "amount", "is_vpn", "route", "reason", names_id)


def _streamed(spark, folder) -> tuple[scoring_stream.Places, DataFrame]:
    """Publish the lines, let the stream work them off, give what is stored."""
    places = scoring_stream.Places(new_folder(spark, "stream"))
    wire_lines(spark, folder).select("value").repartition(2 * parallelism(spark)).write.text(places.at("envelopes"))
    rows = tx(spark, folder)
    earlier = rows.filter(F.col("ts") < F.lit(HISTORY_END).cast("timestamp_ntz"))
    side_files.write_user_stats(stats.user_stats(earlier), places.at("user_stats"))
    scorer = Scorer(rates.defaults(spark))
    return places, scoring_stream.replay(spark, places, scorer, at(NOW), files_per_batch=parallelism(spark))


def stream_scored(spark, folder):
    _, stored = _streamed(spark, folder)
    return stored.select(
        "transaction_id", "user_id", "amount", "is_vpn", "fraud_probability", "is_fraud", "ttl",
        F.col("feature_values.hour_of_day").alias("hour_of_day"),
        F.col("feature_values.amount_zscore").alias("amount_zscore"),
        F.col("feature_values.location_fraud_rate").alias("location_fraud_rate"),
    )


def stream_learned_scored(spark, folder):
    """A stream that learns: rows up to ``HISTORY_END`` in one delivery, the later ones in the next, which also brings
    some of the first again, with twice the amount. The statistics of a row count what was delivered before, each id
    once; a corrected record is scored and stored anew."""
    places = scoring_stream.Places(new_folder(spark, "stream"))
    rows = tx(spark, folder).filter((number() % 3) > 0)
    side_files.write_user_partials(stats.partials(tx(spark, folder).filter((number() % 3) == 0)), places.at("user_partials"))
    early = F.col("ts") < F.lit(HISTORY_END).cast("timestamp_ntz")
    scorer = Scorer(rates.defaults(spark))
    again = rows.filter(early & (number() % 7 == 0)).withColumn("amount", F.col("amount") * 2)
    for part in (rows.filter(early), rows.filter(~early).unionByName(again)):
        envelopes.publish(history.wire_form(part).drop("is_fraud"), places.at("envelopes"))
        stored = scoring_stream.replay(spark, places, scorer, at(NOW), files_per_batch=10_000, learn=True)
    v = "feature_values"
    return stored.select(
        "transaction_id", "amount", F.col(f"{v}.user_transaction_count").alias("user_transaction_count"),
        F.col(f"{v}.user_avg_amount").alias("user_avg_amount"), F.col(f"{v}.amount_zscore").alias("amount_zscore"))


def stream_test_result(spark, folder):
    """All transactions sent through a stream of their own, and the row that is kept about it."""
    places = scoring_stream.Places(new_folder(spark, "stream"))
    rows = tx(spark, folder)
    side_files.write_user_stats(stats.user_stats(rows), places.at("user_stats"))
    sent = history.wire_form(rows).drop("is_fraud")
    made = scoring_stream.try_out(spark, places, sent, Scorer(rates.defaults(spark)), at(NOW))
    return made.select("sent", "processed", "fraud_detected", "avg_fraud_probability", "complete_enough")


def stream_summary(spark, folder):
    """Batch summaries added up, and the rows of the alert and reject sinks."""
    places, _ = _streamed(spark, folder)
    counts = spark.read.json(places.at("summaries")).agg(
        F.sum("processed_count").alias("processed_count"), F.sum("fraud_count").alias("fraud_count")
    )
    rows = counts.select(F.expr("stack(2, 'processed', processed_count, 'fraud', fraud_count) as (what, n)"))
    for sink in ("alerts", "rejects"):
        found = spark.read.json(places.at(sink)).agg(F.count(F.lit(1)).alias("n"))
        rows = rows.unionByName(found.select(F.lit(sink).alias("what"), "n"))
    return rows


def log_replay(spark, folder):
    """Transactions through a log in shards: two appends, read in two runs of one stream. The first run ends inside an append,
    the second goes on there; each record comes once."""
    rows = history.wire_form(tx(spark, folder))
    path, out, checkpoint = (new_folder(spark, name) for name in ("log", "read", "checkpoint"))
    late = F.coalesce(F.col("timestamp") >= HISTORY_END.replace(" ", "T"), F.lit(False))
    for part, records in ((rows.filter(~late), 100), (rows.filter(late), 0)):
        envelopes.publish_to_log(part.drop("is_fraud"), path)
        lines = envelopes.read_log(spark, path, "trim", records=records)
        envelopes.decode(lines).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).select("transaction_id", "user_id", "timestamp", "amount", "is_vpn", "reason")


def stream_profile(spark, folder):
    """User statistics learned by the stream, batch by batch, without reading history."""
    places = scoring_stream.Places(new_folder(spark, "learn"))
    source = event_transactions.read_stream(spark, folder)
    query = (
        source.writeStream.option("checkpointLocation", places.at("checkpoint"))
        .foreachBatch(lambda batch, i: profile.learn(batch, i, places.at("profile"), merge_every=2))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return profile.current(spark, places.at("profile"))


def _sent_and_stored(spark, folder) -> tuple[DataFrame, DataFrame]:
    """All ids that were sent, and the predictions of the records that could be read."""
    sent = tx(spark, folder).select("transaction_id")
    decoded = envelopes.decode(envelopes.parse(wire_lines(spark, folder)))
    scored = scoring.with_rule_score(envelopes.accepted(decoded))
    return sent, scoring.decide(scored, F.lit(None).cast("double"))


def found_ids(spark, folder):
    sent, stored = _sent_and_stored(spark, folder)
    return store.found(stored, sent).select("transaction_id", "fraud_probability", "is_fraud")


def missing_ids(spark, folder):
    sent, stored = _sent_and_stored(spark, folder)
    return store.missing(stored, sent)


def round_trip_summary(spark, folder):
    return store.round_trip(*_sent_and_stored(spark, folder))


# --- files -----------------------------------------------------------------


def json_round_trip(spark, folder):
    """History written as JSON lines, read back with the declared schema."""
    path = new_folder(spark, "history")
    history.write_json(tx(spark, folder), path)
    history.write_json(tx(spark, folder), path, mode="ignore")  # a second load does nothing
    back = history.read_json(spark, path)
    return back.select(*[f.name for f in S.HISTORY.fields], F.hour("ts").alias("hour_of_day"))


def history_document_round_trip(spark, folder):
    """History written as indented array documents and as lines, some of the records damaged, and taken in again.

    A fifth of the events are lines, some with text behind the record. The others are documents of about
    ``DOCUMENT_ROWS`` records each, in the order of the event number.
    """
    rows = history.wire_form(tx(spark, folder)).withColumn("n", number())
    n, root = F.col("n"), new_folder(spark, "documents")
    fields = [f.name for f in S.HISTORY.fields]

    def text(options=None, **other):
        return F.to_json(F.struct(*[other.get(f, F.col(f)).alias(f) for f in fields]), options)

    def record(options=None):
        return (
            F.when(n % 61 == 0, text(options, is_vpn=F.lit("yes"))).when(n % 67 == 0, text(options, amount=F.lit("n/a")))
            .when(n % 71 == 0, text(options, is_fraud=F.lit(None).cast("boolean"))).when(n % 73 == 0, text(options, timestamp=F.lit("yesterday")))
            .when((n % 5 == 0) & (n % 7 == 0), F.concat(text(options), F.when(n % 2 == 0, F.lit(" ")).otherwise(F.lit(", ")), text(options)))
            .otherwise(text(options))
        )

    rows.filter(n % 5 == 0).select(record().alias("value")).write.text(f"{root}/in/doc=-1")
    parts = -(-rows.count() // DOCUMENT_ROWS)
    doc = F.pmod(F.xxhash64("transaction_id"), F.lit(parts)).cast("int")
    lines = rows.filter(n % 5 != 0).select(doc.alias("doc"), n.alias("at"), record({"pretty": "true"}).alias("value"))
    order = Window.partitionBy("doc").orderBy("at")
    first, last = F.lag("at").over(order).isNull(), F.lead("at").over(order).isNull()
    value = F.concat(F.when(first, "[\n").otherwise(""), "value", F.when(last, "\n]").otherwise(","))
    documents = lines.select("doc", "at", value.alias("value"))
    documents.sortWithinPartitions("doc", "at").select("doc", "value").write.partitionBy("doc").mode("append").text(f"{root}/in")
    taken = history.ingest(spark, f"{root}/in", root)
    rejects = spark.read.schema("raw string, reason string").json(f"{root}/rejects")
    found_id = F.regexp_extract("raw", "T[0-9]{8}", 0)
    return taken.select("transaction_id", "user_id", "timestamp", "amount", "is_fraud", F.lit(None).cast("string").alias("reason")).unionByName(
        rejects.select(found_id.alias("transaction_id"), "reason"), allowMissingColumns=True)


def publish_round_trip(spark, folder):
    """Messages by key and their text, read back field by field."""
    rows = tx(spark, folder).withColumn("timestamp", clock.to_text(F.col("ts")))
    sent = envelopes.publish_form(rows)
    return codec.with_record(sent, F.col("value"), S.TRANSACTION, "r").select(
        "key", *[F.col(f"r.{f.name}").alias(f.name) for f in S.TRANSACTION.fields]
    )


def libsvm_round_trip(spark, folder):
    """The training matrix written as LIBSVM and read back."""
    frame = features.batch(tx(spark, folder))
    names = columns.model_columns(frame)
    path = new_folder(spark, "libsvm")
    history.write_matrix(frame, names, path)
    return history.read_matrix(spark, path, names)


def manifest(spark, folder):
    """Feature names in order with their kind, written and read back."""
    path = new_folder(spark, "manifest")
    frame = features.batch(tx(spark, folder))
    made = columns.manifest_of(columns.model_columns(frame))
    side_files.write_small(side_files.manifest_row(spark, made), path)
    back = side_files.read_manifest(spark, path)
    rows = [
        (i, name, "categorical" if name in set(back["categorical_features"]) else "numeric")
        for i, name in enumerate(back["feature_names"], 1)
    ]
    return local_table(
        spark, rows, pa.schema([("position", pa.int32()), ("feature", pa.string()), ("kind", pa.string())])
    )


def model_parameters(spark, folder):
    """Named values of each transaction without the private ones (name with ``_`` first)."""
    named = F.create_map(
        F.lit("_user"), F.col("user_id"), F.lit("status"), F.col("status"), F.lit("_device"), F.col("device_type"),
        F.lit("card"), F.col("card_type"),
    )
    public = tx(spark, folder).select("transaction_id", columns.public_entries(named).alias("m"))
    return public.select(
        "transaction_id", F.size("m").alias("entries"), F.array_join(F.map_keys("m"), ",").alias("names"),
        F.col("m")["status"].alias("status"), F.col("m")["_user"].alias("private"),
    )


def model_metadata(spark, folder):
    """Name, job, public settings and features of a model's metadata, written and read back, one row each."""
    frame = features.batch(tx(spark, folder))
    made = columns.manifest_of(columns.model_columns(frame))
    settings = training.Parameters(maxDepth=5).as_dict() | {"_job_id": "j-1"}
    path = new_folder(spark, "metadata")
    side_files.write_small(side_files.metadata_row(spark, "fraud-trees", "trial-1", settings, made, 0.0), path)
    kept = side_files.read_metadata(spark, path)
    part = lambda kind, name, value: F.struct(F.lit(kind).alias("kind"), name.alias("name"), value.alias("value"))
    return kept.select(F.inline(F.concat(
        F.array(part("model", F.lit("name"), F.col("model_name")), part("model", F.lit("job"), F.col("training_job"))),
        F.transform(F.map_entries("hyperparameters"), lambda e: part("setting", e["key"], e["value"])),
        F.transform("feature_info.feature_names", lambda f, i: part("feature", f, (i + 1).cast("string"))),
    )))


# --- models ----------------------------------------------------------------

_MATRICES: dict[tuple[str, str], tuple] = {}
_MODELS: dict[tuple[str, str], str] = {}


def _prepared(spark, folder):
    """Matrix and names; made once per session and data folder. Its passes read the rows as even files: an events file is
    read by as many tasks as it has row groups."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _MATRICES:
        rows = tx(spark, folder)
        parts = training.parts_for(rows.count(), spark.sparkContext.defaultParallelism)
        matrix, names, _ = training.prepare(training.written(rows.repartition(parts), "transactions"))
        _MATRICES[key] = (matrix, names)
    return _MATRICES[key]


def _trained(spark, folder):
    """Matrix, names and fitted model; trained once per session and data folder."""
    matrix, names = _prepared(spark, folder)
    key = (spark.sparkContext.applicationId, folder)
    if key not in _MODELS:
        path = new_folder(spark, "model")
        training.train(matrix, names).write().overwrite().save(path)
        _MODELS[key] = path
    return matrix, names, training.PipelineModel.load(_MODELS[key])


def scored_by_trees(spark, folder) -> DataFrame:
    matrix, names, model = _trained(spark, folder)
    return training.score(model, matrix.filter(F.col("split") == "test"), names)


def gbt_scored(spark, folder):
    """The test rows and what is determined of their scores, whatever trees were grown."""
    scored = scored_by_trees(spark, folder)
    p = F.col("score")
    return scored.select(
        "transaction_id", "is_fraud", ((p >= 0) & (p <= 1)).alias("is_probability"),
        (F.col("flagged") == (p >= 0.5)).alias("flagged_from_half"),
    )


# what a useful model reaches on these transactions
FLOORS = {"roc_auc": 0.8, "detection_rate": 0.6, "true_positive_rate": 0.6, "precision": 0.4}


def gbt_metrics(spark, folder):
    """Sizes of the metrics as they are, the others as whether they are above their floor and at most 1."""
    made = training.metrics(scored_by_trees(spark, folder))
    sizes = made.filter(F.col("metric").isin("test_size", "unscored", "failed_scores")).select("metric", "value")
    floors = F.create_map(*[F.lit(x) for pair in FLOORS.items() for x in pair])
    judged = made.filter(F.col("metric").isin(list(FLOORS))).distinct().select(
        "metric", F.col("value").between(floors[F.col("metric")], F.lit(1.0)).cast("double").alias("value"))
    found = made.filter(F.col("metric").isin("fraud_cases_detected", "fraud_cases_missed"))
    frauds = found.agg(F.sum("value").alias("value")).select(F.lit("frauds").alias("metric"), "value")
    return sizes.unionByName(judged).unionByName(frauds)


def tuning_trials(spark, folder):
    """Number of trials, how many are the best, whether that has the greatest area, and whether all settings are in range."""
    matrix, names = _prepared(spark, folder)
    with ThreadPool(1) as pool:  # the fit with the usual settings runs beside the search, whose rounds of fits leave cores idle
        usual = pool.apply_async(_trained, (spark, folder))
        trials = training.trial_table(spark, training.tune(matrix, names))
        usual.get()
    p = lambda n: F.col("parameters")[n].cast("double")
    in_range = p("maxDepth").between(3, 10) & p("stepSize").between(0.01, 0.3) & p("subsamplingRate").between(0.5, 1.0)
    return trials.agg(
        F.count("*").alias("trials"), F.count_if("best").alias("best_trials"),
        (F.max(F.when(F.col("best"), F.col("auc"))) == F.max("auc")).alias("best_is_greatest"),
        F.every(F.col("auc").between(0.5, 1.0)).alias("areas_are_areas"), F.every(in_range).alias("settings_in_range"),
        F.every(F.col("rounds").between(1, p("maxIter"))).alias("rounds_in_range"),
    )
