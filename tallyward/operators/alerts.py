"""Alert rows for flagged transactions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.functions.codec import json_text, risk_factors
from tallyward.sources.envelopes import with_defaults


def alerts(scored: DataFrame) -> DataFrame:
    """One message per flagged row, its columns and its JSON text."""
    subject = F.concat(F.lit(S.ALERT_SUBJECT), F.col("transaction_id"))
    flagged = with_defaults(scored.filter(F.col("is_fraud")))
    rows = flagged.select(
        subject.alias("subject"), "transaction_id", "user_id", "amount", "timestamp", "fraud_probability",
        risk_factors().alias("risk_factors"),
    )
    return rows.withColumn("message", json_text(*rows.columns))
