"""Declared schemas, vocabularies and lookup values.

Input is read with these schemas, never inferred, so a missing field or a
wrong type shows at once instead of changing the plan.
"""

from pyspark.sql import types as T

# --- fixed values ----------------------------------------------------------

DEVICE_TYPES = ["mobile", "desktop", "tablet"]
CARD_TYPES = ["credit", "debit", "gift"]
STATUSES = ["approved", "pending", "declined"]
LOCATIONS = [
    "California, USA", "New York, USA", "Texas, USA", "Florida, USA", "Illinois, USA",
    "London, UK", "Paris, France", "Berlin, Germany", "Tokyo, Japan", "Sydney, Australia",
]

LOCATION_RISK = {
    "California, USA": 0.2, "New York, USA": 0.2, "Texas, USA": 0.2, "Florida, USA": 0.3,
    "Illinois, USA": 0.2, "London, UK": 0.3, "Paris, France": 0.4, "Berlin, Germany": 0.4,
    "Tokyo, Japan": 0.5, "Sydney, Australia": 0.5, "Unknown": 0.9,
}
UNLISTED_LOCATION_RISK = 0.7

DEFAULT_RATES = {
    "location": {
        "California, USA": 0.02, "New York, USA": 0.02, "Texas, USA": 0.02, "Florida, USA": 0.03,
        "Illinois, USA": 0.02, "London, UK": 0.03, "Paris, France": 0.04, "Berlin, Germany": 0.04,
        "Tokyo, Japan": 0.05, "Sydney, Australia": 0.05, "Unknown": 0.09,
    },
    "device_type": {"mobile": 0.03, "desktop": 0.01, "tablet": 0.02},
    "card_type": {"credit": 0.025, "debit": 0.01, "gift": 0.05},
}
RATE_ON_MISS = {"location": 0.05, "device_type": 0.02, "card_type": 0.02}
MISSING_CATEGORY = {"location": "Unknown", "device_type": "unknown", "card_type": "unknown"}

DEVICE_CODES = {"mobile": 0, "desktop": 1, "tablet": 2, "unknown": 3}

NUMERIC_FEATURES = [
    "amount", "hour_of_day", "day_of_week", "month", "day_of_month", "is_weekend", "is_night",
    "is_vpn", "user_transaction_count", "user_avg_amount", "user_amount_std", "amount_zscore",
    "amount_to_max_ratio", "location_fraud_rate", "device_fraud_rate", "card_fraud_rate",
    "is_unusual_amount", "is_new_user", "is_largest_tx",
]
EXTRA_FEATURES = ["user_min_amount", "user_max_amount", "user_vpn_ratio"]
RATE_FEATURES = {
    "location": "location_fraud_rate",
    "device_type": "device_fraud_rate",
    "card_type": "card_fraud_rate",
}
CATEGORICAL = ["device_type", "card_type", "status", "location"]
LABEL = "is_fraud"

MODEL_WIDTH = 38
TTL_SECONDS = 30 * 24 * 60 * 60
THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]

# Texts of alerts and batch summaries.
ALERT_SUBJECT = "FRAUD ALERT: Transaction "
RISK_FACTOR_AMOUNT = "Amount: $%.2f"
RISK_FACTOR_LABELS = {
    "location": "Location: ", "device_type": "Device: ", "is_vpn": "VPN: ", "card_type": "Card Type: ",
}
SUMMARY_TEXT = "Processed %d transactions, detected %d fraudulent transactions"

# --- schemas ---------------------------------------------------------------

TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("is_vpn", T.BooleanType()),
    T.StructField("card_type", T.StringType()),
    T.StructField("status", T.StringType()),
])

HISTORY = T.StructType(TRANSACTION.fields + [T.StructField(LABEL, T.BooleanType())])

# As it comes over the wire: the amount may be numeric text.
WIRE_TRANSACTION = T.StructType([
    T.StructField(f.name, T.StringType() if f.name == "amount" else f.dataType)
    for f in TRANSACTION.fields
])

ENVELOPE = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("kinesis", T.StructType([T.StructField("data", T.StringType())])),
    ]))),
    T.StructField("transaction", T.StringType()),  # its JSON text, read like any other record
])

USER_STATS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("user_transaction_count", T.LongType()),
    T.StructField("user_avg_amount", T.DoubleType()),
    T.StructField("user_amount_std", T.DoubleType()),
    T.StructField("user_min_amount", T.DoubleType()),
    T.StructField("user_max_amount", T.DoubleType()),
    T.StructField("user_vpn_ratio", T.DoubleType()),
])

USER_PARTIALS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("n_amount", T.LongType()),
    *[T.StructField(name, T.DecimalType(38, 0)) for name in ("high", "low", "high_high", "high_low", "low_low")],
    T.StructField("lowest", T.DoubleType()),
    T.StructField("highest", T.DoubleType()),
    T.StructField("n_vpn", T.LongType()),
    T.StructField("vpn", T.LongType()),
])

CATEGORY_RATE = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("rate", T.DoubleType()),
])

MANIFEST = T.StructType([
    T.StructField("feature_names", T.ArrayType(T.StringType())),
    T.StructField("categorical_features", T.ArrayType(T.StringType())),
    T.StructField("numeric_features", T.ArrayType(T.StringType())),
])
