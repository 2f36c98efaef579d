"""Feature frames: one for training (batch), one for live records (extractor)."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.functions import amounts, clock
from tallyward.operators import columns, encode, rates, stats

_USER_COLUMNS = [f.name for f in S.USER_STATS.fields if f.name != "user_id"]


def behaviour(df: DataFrame, user_stats: DataFrame | None = None) -> DataFrame:
    """User statistics joined back, and the features that compare a row with them."""
    joined = stats.with_user_stats(df, user_stats)
    amount, avg = F.col("amount"), F.col("user_avg_amount")
    std, top = F.col("user_amount_std"), F.col("user_max_amount")
    return joined.withColumns({
        "amount_zscore": amounts.zscore(amount, avg, std),
        "amount_to_max_ratio": amounts.max_ratio(amount, top),
        "is_unusual_amount": amounts.unusual(amount, avg, std),
        "is_new_user": amounts.new_user(F.col("user_transaction_count")),
        "is_largest_tx": amounts.largest(amount, top),
    })


@dataclass
class Fitted:
    """What has to be learned from labelled rows before features can be made."""

    rates: rates.Rates
    vocabulary: dict[str, list[str]]


def fit(df: DataFrame, most_values: int = encode.MAX_VALUES) -> Fitted:
    """Rates and vocabulary in one pass. Fit on all rows, or on train rows only to keep
    test labels out of the rates. A category of more than ``most_values`` values is refused."""
    fitted = rates.fit(df)
    vocabulary = fitted.seen if fitted.small else encode.vocabulary(df, limit=most_values)
    encode.check_width(vocabulary, most_values)
    return Fitted(fitted, {c: vocabulary[c] for c in S.CATEGORICAL})


def fit_folds(df: DataFrame, among: Column, most_values: int = encode.MAX_VALUES) -> Fitted:
    """The same with rates that leave out the fold of each row; only rows ``among`` those given teach."""
    fitted = rates.fit_folds(df, among=among)
    vocabulary = fitted.seen if fitted.small else encode.vocabulary(df.filter(among), limit=most_values)
    encode.check_width(vocabulary, most_values)
    return Fitted(fitted, {c: vocabulary[c] for c in S.CATEGORICAL})


def batch(df: DataFrame, fitted: Fitted | None = None, user_stats: DataFrame | None = None) -> DataFrame:
    """The training frame: calendar, behaviour, rates and one-hot columns.

    Shuffles: one for the statistics, one for the join back. Rates are looked up
    from a checked small table, everything else is projection.
    """
    fitted = fit(df) if fitted is None else fitted
    out = df.withColumns(clock.calendar(F.col("ts")))
    out = behaviour(out, user_stats)
    out = rates.encode(out, fitted.rates)
    out = encode.one_hot(out, fitted.vocabulary)
    return out.withColumn("is_vpn", F.col("is_vpn").cast("int"))


def model_frame(df: DataFrame) -> DataFrame:
    """Id, label and model inputs in manifest order."""
    return df.select("transaction_id", S.LABEL, *columns.model_columns(df))


# fixed values: what a user without statistics looks like
_NO_STATS = {
    "user_transaction_count": 1, "user_avg_amount": 0.0, "user_amount_std": 1.0, "user_min_amount": 0.0,
    "user_max_amount": 0.0, "user_vpn_ratio": 0.0, "amount_zscore": 0.0, "amount_to_max_ratio": 1.0,
    "is_unusual_amount": 0, "is_new_user": 1, "is_largest_tx": 1,
}


def extractor(df: DataFrame, user_stats: DataFrame, fitted_rates: rates.Rates | None = None,
              names: list[str] | None = None) -> DataFrame:
    """Features of live records from earlier statistics, with a default for everything.

    ``names`` (a model's manifest) says which one-hot columns there are; without it they are those of the fixed
    vocabulary.

    ``ts`` may be null where the time could not be read.
    """
    if fitted_rates is None:
        fitted_rates = rates.defaults(df.sparkSession)
    marked = user_stats.withColumn("_known", F.lit(True))
    joined = stats.attach(df, marked, "user_id")
    known = F.col("_known").isNotNull()
    amount = F.coalesce("amount", F.lit(0.0))
    avg, std, top = (
        F.coalesce(F.col(c), F.lit(d))
        for c, d in (("user_avg_amount", 0.0), ("user_amount_std", 1.0), ("user_max_amount", 0.0))
    )
    count = F.coalesce("user_transaction_count", F.lit(1))
    made = {
        "user_transaction_count": count, "user_avg_amount": avg, "user_amount_std": std,
        "user_min_amount": F.coalesce("user_min_amount", F.lit(0.0)), "user_max_amount": top,
        "user_vpn_ratio": F.coalesce("user_vpn_ratio", F.lit(0.0)),
        "amount_zscore": amounts.zscore(amount, avg, std, "extractor"),
        "amount_to_max_ratio": amounts.max_ratio(amount, top, "extractor"),
        "is_unusual_amount": amounts.unusual(amount, avg, std, "extractor"),
        "is_new_user": amounts.new_user(count),
        "is_largest_tx": amounts.largest(amount, top),
    }
    out = joined.withColumns({
        "amount": amount,
        **clock.calendar_or_default(F.col("ts")),
        **{n: F.when(known, e).otherwise(F.lit(_NO_STATS[n])) for n, e in made.items()},
    }).drop("_known")
    out = rates.encode_or_default(out, fitted_rates)
    out = out.withColumns({
        "status": F.coalesce("status", F.lit("approved")),
        "location": F.coalesce("location", F.lit(S.MISSING_CATEGORY["location"])),
    })
    out = encode.one_hot(out, encode.SERVED, keep_source=True) if names is None else encode.one_hot_named(out, names)
    return out.withColumn("is_vpn", amounts.flag(F.col("is_vpn")))
