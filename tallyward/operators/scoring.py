"""Score columns: rules, a fitted model, and what to do without one."""

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.amounts import rule_score
from tallyward.operators import rates

MODEL_FAILED = "model not available"


def with_rule_score(df: DataFrame, out: str = "risk_score") -> DataFrame:
    """Fixed location lookup, then the weighted rule score."""
    return rates.with_location_risk(df).withColumn(
        out, rule_score(F.col("amount"), F.col("is_vpn"), F.col("location_risk"), F.col("status"))
    )


def with_model_score(df: DataFrame, model: PipelineModel, out: str = "fraud_probability") -> DataFrame:
    """Probability of fraud from a fitted pipeline; works on tables and on streams."""
    work = [c for c in ("features", "rawPrediction", "probability", "prediction")]
    return model.transform(df).withColumn(out, vector_to_array("probability")[1]).drop(*work)


def decide(
    df: DataFrame, probability: str | Column, rule: str = "risk_score", threshold: float = 0.5,
    strict: bool = True, fallback: str = "rule",
) -> DataFrame:
    """Adds ``fraud_probability``, flag ``is_fraud`` and ``error``.

    Where the model gave no probability the row is still decided: by the rule score
    with a bar of 0.7 (``rule``), or as undecided 0.5 / not flagged (``shipped``), or
    as 0.5 against the usual threshold (``half``, the batch meaning).
    """
    p = F.col(probability) if isinstance(probability, str) else probability
    p = p.cast("double")
    bar = (p > F.lit(threshold)) if strict else (p >= F.lit(threshold))
    if fallback == "rule":
        other, flagged = F.col(rule), F.col(rule) > F.lit(0.7)
    elif fallback == "shipped":
        other, flagged = F.lit(0.5), F.lit(False)
    elif fallback == "half":
        other = F.lit(0.5)
        flagged = F.lit(0.5 > threshold if strict else 0.5 >= threshold)
    else:
        raise ValueError(f"unknown fallback: {fallback}")
    return df.withColumns({
        "fraud_probability": F.coalesce(p, other),
        "is_fraud": F.when(p.isNull(), flagged).otherwise(bar),
        "error": F.when(p.isNull(), F.lit(MODEL_FAILED)),
    })
