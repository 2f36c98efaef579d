"""Scoring of transactions, the same code for a table and for a micro-batch."""

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.functions import clock
from tallyward.operators import columns, rates, scoring, store
from tallyward.plans import features


@dataclass
class Scorer:
    """What scoring needs: earlier statistics, rates, and a model if there is one.

    Without a model (or where it gives nothing) rows are decided by ``fallback``.
    """

    rates: rates.Rates
    model: PipelineModel | None = None
    names: list[str] = field(default_factory=list)
    fallback: str = "rule"
    threshold: float = 0.5

    def score(
        self, transactions: DataFrame, user_stats: DataFrame, now: Column | None = None,
    ) -> DataFrame:
        """Stored form of each transaction: its fields, the prediction and the features."""
        fields = [f.name for f in S.TRANSACTION.fields]
        given = transactions.select(*fields, F.struct(*fields).alias("_given")).withColumn(
            "ts", clock.parse_strict(F.col("timestamp"))
        )
        ruled = scoring.with_rule_score(given)
        made = features.extractor(ruled, user_stats, self.rates, names=self.names)
        # a feature that the manifest names and nothing here gives is 0
        made = made.withColumns({n: F.lit(0) for n in columns.available(self.names, made)[1]})
        if self.model is None:
            probability = F.lit(None).cast("double")
        else:
            made = scoring.with_model_score(made.fillna(0, subset=self.names), self.model, "_probability")
            probability = F.col("_probability")
        decided = scoring.decide(made, probability, threshold=self.threshold, fallback=self.fallback)
        shown = self.names or [*S.NUMERIC_FEATURES, "location_risk", "risk_score"]
        return store.stored_form(
            decided.select(
                "_given.*", "fraud_probability", "is_fraud", "error", F.struct(*shown).alias("feature_values")
            ),
            now,
        )
