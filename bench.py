"""Times the headline queries and prints one JSON line.

Each query runs once untimed to load classes, then once timed, every row and column
worked out and thrown away.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyward import session  # noqa: E402
from tallyward.plans import queries as q  # noqa: E402
from tallyward.plans import training  # noqa: E402

HEADLINE = [
    q.user_stats, q.feat_user_behavior, q.category_fraud_rates, q.rate_encoded, q.feature_frame,
    q.extractor_features, q.rule_risk_score, q.running_user_profile, q.roc_auc, q.roc_points, q.threshold_sweep,
    q.classification_report, q.correlation_with_label, q.stratified_split, q.validation_split, q.class_ratio_sample,
    q.latest_by_key, q.upserted, q.decode_reject, q.round_trip_summary, q.stream_scored, q.gbt_scored,
]


def trained(spark, folder):
    """A whole training, with its features and splits."""
    matrix, names, _ = training.prepare(q.tx(spark, folder))
    training.train(matrix, names, training.Parameters(maxIter=20))
    return matrix.limit(1)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build("bench", cpus=cpus)
    times = {}
    for query in [*HEADLINE, trained]:
        for timed in (False, True):
            started = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            if timed:
                times[query.__name__] = round(time.perf_counter() - started, 3)
    total = round(sum(times.values()), 3)
    name = Path(folder).name
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
        "sf": float(name[2:]) if name.startswith("sf") else name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
