"""The whole batch job: history in; model, fitted side tables and evaluation out.

    spark-submit -m tallyward.plans.batch_job <history file or folder> <output folder>

History is an array document or JSON lines; it is landed as Parquet once, and the job works on that.
"""

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.operators import columns, evaluate, rates, stats
from tallyward.plans import training
from tallyward.sources import history, side_files


def run(
    df: DataFrame, out: str, trials: int = 5, parallel: int = 2, rounds: int = training.ROUNDS,
    fit_on: str = "all", seed: int = 42, name: str = "fraud-trees",
) -> dict[str, float | None]:
    """Train on labelled rows and write below ``out``:

    ``model``, ``manifest``, ``metadata``, ``rates``, ``user_stats``, ``user_partials`` for scoring, and
    ``trials``, ``metrics``, ``confusion``, ``report``, ``thresholds``, ``recommended``,
    ``roc`` about the test rows. Gives the headline metrics.
    """
    spark = df.sparkSession
    columns.require(df, [S.LABEL, "transaction_id", "user_id", "ts", "amount"])
    matrix, names, fitted = training.prepare(df, fit_on, seed)
    found = training.tune(matrix, names, trials, parallel, seed, rounds)
    best = found[0]
    best.model.write().overwrite().save(f"{out}/model")

    made = columns.manifest_of(names)
    side_files.write_small(side_files.manifest_row(spark, made), f"{out}/manifest")
    side_files.write_small(
        side_files.metadata_row(spark, name, f"trial-{best.number}", best.parameters.as_dict(), made, time.time()),
        f"{out}/metadata",
    )
    side_files.write_rates(rates.served(fitted.rates), f"{out}/rates")
    side_files.write_user_partials(stats.partials(df), f"{out}/user_partials")
    sums = side_files.read_user_partials(spark, f"{out}/user_partials")
    side_files.write_user_stats(stats.finish(sums), f"{out}/user_stats")
    side_files.write_small(training.trial_table(spark, found), f"{out}/trials")

    # The scored test rows are read by every evaluation table.
    scored = training.written(
        training.score(best.model, matrix.filter(F.col("split") == "test"), names)
        .select("transaction_id", S.LABEL, "score", "flagged", "error"), "scored",
    )
    cm = evaluate.confusion(scored)
    sweep = evaluate.threshold_sweep(scored)
    metrics = training.metrics(scored)
    for table, folder in (
        (metrics, "metrics"), (cm, "confusion"), (evaluate.report(cm), "report"), (sweep, "thresholds"),
        (evaluate.recommended_threshold(sweep), "recommended"),
    ):
        side_files.write_small(table, f"{out}/{folder}")
    evaluate.roc_points(scored).write.mode("overwrite").parquet(f"{out}/roc")
    return {r.metric: r.value for r in spark.read.json(f"{out}/metrics").collect()}


def main() -> None:
    source, out = sys.argv[1:3]
    spark = SparkSession.builder.appName("tallyward-batch").getOrCreate()
    print(run(history.ingest(spark, source, out), out))


if __name__ == "__main__":
    main()
