"""Evaluation of scores as small tables.

Every input is one frame that carries label and score side by side, so nothing is
matched by position. A row without a label or a score takes no part in any of them;
``unscored`` counts such rows.
"""

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.session import local_table


def predicted(score: Column, threshold: float = 0.5, strict: bool = False) -> Column:
    """Batch scoring counts the threshold itself as fraud, the stream does not."""
    return score > F.lit(threshold) if strict else score >= F.lit(threshold)


def unscored(df: DataFrame, label: str = "is_fraud", score: str = "score") -> DataFrame:
    """How many rows the other tables leave out."""
    return df.agg(F.count_if(F.col(label).isNull() | F.col(score).isNull()).alias("unscored"))


def ratio(part: Column, whole: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def confusion(df: DataFrame, label: str = "is_fraud", flagged: str = "flagged") -> DataFrame:
    """One row (tn, fp, fn, tp) from one pass with partial sums."""
    y, f = F.col(label), F.col(flagged)
    cell = lambda cond: F.coalesce(F.count_if(cond), F.lit(0)).cast("long")
    return df.agg(
        cell(~y & ~f).alias("tn"), cell(~y & f).alias("fp"), cell(y & ~f).alias("fn"), cell(y & f).alias("tp")
    )


def business(cm: DataFrame) -> DataFrame:
    return cm.select(
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("detection_rate"),
        ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("false_alarm_rate"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.col("tp").alias("fraud_cases_detected"),
        F.col("fn").alias("fraud_cases_missed"),
        F.col("fp").alias("false_alarms"),
    )


def positive_rates(cm: DataFrame) -> DataFrame:
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return cm.select(
        total.alias("test_size"),
        ratio(F.col("fp") + F.col("tp"), total).alias("positive_rate"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("true_positive_rate"),
    )


def report(cm: DataFrame) -> DataFrame:
    """Per-class report in long form (label, metric, value)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp

    def of_class(hit, missed, wrong):
        p, r = ratio(hit, hit + wrong), ratio(hit, hit + missed)
        # 2tp / (2tp + fp + fn): the same as 2pr / (p + r), but 0 only when hit is
        return {"precision": p, "recall": r, "f1-score": ratio(2 * hit, 2 * hit + missed + wrong),
                "support": (hit + missed).cast("double")}

    classes = {"0": of_class(tn, fp, fn), "1": of_class(tp, fn, fp)}
    share = {"0": tn + fp, "1": fn + tp}
    lines = [(k, m, v) for k, metrics in classes.items() for m, v in metrics.items()]
    lines.append(("accuracy", "accuracy", ratio(tn + tp, total)))
    for metric in ("precision", "recall", "f1-score"):
        a, b = classes["0"][metric], classes["1"][metric]
        lines.append(("macro avg", metric, (a + b) / 2))
        lines.append(("weighted avg", metric, ratio(a * share["0"] + b * share["1"], total)))
    lines += [(k, "support", total.cast("double")) for k in ("macro avg", "weighted avg")]
    cells = [F.struct(F.lit(k).alias("label"), F.lit(m).alias("metric"), v.alias("value")) for k, m, v in lines]
    return cm.select(F.inline(F.array(*cells)))


def threshold_sweep(
    df: DataFrame, label: str = "is_fraud", score: str = "score", thresholds: list[float] = S.THRESHOLDS
) -> DataFrame:
    """Counts and rates at each threshold.

    Rows are counted once, by how many thresholds they reach; the sweep is a
    running total over those few counts, however many thresholds there are.
    """
    steps = sorted(thresholds)
    df = df.filter(F.col(score).isNotNull())
    reached = sum((F.coalesce(F.col(score) >= F.lit(t), F.lit(False)).cast("int") for t in steps), F.lit(0))
    bands = df.groupBy(reached.alias("_band")).agg(
        F.count_if(F.col(label)).alias("_pos"), F.count_if(~F.col(label)).alias("_neg")
    )
    wanted = [F.struct(F.lit(i + 1).alias("step"), F.lit(t).alias("threshold")) for i, t in enumerate(steps)]
    above = lambda c: F.coalesce(F.sum(F.when(F.col("_band") >= F.col("step"), F.col(c))), F.lit(0)).cast("long")
    below = lambda c: F.coalesce(F.sum(F.when(F.col("_band") < F.col("step"), F.col(c))), F.lit(0)).cast("long")
    counts = (
        bands.select("*", F.inline(F.array(*wanted)))
        .groupBy("threshold")
        .agg(
            above("_pos").alias("true_positives"), below("_pos").alias("false_negatives"),
            above("_neg").alias("false_positives"), below("_neg").alias("true_negatives"),
        )
    )
    tp, fn = F.col("true_positives"), F.col("false_negatives")
    fp, tn = F.col("false_positives"), F.col("true_negatives")
    return counts.select(
        "threshold",
        ratio(tp, tp + fn).alias("detection_rate"),
        ratio(fp, fp + tn).alias("false_alarm_rate"),
        ratio(tp, tp + fp).alias("precision"),
        "true_positives", "false_negatives", "false_positives", "true_negatives",
    )


def recommended_threshold(sweep: DataFrame, least_detection: float = 0.8) -> DataFrame:
    """Fewest false alarms among thresholds that detect enough; no row if none does."""
    return (
        sweep.filter(F.col("detection_rate") >= F.lit(least_detection))
        .orderBy("false_alarm_rate", "threshold")
        .limit(1)
    )


# --- ROC -------------------------------------------------------------------
#
# The curve needs totals over all rows with a higher score. Rows are first counted
# per distinct score, so ties and hot scores shrink to one row. Distinct scores can
# still be as many as rows, so they are cut into score slices of about equal size;
# running totals are taken inside each slice and start from the totals of the
# slices above. There are as many slices as the rows need; their borders come from approximate quantiles, which only
# decides how even the slices are: the totals are exact.


SLICE_ROWS = 1_000_000


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    slices = -(-df.agg(F.count(score)).first()[0] // SLICE_ROWS)
    at = [i / slices for i in range(1, slices)]
    borders = sorted({*df.agg(F.percentile_approx(score, at, 4 * slices)).first()[0]}) if at else []
    counted = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg")
    )
    if not borders:
        return counted.withColumn("slice", F.lit(0.0))
    cut = Bucketizer(
        splits=[float("-inf"), *borders, float("inf")], inputCol="score", outputCol="slice", handleInvalid="keep"
    )
    return cut.transform(counted)


def _cumulated(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: own counts, totals at or above it, and the next lower score's counts."""
    counted = _by_score(df, label, score)
    first = F.max_by(F.struct("pos", "neg"), "score")
    above = Window.orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.orderBy(F.desc("slice"))
    every = Window.partitionBy()
    # at most one row per slice: the windows over these rows are small
    starts = counted.groupBy("slice").agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"), first.alias("f")
    ).select(
        "slice",
        F.coalesce(F.sum("p").over(above), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("neg_above"),
        F.lead("f").over(below).alias("next_slice"),
        F.sum("p").over(every).alias("all_pos"),
        F.sum("n").over(every).alias("all_neg"),
    )
    inside = Window.partitionBy("slice").orderBy(F.desc("score"))
    up_to = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.join(F.broadcast(starts), "slice").select(
        "score", "pos", "neg", "all_pos", "all_neg",
        (F.sum("pos").over(up_to) + F.col("pos_above")).alias("tps"),
        (F.sum("neg").over(up_to) + F.col("neg_above")).alias("fps"),
        F.coalesce(F.lead(F.struct("pos", "neg")).over(inside), F.col("next_slice")).alias("next"),
        (F.row_number().over(inside) == 1).alias("_first_in_slice"),
        (F.col("pos_above") + F.col("neg_above") == 0).alias("_top_slice"),
    )


def roc_auc(df: DataFrame, label: str = "is_fraud", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, a tie counts half. Null without both classes."""
    wide = "decimal(19,0)"
    # Twice the pairs in wrong order less the ties, in whole numbers: of all
    # 2 * P * N half pairs a positive loses two to each negative above it.
    lost = F.col("pos").cast(wide) * (2 * F.col("fps") - F.col("neg")).cast(wide)
    p, n = F.col("positives").cast("double"), F.col("negatives").cast("double")
    return (
        _cumulated(df, label, score)
        .agg(F.sum(lost).alias("lost"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
        .select(
            F.when((p > 0) & (n > 0), 1 - F.col("lost").cast("double") / 2 / (p * n)).alias("roc_auc"),
            "positives", "negatives",
        )
    )


def roc_points(df: DataFrame, label: str = "is_fraud", score: str = "score", thin: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score from (0, 0); points on a straight line left out."""
    points = _cumulated(df, label, score)
    if thin:
        corner = (F.col("next.pos") != F.col("pos")) | (F.col("next.neg") != F.col("neg"))
        points = points.filter(
            F.col("next").isNull() | corner | (F.col("_first_in_slice") & F.col("_top_slice"))
        )
    share = lambda c, whole: F.when(F.col(whole) > 0, F.col(c) / F.col(whole))
    curve = points.select(
        F.col("score").alias("threshold"),
        share("fps", "all_neg").alias("fpr"),
        share("tps", "all_pos").alias("tpr"),
    )
    names = ("threshold", "fpr", "tpr")
    origin = local_table(df.sparkSession, [(float("inf"), 0.0, 0.0)], pa.schema([(n, pa.float64()) for n in names]))
    return origin.unionByName(curve)


def first_per_class(
    df: DataFrame, label: str = "is_fraud", n: int = 5, order: str = "transaction_id"
) -> DataFrame:
    """First rows of each class; Spark keeps ``n`` per task before it shuffles."""
    place = F.row_number().over(Window.partitionBy(label).orderBy(order))
    return df.withColumn("place", place).filter(F.col("place") <= n)
