"""Gradient-boosted trees: fit, search, score, evaluate."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import schemas as S
from tallyward.operators import columns, evaluate, scoring, split
from tallyward.plans import features
from tallyward.session import ensure_checkpoints, local_table, new_folder

POSITIVE_WEIGHT = 10.0
ROUNDS = 100
PATIENCE = 10
# Rows of a part of the matrix in a fit: a part is one task of every level of every tree.
LEAST_PART, MOST_PART = 10_000, 1_000_000


@dataclass
class Parameters:
    """One setting of the trees, under the names Spark uses."""

    maxDepth: int = 7
    stepSize: float = 0.1
    minInfoGain: float = 0.0
    minInstancesPerNode: int = 1
    subsamplingRate: float = 0.8
    featureSubsetStrategy: str = "auto"
    maxIter: int = ROUNDS

    def as_dict(self) -> dict[str, object]:
        return dict(self.__dict__)


@dataclass
class Trial:
    number: int
    parameters: Parameters
    auc: float
    model: PipelineModel = field(repr=False)

    @property
    def rounds(self) -> int:
        return self.model.stages[-1].getNumTrees


# what is searched: the six ranges, as a unit cube
RANGES = {
    "maxDepth": (3, 10), "stepSize": (0.01, 0.3), "minInfoGain": (0.0, 0.01), "minInstancesPerNode": (1, 10),
    "subsamplingRate": (0.5, 1.0), "featureSubsetStrategy": (0.5, 0.99),
}


def at_point(point: Sequence[float], rounds: int = ROUNDS) -> Parameters:
    """The setting at a point of the unit cube (gamma in Spark's own scale)."""
    values = [low + x * (high - low) for x, (low, high) in zip(point, RANGES.values(), strict=True)]
    depth, step, gain, least, share, features_ = values
    return Parameters(
        maxDepth=round(depth), stepSize=round(step, 4), minInfoGain=round(gain, 5), minInstancesPerNode=round(least),
        subsamplingRate=round(share, 3), featureSubsetStrategy=str(round(features_, 3)), maxIter=rounds,
    )


def propose(points: list, values: list[float], seed: int = 0, candidates: int = 16, width: float = 0.7) -> list[float]:
    """The next point to try: greatest expected improvement under a Gaussian process through the trials so far.

    A few numbers per trial: this runs where the search does. Half of the candidates lie near the best trial. They are few,
    as the improvement that is expected where nothing was tried is greatest in the corners. With some five trials the search
    is as good as chance, with more it is better.
    """
    rng = np.random.default_rng([seed, len(points)])
    if not points:
        return rng.random(len(RANGES)).tolist()
    x, y = np.array(points), np.array(values, float)
    spread = y.std() or 1.0
    y = (y - y.mean()) / spread
    near = np.clip(x[y.argmax()] + rng.normal(0, 0.1, (candidates // 2, x.shape[1])), 0, 1)
    tried = np.concatenate([rng.random((candidates - len(near), x.shape[1])), near])
    kernel = lambda a, b: np.exp(-((a[:, None, :] - b[None, :, :]) ** 2).sum(2) / (2 * width**2))
    solved = np.linalg.solve(kernel(x, x) + 1e-4 * np.eye(len(x)), np.column_stack([y, kernel(x, tried)]))
    mean = kernel(tried, x) @ solved[:, 0]
    deviation = np.sqrt(np.maximum(1e-12, 1 - (kernel(x, tried) * solved[:, 1:]).sum(0)))
    z = (mean - y.max()) / deviation
    normal = np.array([NormalDist().cdf(v) for v in z])
    gain = deviation * (z * normal + np.exp(-z * z / 2) / np.sqrt(2 * np.pi))
    return tried[gain.argmax()].tolist()


def search(judge: Callable[[list[list[float]]], list[float]], trials: int, parallel: int, seed: int = 42) -> tuple[list, list[float]]:
    """Points and their values, ``parallel`` at a time. The first are random; of the later ones each supposes that those
    tried beside it turn out as well as the worst so far, so that they differ."""
    points: list = []
    values: list[float] = []
    while len(points) < trials:
        now, supposed = [], list(values)
        for _ in range(min(parallel, trials - len(points))):
            enough = len(values) >= 2
            now.append(propose(points + now, supposed, seed) if enough else np.random.default_rng([seed, len(points) + len(now)]).random(len(RANGES)).tolist())
            supposed.append(min(values, default=0.0))
        values += judge(now)
        points += now
    return points, values


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: training reads it many times, and a
    lost executor then costs a re-read instead of the whole feature plan."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def weighted(df: DataFrame) -> DataFrame:
    """Double label and the row weight that makes up for rare frauds."""
    y = F.col(S.LABEL).cast("double")
    return df.withColumns({"label": y, "weight": F.when(y == 1, POSITIVE_WEIGHT).otherwise(1.0)})


def complete(df: DataFrame, names: list[str]) -> DataFrame:
    """Missing numbers are 0 for the model."""
    return df.fillna(0, subset=names)


def estimator(names: list[str], parameters: Parameters, seed: int = 42) -> Pipeline:
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", lossType="logistic", seed=seed, **parameters.as_dict(),
    )
    return Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), trees])


def prepare(df: DataFrame, fit_on: str = "all", seed: int = 42) -> tuple[DataFrame, list[str], features.Fitted]:
    """Labelled rows to a written matrix with ``split`` = train / validation / test.

    ``fit_on="all"`` learns rates on every row; ``"train"`` keeps test labels out; ``"folds"`` does so as well and keeps
    a row's own label out of its rates too.
    """
    parted = split.three_way_split(df, seed=seed)
    if fit_on == "train":
        fitted = features.fit(parted.filter(F.col("split") != "test"))
    elif fit_on == "folds":
        fitted = features.fit_folds(parted, F.col("split") != "test")
    elif fit_on == "all":
        fitted = features.fit(df)
    else:
        raise ValueError(f"unknown fit_on: {fit_on}")
    frame = features.batch(parted, fitted)
    names = columns.model_columns(frame)
    matrix = complete(frame.select("transaction_id", "split", S.LABEL, *names), names)
    return written(matrix, "matrix"), names, fitted


def parts_for(rows: int, cores: int) -> int:
    """Even parts for the cores: one each, more where they would be large, fewer where they would be tiny."""
    fewest = -(-rows // LEAST_PART)
    return max(1, fewest) if fewest < cores else cores * -(-rows // (cores * MOST_PART))


def _for_fit(matrix: DataFrame, fits: int = 1) -> DataFrame:
    """Rows to fit on and to validate by, dealt evenly: the written files are few and uneven, and every level of every
    tree waits for its largest part. ``fits`` at a time get a share of the cores each, so that none waits for another's tasks."""
    kept = matrix.filter(F.col("split") != "test")
    cores = max(1, matrix.sparkSession.sparkContext.defaultParallelism // fits)
    return weighted(kept).withColumn("is_validation", F.col("split") == "validation").repartition(parts_for(kept.count(), cores))


def _vectors(matrix: DataFrame, names: list[str], fits: int = 1) -> tuple[DataFrame, DataFrame]:
    """The rows to fit on and those to validate by, as vectors and checkpointed: a fit reads its rows several times, and every
    task of every level carries the plan behind them."""
    rows = _for_fit(matrix, fits)
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    return tuple(
        assembler.transform(rows.filter(which)).select("label", "weight", "features").checkpoint()
        for which in (~F.col("is_validation"), F.col("is_validation"))
    )


def patient_rounds(losses: list[float], patience: int) -> int:
    """Rounds up to the best one before ``patience`` rounds in a row brought no lower validation loss."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_trees(model: PipelineModel, rounds: int) -> PipelineModel:
    """The model as it was after so many rounds: its first trees with their weights, every setting kept."""
    trees = model.stages[-1]
    if rounds >= trees.getNumTrees:
        return model
    grown, jvm = trees._java_obj.trees(), SparkContext._gateway.jvm
    kept = JavaWrapper._new_java_array(
        [grown[i] for i in range(rounds)], jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel)
    weights = JavaWrapper._new_java_array([float(w) for w in trees.treeWeights[:rounds]], jvm.double)
    made = JavaWrapper._new_java_obj("org.apache.spark.ml.classification.GBTClassificationModel", trees.uid, kept, weights)
    return PipelineModel([*model.stages[:-1], trees._copyValues(GBTClassificationModel(made))])


def _fit_patiently(
    rows: DataFrame, held_out: DataFrame, names: list[str], parameters: Parameters, seed: int, patience: int
) -> PipelineModel:
    assembler, trees = estimator(names, parameters, seed).getStages()
    whole = PipelineModel([assembler, trees.fit(rows)])
    if held_out.isEmpty():
        return whole
    return first_trees(whole, patient_rounds(whole.stages[-1].evaluateEachIteration(held_out), patience))


def train(
    matrix: DataFrame, names: list[str], parameters: Parameters | None = None, seed: int = 42, patience: int = PATIENCE
) -> PipelineModel:
    """One fit, cut back to its best round before ``patience`` rounds without a lower validation loss.

    All rounds are grown once; one pass over the validation rows gives the loss after each of them. Without validation
    rows every round stays.
    """
    ensure_checkpoints(matrix.sparkSession)
    return _fit_patiently(*_vectors(matrix, names), names, parameters or Parameters(), seed, patience)


def tune(
    matrix: DataFrame, names: list[str], trials: int = 5, parallel: int = 2, seed: int = 42, rounds: int = ROUNDS,
    patience: int = PATIENCE,
) -> list[Trial]:
    """Search that learns from its trials, best exact validation AUC first; ``parallel`` fits share the cluster."""
    ensure_checkpoints(matrix.sparkSession)
    held_out = matrix.filter(F.col("split") == "validation")
    dealt: dict[int, tuple[DataFrame, DataFrame]] = {}  # by how many fits there are at a time
    done: list[Trial] = []

    def run(point: list[float], vectors: tuple[DataFrame, DataFrame]) -> tuple[Parameters, float, PipelineModel]:
        parameters = at_point(point, rounds)
        model = _fit_patiently(*vectors, names, parameters, seed, patience)
        found = evaluate.roc_auc(score(model, held_out, names)).first().roc_auc  # the exact area, as the tables have it
        return parameters, 0.0 if found is None else found, model

    with ThreadPool(parallel) as pool:
        def judge(points: list[list[float]]) -> list[float]:
            fits = len(points)
            if fits not in dealt:
                dealt[fits] = _vectors(matrix, names, fits)
            for parameters, auc, model in pool.starmap(run, [(p, dealt[fits]) for p in points]):
                done.append(Trial(len(done) + 1, parameters, auc, model))
            return [t.auc for t in done[-len(points):]]

        search(judge, trials, parallel, seed)
    return sorted(done, key=lambda t: (-t.auc, t.number))


def trial_table(spark: SparkSession, trials: list[Trial]) -> DataFrame:
    rows = [
        (t.number, float(t.auc), i == 0, t.rounds, {k: str(v) for k, v in t.parameters.as_dict().items()})
        for i, t in enumerate(trials)
    ]
    return spark.createDataFrame(rows, "trial int, auc double, best boolean, rounds int, parameters map<string,string>")


def score(model: PipelineModel, df: DataFrame, names: list[str], threshold: float = 0.5) -> DataFrame:
    """Probability and flag (threshold included) for a table; a failed score counts as 0.5 and has its ``error``."""
    scored = scoring.with_model_score(complete(df, names), model, "_probability")
    return scored.withColumns({
        "score": F.coalesce("_probability", F.lit(0.5)),
        "error": F.when(F.col("_probability").isNull(), F.lit(scoring.MODEL_FAILED)),
    }).withColumn("flagged", evaluate.predicted(F.col("score"), threshold)).drop("_probability")


def metrics(scored: DataFrame) -> DataFrame:
    """(metric, value) rows: AUC, business rates and positive rates of scored rows.

    The rows are read many times, so what the tables need of them is written once; the metrics, one row each, are part of
    the plan then.
    """
    spark = scored.sparkSession
    scored = written(scored.select(S.LABEL, "score", "flagged", "error"), "scored")
    cm = evaluate.confusion(scored)
    tables = [
        evaluate.roc_auc(scored).select("roc_auc"), evaluate.business(cm), evaluate.positive_rates(cm), evaluate.unscored(scored),
        scored.agg(F.count("error").alias("failed_scores")),
    ]
    parts = [
        t.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in t.columns
        ])))
        for t in tables
    ]
    rows = [(r.metric, r.value) for r in reduce(DataFrame.unionByName, parts).collect()]
    return local_table(spark, rows, pa.schema([("metric", pa.string()), ("value", pa.float64())]))
