import random
import threading

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallyward.operators import rates, stats
from tallyward.plans import batch_job
from tallyward.plans import queries as q
from tallyward.plans import training
from tallyward.session import new_folder
from tallyward.sources import history, side_files
from tallyward.streaming import scoring_stream
from tallyward.streaming.scorer import Scorer


@pytest.fixture(scope="module")
def fitted(spark, data):
    matrix, names, _ = training.prepare(q.tx(spark, data))
    model = training.train(matrix, names, training.Parameters(maxDepth=4, maxIter=8))
    return matrix, names, model


def test_parts(fitted):
    matrix, names, _ = fitted
    assert {r.split: r["count"] for r in matrix.groupBy("split").count().collect()} == {
        "test": 200, "validation": 160, "train": 640
    }
    assert len(names) == 39  # 38 and one place that is in no list
    assert matrix.select(names).na.drop().count() == 1000


def test_good_enough(fitted):
    matrix, names, model = fitted
    scored = training.score(model, matrix.filter("split = 'test'"), names)
    got = {r.metric: r.value for r in training.metrics(scored).collect()}
    assert got["roc_auc"] > 0.9 and got["test_size"] == 200
    assert scored.filter(~((F.col("score") >= 0) & (F.col("score") <= 1))).count() == 0


def test_failed_scores_are_told(spark, fitted):
    matrix, names, model = fitted
    rows = training.score(model, matrix.filter("split = 'test'"), names)
    failed = rows.withColumn("error", F.when(F.col("is_fraud"), "model not available"))
    got = {r.metric: r.value for r in training.metrics(failed).collect()}
    assert got["failed_scores"] == failed.filter("is_fraud").count() and got["unscored"] == 0
    assert rows.filter("error is not null").count() == 0


def test_saved_model_scores_the_same(spark, fitted):
    matrix, names, model = fitted
    path = new_folder(spark, "model")
    model.write().save(path)
    again = PipelineModel.load(path)
    a = {r.transaction_id: r.score for r in training.score(model, matrix, names).collect()}
    assert a == {r.transaction_id: r.score for r in training.score(again, matrix, names).collect()}


def test_search_puts_the_best_first(spark, fitted):
    matrix, names, _ = fitted
    trials = training.tune(matrix, names, trials=2, rounds=3)
    assert len(trials) == 2 and trials[0].auc >= trials[1].auc
    table = training.trial_table(spark, trials).collect()
    assert [r.best for r in table] == [True, False]
    assert [r.rounds for r in table] == [t.model.stages[-1].getNumTrees for t in trials]


def test_parts_of_a_fit(spark, fitted, monkeypatch):
    """Even parts, whatever files the matrix is in: few files kept most cores idle."""
    assert [training.parts_for(n, 12) for n in (0, 640, 25_000, 384_000, 3_000_000, 13_000_000, 23_000_000)] == [1, 1, 3, 12, 12, 24, 24]
    matrix, _, _ = fitted
    monkeypatch.setattr(training, "LEAST_PART", 50)
    rows = training._for_fit(matrix.coalesce(1))
    sizes = rows.filter("NOT is_validation").rdd.glom().map(len).collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism and sum(sizes) == 640 and max(sizes) <= 1.1 * min(sizes)


def test_fits_at_a_time_share_the_cores(spark, fitted, monkeypatch):
    """Rows of a fit come from the shared folder, without the plan that made them, in parts for its share of the cores."""
    matrix, names, _ = fitted
    monkeypatch.setattr(training, "LEAST_PART", 50)
    for fits, parts in ((1, 8), (2, 4), (3, 2), (20, 1)):
        rows, held_out = training._vectors(matrix, names, fits)
        sizes = rows.rdd.glom().map(len).collect()
        assert len(sizes) == parts and sum(sizes) == 640 and max(sizes) <= 1.1 * min(sizes) and held_out.count() == 160
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Scan ExistingRDD" in plan and "FileScan" not in plan and "Exchange" not in plan
    settings = training.Parameters(maxDepth=4, maxIter=3)
    plain = training.estimator(names, settings).fit(training._for_fit(matrix, fits).filter("NOT is_validation"))
    made = training._fit_patiently(rows, held_out, names, settings, 42, 3)
    grown = lambda m: [t.toDebugString.split("\n", 1)[1] for t in m.stages[-1].trees]
    assert grown(made) == grown(plain)[:len(grown(made))]


def test_usual_fit_runs_beside_the_search(spark, data, monkeypatch):
    both, train, tune = threading.Barrier(2), training.train, training.tune

    def met(work):
        both.wait(120)
        return work()

    monkeypatch.setattr(q, "_MODELS", {})
    monkeypatch.setattr(q, "_MATRICES", {}, raising=False)
    monkeypatch.setattr(training, "train", lambda m, n: met(lambda: train(m, n, training.Parameters(maxDepth=2, maxIter=2))))
    monkeypatch.setattr(training, "tune", lambda m, n: met(lambda: tune(m, n, rounds=2)))
    got = q.tuning_trials(spark, data).first()
    assert got.trials == 5 and got.best_trials == 1 and all(got[2:]) and len(q._MODELS) == 1


def test_metrics_score_each_row_once(spark, fitted):
    matrix, names, model = fitted
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = matrix.filter("split = 'test'")
    scored = training.score(model, rows.mapInArrow(passed, rows.schema), names)
    made = training.metrics(scored)
    assert made.count() == made.distinct().count() == len(made.collect()) and seen.value == 200


def test_patience(fitted):
    assert training.patient_rounds([5, 4, 4.5, 4.2, 3, 6, 6, 6], 3) == 5
    assert training.patient_rounds([5, 4, 4.5, 4.2, 3], 2) == 2
    assert training.patient_rounds([3, 2, 1], 1) == 3


def test_one_fit_is_cut_back(spark, fitted):
    """What is left are the first trees of the whole fit: the same scores as a fit of so many rounds, also once saved."""
    matrix, names, _ = fitted
    settings = training.Parameters(maxDepth=7, stepSize=0.9, maxIter=12)
    whole = training.train(matrix, names, settings, patience=12)
    model = training.train(matrix, names, settings, patience=2)
    rows = training._for_fit(matrix)
    grown = training.estimator(names, settings).fit(rows.filter("NOT is_validation"))
    losses = grown.stages[-1].evaluateEachIteration(grown.stages[0].transform(rows.filter("is_validation")))
    rounds = training.patient_rounds(losses, 2)
    assert model.stages[-1].getNumTrees == rounds < 12 and whole.stages[-1].getNumTrees == training.patient_rounds(losses, 12)
    again = training.estimator(names, training.Parameters(maxDepth=7, stepSize=0.9, maxIter=rounds)).fit(rows.filter("NOT is_validation"))
    scores = lambda m: {r.transaction_id: r.score for r in training.score(m, matrix, names).collect()}
    assert scores(model) == scores(again)
    model.write().save(path := new_folder(spark, "cut"))
    assert scores(PipelineModel.load(path)) == scores(again)
    assert model.stages[-1].getMaxDepth() == 7 and model.stages[-1].getLabelCol() == "label"


def test_no_validation_rows(fitted):
    matrix, names, _ = fitted
    model = training.train(matrix.filter("split != 'validation'"), names, training.Parameters(maxDepth=2, maxIter=3))
    assert model.stages[-1].getNumTrees == 3


def test_search_is_repeatable_and_in_range():
    flat = lambda points: [0.0] * len(points)
    points, _ = training.search(flat, 6, 2)
    assert points == training.search(flat, 6, 2)[0] and len({tuple(p) for p in points}) == 6
    rng = random.Random(1)
    for point in [*points, [0.0] * 6, [1.0] * 6, *[[rng.random() for _ in range(6)] for _ in range(50)]]:
        p = training.at_point(point)
        assert 3 <= p.maxDepth <= 10 and 0.01 <= p.stepSize <= 0.3 and 0 <= p.minInfoGain <= 0.01
        assert 1 <= p.minInstancesPerNode <= 10 and 0.5 <= p.subsamplingRate <= 1 and 0.5 <= float(p.featureSubsetStrategy) <= 0.99


def test_search_is_not_worse_than_chance():
    """On smooth surfaces with one top, at an equal number of trials, over forty seeds (five vary too much)."""
    for trials in (8, 12, 16):
        learned, chance = [], []
        for seed in range(40):
            top = np.random.default_rng([77, seed]).random(6)
            surface = lambda points, top=top: [-float(((np.array(p) - top) ** 2).sum()) for p in points]
            learned.append(max(training.search(surface, trials, 2, seed)[1]))
            chance.append(max(surface(np.random.default_rng([5, seed]).random((trials, 6)))))
        assert sum(learned) > sum(chance)



def test_fit_on_train_only(spark, data):
    with pytest.raises(ValueError, match="fit_on"):
        training.prepare(q.tx(spark, data), fit_on="some")
    matrix, _, _ = training.prepare(q.tx(spark, data), fit_on="train")
    assert matrix.count() == 1000


def test_model_in_the_stream(spark, data, tx, fitted):
    _, names, model = fitted
    from tallyward.sources import envelopes

    places = scoring_stream.Places(new_folder(spark, "stream"))
    side_files.write_user_stats(stats.user_stats(tx), places.at("user_stats"))
    envelopes.publish(history.wire_form(tx), places.at("envelopes"))
    scorer = Scorer(rates.defaults(spark), model, names)
    got = scoring_stream.replay(spark, places, scorer, q.at(q.NOW))
    assert got.count() == 1000
    assert got.filter("error is not null").count() == 0
    assert got.filter((F.col("fraud_probability") > 0.5) != F.col("is_fraud")).count() == 0
    assert got.select("feature_values.*").columns == names and "location_oslo_norway" in names
    oslo = got.filter("location = 'Oslo, Norway'").select("feature_values.location_oslo_norway").distinct().collect()
    assert [r[0] for r in oslo] == [1]


def test_values_outside_the_fixed_vocabulary(spark, tx):
    more = tx.withColumn("status", F.when(F.col("amount") > 60, "refunded").otherwise(F.col("status")))
    matrix, names, _ = training.prepare(more)
    assert {"status_refunded", "location_oslo_norway"} <= set(names)
    model = training.train(matrix, names, training.Parameters(maxDepth=3, maxIter=2))
    scorer = Scorer(rates.defaults(spark), model, [*names, "never_seen"][:-1])
    scored = scorer.score(history.wire_form(more), stats.user_stats(more))
    assert scored.filter("error is not null").count() == 0
    seen = scored.filter("status = 'refunded'").select("feature_values.status_refunded").distinct().collect()
    assert [r[0] for r in seen] == [1]
    without = Scorer(rates.defaults(spark), None, ["amount", "status_unheard_of", "no_such_feature"])
    got = without.score(history.wire_form(tx), stats.user_stats(tx)).select("feature_values.*").distinct()
    assert {(r.status_unheard_of, r.no_such_feature) for r in got.collect()} == {(0, 0)}


def test_whole_batch_job(spark, tx):
    out = new_folder(spark, "job")
    got = batch_job.run(tx, out, trials=2, rounds=3)
    assert got["roc_auc"] > 0.85 and got["test_size"] == 200
    made = side_files.read_manifest(spark, f"{out}/manifest")
    assert side_files.model_width(made) == len(made["feature_names"]) == 39
    assert not side_files.read_rates(spark, f"{out}/rates").seen.keys() - {"location", "device_type", "card_type", "status"}
    assert side_files.read_user_stats(spark, f"{out}/user_stats").count() == tx.select("user_id").na.drop().distinct().count()
    assert spark.read.json(f"{out}/thresholds").count() == 9
    assert spark.read.json(f"{out}/report").count() == 17
    assert spark.read.parquet(f"{out}/roc").agg(F.max("tpr")).first()[0] == 1.0
    model = PipelineModel.load(f"{out}/model")
    scorer = Scorer(side_files.read_rates(spark, f"{out}/rates"), model, made["feature_names"])
    rows = history.wire_form(tx)
    scored = scorer.score(rows, side_files.read_user_stats(spark, f"{out}/user_stats"))
    assert scored.filter("error is null").count() == 1000
