from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cohortmill.operators import features, learn
from cohortmill.operators.joins import measured
from cohortmill.session import scratch

TRIAL = (
    "nct_id string, phase string, overall_status string, lead_sponsor_class string, location_country string, "
    "enrollment_count int, start_date date, completion_date date, sex string, healthy_volunteers string"
)


def trials(spark, n=400):
    """Trials whose outcome follows from phase and size, but for some noise."""
    rng = random.Random(1)
    made = []
    for i in range(n):
        phase, size = rng.choice(["phase 1", "phase 2"]), rng.randrange(100)
        done = (phase == "phase 1" and size > 30) != (rng.random() < 0.05)
        status = "completed" if done else rng.choice(["terminated", "withdrawn"])
        made.append((f"N{i}", phase, status, "INDUSTRY", rng.choice(["FR", None]), size,
                     dt.date(2020, 1, 1), dt.date(2020, 2, 1), "all", "no"))
    made += [("OPEN", "phase 1", "recruiting", None, None, 5, None, None, None, None)]
    return spark.createDataFrame(made, TRIAL)


def test_trial_features_leave_open_trials_out(spark):
    bridge = spark.createDataFrame(
        [("N0", "x", "b"), ("N0", "y", "a"), ("N0", "z", "a")],
        "nct_id string, condition_name string, condition_category string",
    )
    got = features.trial_features(trials(spark, 3), bridge, "2024-01-01")
    by_id = {r.nct_id: r for r in got.collect()}
    assert set(by_id) == {"N0", "N1", "N2"}
    assert (by_id["N0"].condition_category, by_id["N0"].n_conditions, by_id["N0"].n_categories) == ("a", 3, 2)
    assert (by_id["N1"].condition_category, by_id["N1"].n_conditions) == (None, 0)
    filled = features.fill_features(got, features.TRIAL_CATEGORICAL).filter("nct_id = 'N1'").first()
    assert filled.condition_category == "unknown"


def test_mart_features(spark):
    mart = spark.createDataFrame(
        [("p", "c", "s", "FR", 5.5, 10.0, 50.1), ("p", "c", "s", "DE", 1.0, 10.0, 50.0),
         ("p", "c", "s", "IT", 1.0, 10.0, None), ("p", "c", "s", "ES", None, 10.0, 90.0),
         ("p", "c", "s", "PT", 1.0, None, 90.0)],
        "phase string, condition_category string, lead_sponsor_class string, location_country string, "
        "avg_enrollment double, avg_duration_days double, completion_rate_pct double",
    )
    got = {r.location_country: r for r in features.mart_features(mart).collect()}
    assert {c: r.is_completed for c, r in got.items()} == {"FR": 1, "DE": 0, "IT": 0}
    assert (got["FR"].enrollment_count, got["FR"].sex, got["FR"].healthy_volunteers) == (5.5, "all", "no")


def test_label_codes_are_ranks_over_all_sort_tasks(spark):
    rng = random.Random(2)
    made = [(f"v{rng.randrange(3000):04d}", rng.choice("zyx")) for _ in range(9000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = scratch(spark, "codes")
        df = spark.createDataFrame(made, "a string, b string").repartition(4)
        codes = features.write_label_codes(df, ["a", "b"], path)
        assert spark.read.parquet(f"{path}/places").select(F.shiftright("place", 33)).distinct().count() > 1
        got = {(r.feature, r.value): r.code for r in codes.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {("a", v): i for i, v in enumerate(sorted({a for a, _ in made}))}
    want |= {("b", v): i for i, v in enumerate("xyz")}
    assert got == want
    coded = features.encode_labels(spark.createDataFrame([("v0000x", "y")], "a string, b string"), codes, ["a", "b"])
    assert (coded.first().a, coded.first().b) == (-1, 1)


@pytest.mark.parametrize("share", [0.2, 0.5])
def test_split_is_exact_per_label_and_ignores_order(spark, rows, share):
    sizes = {0: 3, 1: 35, 2: 1, 3: 500}
    made = [(f"k{label}-{i}", label) for label, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(made, "k string, label int")
    got = features.stratified_split(df, ["k"], "label", share)
    tests = {r.label: r.n for r in got.groupBy("label").agg(F.count_if(~F.col("is_train")).alias("n")).collect()}
    assert tests == {label: int(n * share + 0.5) for label, n in sizes.items()}
    random.Random(5).shuffle(made)
    again = spark.createDataFrame(made, "k string, label int").repartition(7)
    assert rows(features.stratified_split(again, ["k"], "label", share), "k", "is_train") == rows(got, "k", "is_train")
    other = features.stratified_split(df, ["k"], "label", share, seed=7)
    assert rows(other, "k", "is_train") != rows(got, "k", "is_train")


def test_measured_broadcasts_only_up_to_its_limit(spark, plan):
    big, small = spark.range(1000).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(big.join(measured(small, 5), "k"))
        over = big.join(measured(small, 4), "k")
        assert "SortMergeJoin" in plan(over) and over.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_metrics_agree_with_brute_force(spark):
    rng = random.Random(4)
    made = []
    for _ in range(300):
        actual = int(rng.random() < 0.3)
        p = min(1.0, max(0.0, round(rng.gauss(0.4 + 0.2 * actual, 0.2), 2)))
        made.append((int(p > 0.5), p, actual))
    df = spark.createDataFrame(made, "predicted_completed int, completion_probability double, actual int")
    got = learn.evaluate(df)
    pairs = [(a[1], b[1]) for a in made if a[2] for b in made if not b[2]]
    auc = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x, y in pairs) / len(pairs)
    f1 = MulticlassClassificationEvaluator(metricName="f1", labelCol="actual", predictionCol="p").evaluate(
        df.withColumn("p", F.col("predicted_completed").cast("double"))
    )
    wrong = sum(p != a for p, _, a in made) / len(made)
    assert got["auc"] == pytest.approx(auc, abs=1e-9)
    assert got["f1"] == pytest.approx(f1, abs=1e-9)
    assert got["mae"] == pytest.approx(wrong) and got["accuracy"] == pytest.approx(1 - wrong)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "is_completed int")
    sums = {r.is_completed: r.s for r in learn.balanced_weights(df).groupBy("is_completed").agg(F.sum("w").alias("s")).collect()}
    assert sums[0] == pytest.approx(2.0) and sums[1] == pytest.approx(2.0)


def test_training_learns_stores_and_ranks(spark):
    root = scratch(spark, "learn")
    none = spark.createDataFrame([], "nct_id string, condition_name string, condition_category string")
    rows = features.fill_features(features.trial_features(trials(spark), none), features.TRIAL_CATEGORICAL)
    codes = features.write_label_codes(rows, features.TRIAL_CATEGORICAL, f"{root}/labels")
    coded = features.stratified_split(
        features.encode_labels(rows, codes, features.TRIAL_CATEGORICAL), ["nct_id"], features.TARGET
    )
    small = {"random_forest": {"numTrees": 8, "maxDepth": 4}, "gradient_boosting": {"maxIter": 5, "maxDepth": 3}}
    runs = learn.train_models(coded, features.TRIAL_FEATURES, root, "2024-01-01", ["nct_id"], small)
    logged = {r.model_type: r for r in learn.read_runs(spark, root).collect()}
    assert set(logged) == set(small) and runs.count() == 2
    assert logged["random_forest"].params["numTrees"] == "8" and logged["random_forest"].params["maxDepth"] == "4"
    assert all(r.auc > 0.85 and r.n_train == 320 and r.n_test == 80 for r in logged.values())
    best = learn.best_run(learn.read_runs(spark, root)).first()
    assert best.auc == max(r.auc for r in logged.values())
    predictions = learn.best_predictions(spark, root, "2024-01-01")
    assert predictions.columns == ["nct_id", "predicted_completed", "completion_probability", "actual"]
    assert predictions.count() == 80
    model = learn.PipelineModel.load(logged["random_forest"].path)
    weights = {r.feature: r.importance for r in learn.importances(model, spark, features.TRIAL_FEATURES).collect()}
    assert sum(weights.values()) == pytest.approx(1.0)
    assert sorted(weights, key=weights.get)[-2:] == ["phase", "enrollment_count"] or weights["enrollment_count"] > 0.3


def test_equal_auc_takes_the_first_model(spark):
    runs = spark.createDataFrame([("b", 1, 0.9), ("a", 0, 0.9), ("c", 2, 0.1)], "model_type string, position int, auc double")
    assert learn.best_run(runs).first().model_type == "a"


def test_a_run_without_an_auc_is_never_best(spark):
    rows = [("a", 0, float("nan")), ("b", 1, 0.6), ("c", 2, 0.6), ("d", 3, None)]
    runs = spark.createDataFrame(rows, "model_type string, position int, auc double")
    assert learn.best_run(runs).first().model_type == "b"
    assert learn.best_run(runs.filter("model_type = 'a'")).isEmpty()


def test_every_code_has_a_bin(spark):
    rows = spark.range(300).selectExpr("cast(id AS int) AS country", "cast(id % 3 AS int) AS phase")
    assert learn.bins(rows, ["country", "phase"]) >= 300
    assert learn.bins(rows, ["phase"]) == learn.bins(rows.limit(0), ["phase"]) == learn.MIN_BINS


def test_training_rows_are_dealt_evenly_whatever_their_files(spark):
    uneven = spark.range(0, 4_000, 1, 16).filter("id < 250")
    sizes = [r["count"] for r in learn.spread(uneven).groupBy(F.spark_partition_id()).count().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert len(sizes) == cores and max(sizes) - min(sizes) <= 1 and sum(sizes) == 250


def test_forest_rows_keep_their_nodes(spark):
    forest = learn.classifier("random_forest", "y", numTrees=3)
    assert forest.getCacheNodeIds() and forest.getNumTrees() == 3 and forest.getMaxDepth() == 10
    rows = spark.range(200).selectExpr("cast(id % 10 AS int) AS a", "cast(id % 7 AS int) AS b", "cast(id % 10 > 4 AS int) AS y")
    kept, walked = (
        learn.fit("random_forest", rows, ["a", "b"], "y", numTrees=3, maxDepth=3, cacheNodeIds=on) for on in (True, False)
    )
    assert kept.stages[-1].toDebugString.split("\n")[1:] == walked.stages[-1].toDebugString.split("\n")[1:]


def test_a_forest_on_many_rows_grows_in_groups(spark, monkeypatch):
    names = ["a", "b", "c", "d"]
    digits = [f"cast(crc32(concat(id, '{name}')) % 10 AS int) AS {name}" for name in names]
    rows = spark.range(400).selectExpr("id", *digits).selectExpr(*names, "cast((a > 4) != (id % 9 = 0) AS int) AS y")
    together, fit = [], learn.RandomForestClassifier._fit

    def spied(trees, data):
        together.append(trees.getNumTrees())
        return fit(trees, data)

    monkeypatch.setattr(learn.RandomForestClassifier, "_fit", spied)
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(learn, "FEW_PAIRS", 1, raising=False)
    # What a task keeps is bounded, however many rows: three trees of 400 rows at a time.
    monkeypatch.setattr(learn, "CORE_PAIRS", 3 * 400 // cores, raising=False)
    model = learn.fit("random_forest", rows, names, "y", numTrees=7, maxDepth=3)
    assert together == [3, 2, 2]
    forest = model.stages[-1]
    assert (forest.getNumTrees, len(forest.trees), forest.numClasses, forest.numFeatures) == (7, 7, 2, 4)
    assert (forest.getOrDefault("numTrees"), forest.getOrDefault("seed"), forest.getOrDefault("featureSubsetStrategy")) == (7, 42, "auto")
    # A group of one tree looks at a part of the features too, and no two groups draw the same rows.
    monkeypatch.setattr(learn, "CORE_PAIRS", 400 // cores)
    alone = learn.fit("random_forest", rows, names, "y", numTrees=12, maxDepth=3).stages[-1]
    assert together[3:] == [1] * 12
    assert len({tree.toDebugString.split("\n", 1)[1] for tree in alone.trees}) > 6
    assert any("feature 0" not in tree.toDebugString.split("\n")[1] for tree in alone.trees)
    assert sum(forest.featureImportances.toArray()) == pytest.approx(1.0)
    path = scratch(spark, "forest")
    model.write().save(path)
    loaded = learn.PipelineModel.load(path)
    scores = [[r.probability for r in m.transform(rows).select("probability").collect()] for m in (model, loaded)]
    assert scores[0] == scores[1] and max(p[1] for p in scores[0]) > 0.7 > 0.3 > min(p[1] for p in scores[0])
