import threading

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from tests.helpers import frame, rows
from wardline.operators import evaluate, importance, logistic, models
from wardline.plans import study
from wardline.sources import tables


@pytest.fixture(scope="module")
def planted(spark):
    """Label driven by the first of four positions (two steps, two features)."""
    x = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0 for i in range(4)]
    noise = F.pmod(F.xxhash64("id", F.lit(99)), F.lit(1000)) / 1000.0
    df = spark.range(600).select(F.col("id").alias("stay_id"), array_to_vector(F.array(*x)).alias("features"), (x[0] + noise * 0.3 > 0.9).cast("int").alias("label"))
    return tables.cut_lineage(df)


def area(model, df):
    return evaluate.roc_auc(models.predict(model, df, "m", ["stay_id"])).first()["value"]


def test_models_find_the_signal(planted):
    assert area(models.fit_logistic(planted, C=10.0, penalty="l2", max_iter=30), planted) > 0.9
    assert area(models.fit_forest(planted, trees=5, depth=None), planted) > 0.9
    train, valid = planted.filter("stay_id % 5 > 0"), planted.filter("stay_id % 5 = 0")
    assert area(models.fit_boosted(train, valid, trees=5, depth=3, gamma=0), valid) > 0.9


def test_passes_fit_the_same_model(planted):
    for params in ({"C": 0.1}, {"C": 10.0, "penalty": "l2"}, {"C": 0.05, "fit_intercept": False}):
        plain = models.fit_logistic(planted, tol=1e-10, **params).stages[0]
        model = models.fit_logistic(planted, by_passes=True, **params).stages[0]
        assert model.coefficients.toArray() == pytest.approx(plain.coefficients.toArray(), rel=1e-3, abs=1e-3) and model.intercept == pytest.approx(plain.intercept, abs=1e-3)
        assert not model.hasSummary and model.getElasticNetParam() == plain.getElasticNetParam() and model.getRegParam() == plain.getRegParam()
        scored = models.predict(model, planted, "m", ["stay_id"]).join(models.predict(plain, planted, "m", ["stay_id"]).withColumnRenamed("prob", "other"), "stay_id")
        assert scored.filter("abs(prob - other) > 1e-4").count() == 0
    # one class: Spark's own fit
    assert models.fit_logistic(planted.withColumn("label", F.lit(0)), by_passes=True, max_iter=3).stages[0].hasSummary


def test_weights(planted):
    weighted = models.with_weight(planted)
    sums = dict(rows(weighted.groupBy("label").agg(F.round(F.sum("weight"), 6))))
    assert sums[0] == sums[1] == 300
    ratio = models.class_ratio(planted).first()[0]
    assert dict(rows(models.with_weight(planted, scheme="positive").groupBy("label").agg(F.max("weight")))) == {0: 1.0, 1: ratio}


def test_sample_grid_is_reproducible():
    grid = models.LOGISTIC_GRID
    assert len(models.sample_grid(grid, None)) == 24
    assert models.sample_grid(grid, 5) == models.sample_grid(grid, 5)
    assert len({str(c) for c in models.sample_grid(models.FOREST_GRID, 100)}) == 100


def test_search_of_one_choice_is_a_fit_of_every_fold(planted):
    """Regularisation and weights are those of the rows that are fitted."""
    choice = {"C": 0.05, "penalty": "l2"}
    estimator = models.logistic(1.0, max_iter=30)
    model, metrics = models.random_search(estimator, [choice], planted, "stay_id", folds=3, metric="auc", scheme="balanced")
    parted = models.with_folds(planted, "stay_id", 3)
    areas = [area(models.fit_logistic(parted.filter(f"fold <> {f}"), max_iter=30, **choice), parted.filter(f"fold = {f}")) for f in range(3)]
    assert metrics.first()["value"] == pytest.approx(sum(areas) / 3, abs=1e-6)
    whole = models.fit_logistic(planted, max_iter=30, **choice)
    assert model.stages[0].coefficients.toArray() == pytest.approx(whole.stages[0].coefficients.toArray(), abs=1e-6)


def test_grid_search_keeps_entities_apart(planted):
    train, valid = models.split_validation(planted, "stay_id", 0.7)
    assert train.count() + valid.count() == 600 and 90 < valid.count() < 270
    assert not {r[0] for r in train.select("stay_id").collect()} & {r[0] for r in valid.select("stay_id").collect()}
    model, metrics = models.grid_search(models.logistic(1.0, weight=None, max_iter=5), [{"C": 1e-4}, {"C": 10}], train, valid)
    values = [r["value"] for r in metrics.orderBy("run").collect()]
    assert len(values) == 2 and values[1] > values[0]
    assert area(model, valid) > 0.8


def test_weights_of_many_classes(spark):
    df = frame(spark, "label int", [(0,), (0,), (1,), (2,), (3,), (3,), (None,)])
    found = {r["label"]: r["weight"] for r in models.with_weight(df).collect()}
    assert found == {0: 0.75, 1: 1.5, 2: 1.5, 3: 0.75, None: None}


def test_classes_are_predicted(spark, planted):
    x = vector_to_array("features")[0]
    stages = planted.withColumn("label", F.floor(x * 2.999).cast("int"))
    model = models.fit_forest(stages, trees=5, depth=5)
    pred = models.predict_classes(model, stages, "m", ["stay_id"])
    assert pred.filter("label = predicted").count() > 560
    assert pred.filter("size(probs) <> 3").count() == 0


def test_rounds_end_after_patience():
    assert models.best_rounds([5, 4, 3, 3.5, 3.6, 2], 2) == 3
    assert models.best_rounds([5, 4, 3, 3.5, 3.6, 2], 3) == 6
    assert models.best_rounds([1, 2, 3], 10) == 1


def test_boosting_grows_up_to_the_best_round(planted):
    train, valid = planted.filter("stay_id % 5 > 0"), planted.filter("stay_id % 5 = 0")
    full = models.fit_boosted(train, trees=12, depth=5, gamma=0, learning_rate=0.5).stages[0]
    model = models.fit_boosted(train, valid, trees=12, depth=5, gamma=0, learning_rate=0.5, patience=2).stages[0]
    assert model.getNumTrees == models.best_rounds(full.evaluateEachIteration(valid.withColumn("weight", F.lit(1.0))), 2)


def test_tree_parameters_are_translated(spark):
    estimator = models.boosted_trees(weight=None)
    (params,) = models.param_maps(estimator, [{"trees": 20, "depth": 5, "learning_rate": 0.01, "min_child": 5, "gamma": 1}])
    assert {p.name for p in params} == {"maxIter", "maxDepth", "stepSize", "minInstancesPerNode", "minInfoGain"}
    (params,) = models.param_maps(models.random_forest(), [{"depth": None, "trees": 100}])
    assert {p.name: v for p, v in params.items()} == {"maxDepth": 30, "numTrees": 100}
    with pytest.raises(ValueError, match="depth 40"):
        models.random_forest(depth=40)
    with pytest.raises(ValueError, match="depth 31"):
        models.param_maps(estimator, [{"depth": 31}])


def test_best_model_is_kept(planted):
    path = tables.shared_folder(planted.sparkSession)
    candidates = {"weak": models.fit_logistic(planted, C=1e-5), "strong": models.fit_logistic(planted, C=10.0, max_iter=20)}
    best, value = models.keep_best(candidates, planted, path)
    assert best == "strong" and area(models.load_model(path), planted) == pytest.approx(value, abs=1e-6)


def test_importance_roll_up(spark):
    positions = importance.position_values(spark, Vectors.dense([0.1, -0.2, 0.3, -0.4]), ["a", "b"])
    assert [(f, round(v, 6)) for f, v in rows(importance.total_importance(positions))] == [("a", 0.4), ("b", -0.6)]
    odds = dict(rows(importance.signed_odds(positions)))
    assert odds["a"] > 1 and -1 < odds["b"] < 0
    assert [r["feature"] for r in importance.top(importance.total_importance(positions), 1).collect()] == ["b"]


def test_attribution_is_coefficient_times_value(spark):
    df = frame(spark, "id int, x array<double>", [(1, [1.0, 2.0, 3.0, 4.0]), (2, [3.0, 2.0, 1.0, 0.0])]).select(array_to_vector("x").alias("features"))
    found = dict(rows(importance.linear_attribution(df, Vectors.dense([1.0, 10.0, 2.0, -1.0]), ["a", "b"])))
    assert found == {"a": pytest.approx((2 * 1 + 2 * 2) / 2), "b": pytest.approx((2 * 10 + 2 * -1) / 2)}


def test_searches_fit_all_choices_in_the_same_passes(spark, planted, monkeypatch):
    """No fit of Spark's but the last one, the values of separate fits, and one objective for both."""
    fits = []
    own = models.LogisticRegression._fit
    monkeypatch.setattr(models.LogisticRegression, "_fit", lambda self, df: fits.append(1) or own(self, df))
    choices = models.sample_grid({"C": [0.05, 10], "fit_intercept": [True, False], "penalty": ["l1", "l2"]}, None)
    _, found = models.random_search(models.logistic(1.0), choices, planted, "stay_id", folds=2, metric="auc", scheme="balanced")
    assert len(fits) == 1
    values = [r["value"] for r in found.orderBy("run").collect()]
    parted = models.with_folds(planted, "stay_id", 2)
    for choice, value in list(zip(choices, values, strict=True))[::3]:
        areas = [area(models.fit_logistic(parted.filter(f"fold <> {f}"), tol=1e-9, **choice), parted.filter(f"fold = {f}")) for f in range(2)]
        assert value == pytest.approx(sum(areas) / 2, abs=1e-4)


@pytest.mark.parametrize("per_task", [logistic.PASS_CELLS, 60])
def test_batched_fits_are_those_of_spark(spark, planted, monkeypatch, per_task):
    """Also with a constant column, which has no coefficient, and few fits a job; odd parts are left to Spark."""
    monkeypatch.setattr(logistic, "PASS_CELLS", per_task)
    x = F.concat(vector_to_array("features"), F.array(F.lit(2.0)))
    train = tables.cut_lineage(models.with_weight(planted.withColumn("features", array_to_vector(x))))
    one_class = train.filter("label = 1")
    estimator = models.logistic(1.0, tol=1e-9)
    choices = models.sample_grid({"C": [0.05, 100], "fit_intercept": [True, False], "penalty": ["l1", "l2"]}, None)
    total = train.agg(F.sum("weight")).first()[0]
    maps = models.param_maps(estimator, choices, total)
    stored = logistic.store_parts([train, one_class], estimator, "weight")
    fitted = logistic.fit_parts(stored, estimator, {0: maps, 1: maps}, {0: total, 1: total})
    assert sorted(fitted) == [(0, i) for i in range(len(choices))]
    for i, params in enumerate(maps):
        model = estimator.fit(train, params)
        assert fitted[0, i] == pytest.approx([*model.coefficients.toArray(), model.intercept], abs=2e-3)
        assert fitted[0, i][4] == 0


def test_forests_keep_the_nodes_of_rows(spark):
    assert models.random_forest().getCacheNodeIds()


def test_baselines_are_fitted_at_the_same_time(spark, monkeypatch):
    together = threading.Barrier(3, timeout=60)
    known = {n: getattr(models, n) for n in ("fit_logistic", "fit_boosted", "fit_forest")}
    for name, fit in known.items():
        monkeypatch.setattr(models, name, lambda *a, fit=fit, **k: (together.wait(), fit(*a, **k))[1])
    rows = [(i, i % 2, ["train", "valid", "test"][i // 2 % 3], Vectors.dense([float(i % 2), float(i % 5)])) for i in range(60)]
    flat = spark.createDataFrame(rows, T.StructType().add("stay_id", "long").add("label", "integer").add("split", "string").add("features", VectorUDT()))
    small = {"logistic": {"max_iter": 5}, "boosted": {"trees": 2, "depth": 2}, "forest": {"trees": 3, "depth": 3}}
    pred = study.baseline_predictions(flat, **small).collect()
    assert sorted((r["stay_id"], r["model"]) for r in pred) == sorted((r[0], m) for r in rows if r[2] == "test" for m in small)
    assert all((r["prob"] > 0.5) == (r["label"] == 1) for r in pred if r["model"] != "logistic")
