"""Weighted classifiers on Spark ML: training, search, prediction."""

from __future__ import annotations

import itertools
import random
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from wardline.operators import logistic as logistics
from wardline.operators.evaluate import roc_auc
from wardline.sources.tables import cut_lineage

# Spark limits tree depth to 30; the published forest of depth 40 and the grid's deeper levels do not exist here.
MAX_TREE_DEPTH = 30
# ``gamma`` bounds a loss reduction summed over rows, Spark's minInfoGain a mean decrease of impurity.
GAMMA_SCALE = 1000.0

# MB of sums over nodes that a task of a forest's pass may hold; more of them take fewer passes.
FOREST_MB = 512

# Parameters of the published models and their search grids.
LOGISTIC = {"C": 0.1, "penalty": "l1", "fit_intercept": True, "max_iter": 1000}
BOOSTED = {"learning_rate": 0.1, "trees": 70, "depth": 7, "min_child": 3, "gamma": 0.5, "rows": 0.8, "columns": 0.8}
FOREST = {"trees": 700, "depth": MAX_TREE_DEPTH, "min_leaf": 2, "bootstrap": False}
LOGISTIC_GRID = {"C": [0.001, 0.01, 0.1, 1, 10, 100], "fit_intercept": [True, False], "penalty": ["l1", "l2"]}
BOOSTED_GRID = {
    "learning_rate": [0.01, 0.1],
    "trees": [20, 30, 40, 50, 60, 70, 80, 100],
    "depth": [5, 7, 9],
    "min_child": [1, 3, 5, 7],
    "gamma": [0, 0.5, 1],
}
FOREST_GRID = {
    "trees": list(range(100, 1001, 100)),
    "depth": [10, 15, 21, 26, MAX_TREE_DEPTH],
    "min_leaf": [2, 4],
    "bootstrap": [True, False],
}


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_ratio(df: DataFrame, label: str = "label", digits: int = 1) -> DataFrame:
    """One row: negatives per positive, rounded."""
    negatives, positives = F.count(F.when(F.col(label) == 0, 1)), F.count(F.when(F.col(label) == 1, 1))
    return df.agg(F.round(F.try_divide(negatives.cast("double"), positives), digits).alias("ratio"))


def with_weight(df: DataFrame, label: str = "label", scheme: str = "balanced", digits: int = 1) -> DataFrame:
    """Row weights: ``balanced`` gives all classes the same sum, ``positive`` weights positives by the class ratio."""
    if scheme == "positive":
        ratio = class_ratio(df, label, digits).scalar()
        return df.withColumn("weight", F.when(F.col(label) == 1, F.coalesce(ratio, F.lit(1.0))).otherwise(F.lit(1.0)))
    if scheme != "balanced":
        raise ValueError(f"unknown weights: {scheme}")
    # one entry per class
    entries = F.collect_list(F.struct(F.col(label).cast("int").alias("label"), F.col("n")))
    counts = class_counts(df.filter(F.col(label).isNotNull()), label).agg(F.map_from_entries(entries).alias("m"))
    c = F.col("__c")
    total = F.aggregate(F.map_values(c), F.lit(0).cast("bigint"), lambda a, n: a + n).cast("double")
    own = F.try_element_at(c, F.col(label).cast("int"))
    return df.withColumn("__c", counts.scalar()).withColumn("weight", F.try_divide(total, F.size(c) * own)).drop("__c")


def tree_depth(depth: int | None) -> int:
    """A depth that Spark can grow; None is the deepest."""
    if depth is not None and depth > MAX_TREE_DEPTH:
        raise ValueError(f"trees of depth {depth}: Spark grows {MAX_TREE_DEPTH} at most")
    return depth or MAX_TREE_DEPTH


def logistic(
    total_weight: float, C: float = 0.1, penalty: str = "l1", fit_intercept: bool = True, max_iter: int = 1000,
    weight: str | None = "weight", tol: float = 1e-6,
) -> LogisticRegression:
    """The objective sum(loss) * C + penalty corresponds to regParam 1 / (C * sum of weights)."""
    estimator = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        regParam=1.0 / (C * total_weight),
        fitIntercept=fit_intercept,
        standardization=False,
        maxIter=max_iter,
        tol=tol,
    )
    return estimator.setWeightCol(weight) if weight else estimator


def boosted_trees(
    learning_rate: float = 0.1,
    trees: int = 70,
    depth: int = 7,
    min_child: int = 3,
    gamma: float = 0.5,
    rows: float = 0.8,
    columns: float = 0.8,
    seed: int = 42,
    weight: str | None = "weight",
    gamma_scale: float = GAMMA_SCALE,
) -> GBTClassifier:
    """Gradient boosted trees; ``gamma / gamma_scale`` and ``min_child`` are the nearest stopping rules Spark has."""
    estimator = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        stepSize=learning_rate,
        maxIter=trees,
        maxDepth=tree_depth(depth),
        minInstancesPerNode=min_child,
        minInfoGain=gamma / gamma_scale,
        subsamplingRate=rows,
        featureSubsetStrategy=str(columns),
        seed=seed,
    )
    return estimator.setWeightCol(weight) if weight else estimator


def random_forest(
    trees: int = 700, depth: int | None = MAX_TREE_DEPTH, min_leaf: int = 2, bootstrap: bool = False, seed: int = 42
) -> RandomForestClassifier:
    """A forest whose passes keep the node of every row and tree, instead of walking down from the root each time."""
    return RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        numTrees=trees,
        maxDepth=tree_depth(depth),
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt",
        impurity="gini",
        bootstrap=bootstrap,
        seed=seed,
        cacheNodeIds=True,
        maxMemoryInMB=FOREST_MB,
    )


def _total_weight(train: DataFrame, weight: str | None) -> float:
    total = F.sum(weight) if weight else F.count(F.lit(1))
    return float(train.agg(total).first()[0])


def fit_logistic(train: DataFrame, scheme: str | None = "balanced", by_passes: bool = False, **params) -> PipelineModel:
    """``by_passes`` takes the Newton steps of searches, a job per step and few of them, where these can fit the rows."""
    weighted = with_weight(train, scheme=scheme) if scheme else train
    column = "weight" if scheme else None
    estimator = logistic(_total_weight(weighted, column), weight=column, **params)
    model = logistics.fit_model(weighted, estimator, column) if by_passes else None
    return PipelineModel([model]) if model else Pipeline(stages=[estimator]).fit(weighted)


def best_rounds(losses: list[float], patience: int) -> int:
    """Rounds up to the lowest loss before ``patience`` rounds bring no lower one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            break
    return best + 1


def fit_boosted(
    train: DataFrame, valid: DataFrame | None = None, scheme: str | None = "positive", patience: int = 40, **params
) -> PipelineModel:
    """Boosted trees; with ``valid`` rows the rounds stop where their loss has not fallen for ``patience`` rounds.

    All rounds are grown, their losses on the validation rows compared, and the model grown again up
    to the best one: the same seed grows the same trees. Weights come from the training rows.
    """
    weighted = with_weight(train, scheme=scheme) if scheme else train
    estimator = boosted_trees(weight="weight" if scheme else None, **params)
    model = Pipeline(stages=[estimator]).fit(weighted)
    if valid is None:
        return model
    held = valid.withColumn("weight", F.lit(1.0)) if scheme else valid
    rounds = best_rounds(model.stages[0].evaluateEachIteration(held), patience)
    if rounds == estimator.getMaxIter():
        return model
    return Pipeline(stages=[estimator.setMaxIter(rounds)]).fit(weighted)


def fit_forest(train: DataFrame, **params) -> PipelineModel:
    """A forest; that of two classes grows in groups of tasks and keeps its nodes as a table, not in the driver."""
    from wardline.operators import forest as forests

    estimator = random_forest(**params)
    if {r[0] for r in train.select("label").distinct().limit(4).collect()} <= {None, 0, 1}:
        return PipelineModel([forests.fit_model(train, estimator)])
    return Pipeline(stages=[estimator]).fit(train)


def predict(model: Model, df: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """Prediction table: the kept columns, model name, label and probability of class 1."""
    scored = model.transform(df)
    return scored.select(*keep, F.lit(name).alias("model"), F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("prob"))


def predict_classes(model: Model, df: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """The same for any number of classes: label, most probable class, and the probabilities of all."""
    scored = model.transform(df)
    return scored.select(
        *keep,
        F.lit(name).alias("model"),
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("predicted"),
        vector_to_array("probability").alias("probs"),
    )


def sample_grid(grid: dict[str, list], draws: int | None, seed: int = 42) -> list[dict]:
    """Parameter combinations: all of them, or ``draws`` different ones."""
    combinations = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    if draws is None or draws >= len(combinations):
        return combinations
    return random.Random(seed).sample(combinations, draws)


# Search parameter -> (Spark parameter, conversion).
_LOGISTIC_PARAMS = {
    "C": ("regParam", lambda v, w: 1.0 / (v * w)),
    "penalty": ("elasticNetParam", lambda v, w: 1.0 if v == "l1" else 0.0),
    "fit_intercept": ("fitIntercept", lambda v, w: v),
    "max_iter": ("maxIter", lambda v, w: v),
}
_TREE_PARAMS = {
    "depth": ("maxDepth", lambda v, w: tree_depth(v)),
    "min_child": ("minInstancesPerNode", lambda v, w: v),
    "min_leaf": ("minInstancesPerNode", lambda v, w: v),
    "gamma": ("minInfoGain", lambda v, w: v / GAMMA_SCALE),
    "bootstrap": ("bootstrap", lambda v, w: v),
    "learning_rate": ("stepSize", lambda v, w: v),
}


def param_maps(estimator, choices: list[dict], total_weight: float = 1.0) -> list[dict]:
    trees = "maxIter" if isinstance(estimator, GBTClassifier) else "numTrees"
    known = _LOGISTIC_PARAMS if isinstance(estimator, LogisticRegression) else _TREE_PARAMS | {"trees": (trees, lambda v, w: v)}
    return [
        {estimator.getParam(known[k][0]): known[k][1](v, total_weight) for k, v in choice.items()} for choice in choices
    ]


def with_folds(df: DataFrame, key: str, folds: int) -> DataFrame:
    """Fold number per entity, so that an entity never is in training and test at once."""
    return df.withColumn("fold", F.pmod(F.xxhash64(key), F.lit(folds)).cast("int"))


def _weight_of(estimator) -> str | None:
    return estimator.getWeightCol() if estimator.isDefined("weightCol") and estimator.isSet("weightCol") else None


def _measure_each(
    estimator, choices: list[dict], weighted: DataFrame, valid: DataFrame, metric: str, total: float, parallelism: int
) -> list[float]:
    """Metric of every choice by a fit of Spark's each."""
    maps = param_maps(estimator, choices, total)
    evaluator = _evaluator(metric)
    return _each(lambda i: evaluator.evaluate(estimator.fit(weighted, maps[i]).transform(valid)), len(choices), parallelism)


def _each(value, n: int, parallelism: int) -> list[float]:
    with ThreadPool(parallelism) as pool:
        return pool.map(value, range(n))


def _measure(
    estimator, choices: list[dict], parts: list[tuple[DataFrame, DataFrame]], metric: str, scheme: str | None, parallelism: int
) -> list[list[float]]:
    """Per part the metric of every choice, fitted on its first frame and measured on its second.

    Weights and the sum behind the regularisation are those of the rows that are fitted. Logistic regressions of
    two classes are fitted together, those of all parts and choices.
    """
    weighted = [with_weight(train, scheme=scheme) if scheme else train for train, _ in parts]
    values: dict[int, list[float]] = {}
    if logistics.is_plain(estimator):
        stored = logistics.store_parts(weighted, estimator, _weight_of(estimator))
        total = {r["part"]: r["w"] for r in stored.groupBy("part").agg(F.sum("weight").alias("w")).collect()}
        maps = {p: param_maps(estimator, choices, w) for p, w in total.items() if w}
        fitted = logistics.fit_parts(stored, estimator, maps, total)
        values = _measure_margins(estimator, len(choices), [valid for _, valid in parts], fitted, metric, parallelism) if fitted else {}
    for p in range(len(parts)):
        if p not in values:
            rows = cut_lineage(weighted[p])
            values[p] = _measure_each(estimator, choices, rows, parts[p][1], metric, _total_weight(rows, _weight_of(estimator)), parallelism)
    return [values[p] for p in range(len(parts))]


def _measure_margins(
    estimator, n: int, held: list[DataFrame], fitted: dict, metric: str, parallelism: int
) -> dict[int, list[float]]:
    scored = logistics.margins(held, estimator, fitted)
    evaluator = _evaluator(metric)
    pairs = [(p, i) for p in sorted({p for p, _ in fitted}) for i in range(n)]

    def one(k: int) -> float:
        p, i = pairs[k]
        margin = F.col("m")[i]
        told = scored.filter(F.col("part") == p).select("label", margin.alias("rawPrediction"), (margin > 0).cast("double").alias("prediction"))
        return evaluator.evaluate(told)

    found = dict(zip(pairs, _each(one, len(pairs), parallelism), strict=True))
    return {p: [found[p, i] for i in range(n)] for p, _ in pairs}


def _refit(estimator, choice: dict, train: DataFrame, scheme: str | None) -> PipelineModel:
    weighted = with_weight(train, scheme=scheme) if scheme else train
    (params,) = param_maps(estimator, [choice], _total_weight(weighted, _weight_of(estimator)))
    return Pipeline(stages=[estimator.copy(params)]).fit(weighted)


def random_search(
    estimator, choices: list[dict], train: DataFrame, key: str, folds: int = 5, metric: str = "accuracy",
    scheme: str | None = None, parallelism: int = 4,
) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated search; the best choice fitted on all rows, and one (run, params, metric, value) row per choice.

    An entity is in one fold with all its rows. Pass a stored training set: it is read for every fold, which is stored as
    well. Logistic regressions of all folds and choices are fitted in the same passes, other estimators one by one.
    """
    parted = with_folds(train, key, folds)
    sums = [0.0] * len(choices)
    parts = [(parted.filter(F.col("fold") != fold), parted.filter(F.col("fold") == fold)) for fold in range(folds)]
    for values in _measure(estimator, choices, parts, metric, scheme, parallelism):
        for i, value in enumerate(values):
            sums[i] += value / folds
    best = max(range(len(choices)), key=lambda i: sums[i])
    return _refit(estimator, choices[best], train, scheme), metric_rows(train, choices, metric, sums)


def split_validation(df: DataFrame, key: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Rows of ``share`` of the entities for training, those of the others for validation."""
    place = F.pmod(F.xxhash64(key, F.lit("validation")), F.lit(10_000))
    return df.filter(place < int(share * 10_000)), df.filter(place >= int(share * 10_000))


def grid_search(
    estimator, choices: list[dict], train: DataFrame, valid: DataFrame, metric: str = "auc",
    scheme: str | None = None, parallelism: int = 4,
) -> tuple[PipelineModel, DataFrame]:
    """Every choice fitted on ``train`` and measured on ``valid``, which has other entities; the best by the metric."""
    (values,) = _measure(estimator, choices, [(train, valid)], metric, scheme, parallelism)
    best = max(range(len(choices)), key=lambda i: values[i])
    return _refit(estimator, choices[best], train, scheme), metric_rows(train, choices, metric, values)


def _evaluator(metric: str):
    if metric == "auc":
        return BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    return MulticlassClassificationEvaluator(labelCol="label", metricName=metric)


def metric_rows(df: DataFrame, choices: list[dict], metric: str, values: list[float]) -> DataFrame:
    """One row per configuration: run number, parameters, metric name, value."""
    rows = [(i, {k: str(v) for k, v in c.items()}, metric, float(m)) for i, (c, m) in enumerate(zip(choices, values))]
    return df.sparkSession.createDataFrame(rows, "run int, params map<string,string>, metric string, value double")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def keep_best(candidates: dict[str, Model], valid: DataFrame, path: str) -> tuple[str, float]:
    """Save the candidate with the best validation ROC area; returns its name and area."""
    scored = {name: roc_auc(predict(model, valid, name, [])) for name, model in candidates.items()}
    areas = {name: area.first()["value"] for name, area in scored.items()}
    best = max(areas, key=lambda n: -1.0 if areas[n] is None else areas[n])
    save_model(candidates[best], path)
    return best, areas[best]
