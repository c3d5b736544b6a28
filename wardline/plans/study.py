"""From prepared rows to predictions of the baseline and continuous models, and their report."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from wardline.config import Settings
from wardline.operators import evaluate, models
from wardline.operators.grid import history_features, step_index
from wardline.operators.sequences import to_vectors
from wardline.plans.preparation import Prepared
from wardline.sources.tables import cut_lineage


def flat_vectors(made: Prepared, settings: Settings = Settings(), store=cut_lineage) -> DataFrame:
    """One stored row per entity: its label, split and flat vector."""
    s = settings
    rows = made.rows.withColumnRenamed(s.label, "label")
    return store(to_vectors(rows, s.entity, s.time, made.features, s.steps, ["label", "split"], s.fill_value))


def baseline_predictions(
    flat: DataFrame,
    settings: Settings = Settings(),
    logistic: dict | None = None,
    boosted: dict | None = None,
    forest: dict | None = None,
) -> DataFrame:
    """Predictions for the test entities by the three baseline models.

    Logistic regression and forest learn from training and validation entities; the boosted trees
    use the latter for early stopping. The models are fitted at the same time, since their many short jobs leave
    cores idle.
    """
    train, valid, test = (flat.filter(F.col("split") == part) for part in ("train", "valid", "test"))
    both = flat.filter(F.col("split") != "test")
    fits = {
        "logistic": lambda: models.fit_logistic(both, by_passes=True, **(models.LOGISTIC | (logistic or {}))),
        "boosted": lambda: models.fit_boosted(train, valid, **(models.BOOSTED | (boosted or {}))),
        "forest": lambda: models.fit_forest(both, **(models.FOREST | (forest or {}))),
    }
    with ThreadPool(len(fits)) as pool:
        fitted = pool.map(lambda fit: fit(), fits.values())
    scored = [models.predict(model, test, name, [settings.entity]) for name, model in zip(fits, fitted, strict=True)]
    return reduce(lambda a, b: a.unionByName(b), scored)


def continuous_predictions(
    made: Prepared,
    settings: Settings = Settings(target="continuous"),
    lags: tuple[int, ...] = (1, 4),
    windows: tuple[int, ...] = (4, 16),
    store=cut_lineage,
    **params,
) -> DataFrame:
    """A probability at every grid step of the test entities, learnt from their history so far."""
    s = settings
    rows = made.rows.withColumnRenamed(s.label, "label")
    told = history_features(rows, s.entity, s.time, made.scaled, list(lags), list(windows))
    inputs = [c for c in told.columns if c not in (s.entity, s.time, "label", "split")]
    numbered = step_index(told.fillna(s.fill_value, subset=inputs), s.entity, s.time)
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(numbered)
    stored = store(vectors.select(s.entity, s.time, "step", "label", "split", "features"))
    model = models.fit_logistic(stored.filter(F.col("split") == "train"), **(models.LOGISTIC | params))
    return models.predict(model, stored.filter(F.col("split") == "test"), "history", [s.entity, s.time, "step"])


def report(pred: DataFrame, by: list[str] = ["model"], store=cut_lineage) -> dict[str, DataFrame]:
    """All evaluation frames of a prediction table, which should be a stored one.

    Curves, areas, cut-offs and confusions come from one stored curve.
    """
    scanned = store(evaluate.curve(pred, by))
    cutoffs = store(evaluate.curve_cutoff(scanned, by))
    cells = evaluate.curve_confusion(scanned, cutoffs, by)
    return {
        "roc_points": evaluate.curve_points(scanned, by),
        "pr_points": evaluate.curve_precision(scanned, by),
        "cutoff": cutoffs,
        "confusion": cells,
        "calibration": evaluate.calibration(pred, by),
        "missing_bins": evaluate.missing_bins(pred, by),
        "histogram": evaluate.histogram(pred, by),
        "class_histogram": evaluate.class_histogram(pred, by),
        "scores": scores(pred, scanned, by, evaluate.f1(cells, by)),
    }


def scores(pred: DataFrame, scanned: DataFrame, by: list[str], f1: DataFrame) -> DataFrame:
    """(by, metric, value): area under ROC and PR, Brier score, rate of positives, F1 at the cut-off."""
    parts = {
        "roc_auc": evaluate.curve_area(scanned, by),
        "pr_auc": evaluate.curve_precision_area(scanned, by),
        "brier": evaluate.brier(pred, by),
        "no_skill": evaluate.positive_rate(pred, by),
        "f1": f1,
    }
    named = [df.select(*by, F.lit(name).alias("metric"), F.col("value").cast("double").alias("value")) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), named)
