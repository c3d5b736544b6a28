"""Model evaluation as queries over a prediction table.

A prediction table has a 0/1 ``label`` and a ``prob`` in [0, 1]; ``by`` names the columns (model,
step, ...) whose groups are evaluated separately. Rows without label or probability do not count.
A group with a single class has no ROC or PR area: its value is null.

Curves need cumulative counts over descending scores. Scores are first counted per distinct value;
these are scanned in cells of the log-odds scale, so that one large group is not sorted by one task, and
cells with many of them in slices of like counts. Several measures of one prediction table share a stored ``curve``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardline.functions.columns import CALIBRATION_EDGES, UNIT_EDGES, bin_index, decide
from wardline.operators.scans import SLICE, Running, attach, drop_slices, running, slice_number, split_large

_GROUP = "__group"
# Cells per unit of log-odds; beyond 40 units of log-odds doubles have no distinct probabilities below 1.
_CELLS_PER_UNIT = 1024
_CELL_LIMIT = 40 * _CELLS_PER_UNIT
# Distinct scores of a cell that are scanned together.
CELL_SCORES = 100_000
# Places of [0, 1] at which a density is known.
DENSITY_POINTS = 513


def _group(by: list[str]) -> Column:
    # a struct compares equal to another one with nulls at the same places
    return (F.struct(*by) if by else F.struct(F.lit(0).alias("all"))).alias(_GROUP)


def _ungroup(by: list[str]) -> list[Column]:
    return [F.col(_GROUP)[c].alias(c) for c in by]


def score_cell(prob: Column) -> Column:
    """Order-preserving cell of a probability."""
    odds = F.ln(prob / (F.lit(1.0) - prob)) * F.lit(float(_CELLS_PER_UNIT))
    inner = F.greatest(F.least(F.floor(odds), F.lit(_CELL_LIMIT)), F.lit(-_CELL_LIMIT))
    return F.when(prob <= 0, F.lit(-_CELL_LIMIT)).when(prob >= 1, F.lit(_CELL_LIMIT)).otherwise(inner).cast("bigint")


def curve(
    pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob", cell_scores: int = CELL_SCORES
) -> DataFrame:
    """Per group (a struct) and distinct score: positives and negatives, cumulated from the top, and rates.

    The distinct scores are stored. Where a cell has more than ``cell_scores`` of them they are dealt out by
    ranges of like counts, however dense they lie.
    """
    counts = (
        pred.filter(F.col(label).isNotNull() & F.col(prob).isNotNull())
        .groupBy(_group(by), F.col(prob).cast("double").alias("threshold"))
        .agg(F.sum((F.col(label) == 1).cast("bigint")).alias("pos"), F.sum((F.col(label) != 1).cast("bigint")).alias("neg"))
        .withColumn("__cell", score_cell(F.col("threshold")))
    )
    prepared, _ = split_large(counts, [_GROUP, "__cell"], "threshold", cell_scores)
    slices = drop_slices(prepared.withColumn("__part", slice_number()))
    slices = slices.withColumn(SLICE, F.struct(F.col("__cell").alias("cell"), F.col("__part").alias("part"))).drop("__cell", "__part")
    sums = {"tp": Running("sum", F.col("pos")), "fp": Running("sum", F.col("neg"))}
    scanned = running(slices, [_GROUP], "threshold", sums, descending=True, only_split=False, totals=True).drop(SLICE)
    return scanned.withColumns(
        {
            "tpr": F.try_divide(F.col("tp").cast("double"), F.col("tp_total")),
            "fpr": F.try_divide(F.col("fp").cast("double"), F.col("fp_total")),
        }
    )


def roc_points(pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob") -> DataFrame:
    """One point per distinct score: (threshold, tp, fp, tpr, fpr)."""
    return curve_points(curve(pred, by, label, prob), by)


def curve_points(scanned: DataFrame, by: list[str]) -> DataFrame:
    return scanned.select(*_ungroup(by), "threshold", "tp", "fp", "tpr", "fpr")


def roc_auc(pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob") -> DataFrame:
    """Area by trapezoids; tied scores get half credit."""
    return curve_area(curve(pred, by, label, prob), by)


def curve_area(scanned: DataFrame, by: list[str]) -> DataFrame:
    strip = F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0))
    return (
        scanned.groupBy(_GROUP)
        .agg(F.sum(strip).alias("area"), F.max("tp_total").alias("p"), F.max("fp_total").alias("n"))
        .select(*_ungroup(by), F.try_divide(F.col("area"), F.col("p").cast("double") * F.col("n")).alias("value"))
    )


def pr_points(pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob") -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    return curve_precision(curve(pred, by, label, prob), by)


def curve_precision(scanned: DataFrame, by: list[str]) -> DataFrame:
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return scanned.select(*_ungroup(by), "threshold", precision.alias("precision"), F.col("tpr").alias("recall"))


def pr_auc(pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob") -> DataFrame:
    """Area by trapezoids, starting at (recall 0, precision 1)."""
    return curve_precision_area(curve(pred, by, label, prob), by)


def curve_precision_area(scanned: DataFrame, by: list[str]) -> DataFrame:
    here = F.col("tp") / (F.col("tp") + F.col("fp"))
    tp, fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    before = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(1.0))
    strip = F.col("pos") * (here + before) / F.lit(2.0)
    return (
        scanned.groupBy(_GROUP)
        .agg(F.sum(strip).alias("area"), F.max("tp_total").alias("p"), F.max("fp_total").alias("n"))
        .select(*_ungroup(by), F.when(F.col("n") > 0, F.try_divide(F.col("area"), F.col("p"))).alias("value"))
    )


def brier(
    pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob", digits: int | None = 3
) -> DataFrame:
    error = F.avg(F.pow(F.col(prob) - F.col(label), F.lit(2.0)))
    return pred.groupBy(*by).agg((error if digits is None else F.round(error, digits)).alias("value"))


def positive_rate(pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob") -> DataFrame:
    """Precision of a classifier without skill, over the rows that count."""
    return pred.groupBy(*by).agg(F.avg(F.when(F.col(prob).isNotNull(), F.col(label))).alias("value"))


def youden_cutoff(
    pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob", digits: int = 4
) -> DataFrame:
    """Rounded score with the largest tpr - fpr, the highest such score on ties.

    If no score beats the empty decision, the cut-off lies one above the highest score.
    """
    return curve_cutoff(curve(pred, by, label, prob), by, digits)


def curve_cutoff(scanned: DataFrame, by: list[str], digits: int = 4) -> DataFrame:
    gain = F.col("tpr") - F.col("fpr")
    best = F.max(F.struct(gain.alias("gain"), F.col("threshold").alias("threshold")))
    cut = F.when(F.col("best")["gain"] > 0, F.col("best")["threshold"]).when(
        F.col("best")["gain"].isNotNull(), F.col("top") + F.lit(1.0)
    )
    return (
        scanned.groupBy(_GROUP)
        .agg(best.alias("best"), F.max("threshold").alias("top"))
        .select(*_ungroup(by), F.round(cut, digits).alias("cutoff"))
    )


def confusion(
    pred: DataFrame, cutoffs: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob"
) -> DataFrame:
    """(label, predicted, n), all four cells, deciding strictly above each group's cut-off.

    A group without a cut-off has no decisions: its cells are null.
    """
    scored = _join_groups(pred.filter(F.col(label).isNotNull() & F.col(prob).isNotNull()), cutoffs, by)
    said = decide(F.col(prob), F.col("cutoff"))
    return _cells(scored.groupBy(_group(by)), lambda y, p: F.when(said.isNotNull(), ((F.col(label) == y) & (said == p)).cast("bigint")), by)


def curve_confusion(scanned: DataFrame, cutoffs: DataFrame, by: list[str]) -> DataFrame:
    """The same from a curve, whose scores are already counted."""
    scored = attach(scanned, cutoffs.select(_group(by), "cutoff"), [_GROUP])
    said = decide(F.col("threshold"), F.col("cutoff"))
    return _cells(scored.groupBy(_GROUP), lambda y, p: F.when(said == p, F.col("pos" if y else "neg")).when(said.isNotNull(), 0), by)


def _cells(groups, measure, by: list[str]) -> DataFrame:
    cells = [(y, p) for y in (0, 1) for p in (0, 1)]
    counts = groups.agg(*[F.sum(measure(y, p)).alias(f"c{y}{p}") for y, p in cells])
    rows = F.array(*[F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), F.col(f"c{y}{p}").alias("n")) for y, p in cells])
    return counts.select(_GROUP, F.inline(rows)).select(*_ungroup(by), "label", "predicted", "n")


def _join_groups(pred: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Attach one row per group; a single global row comes as a scalar subquery."""
    values = [c for c in groups.columns if c not in by]
    if not by:
        return pred.withColumns({v: groups.select(v).scalar() for v in values})
    return attach(pred.withColumn(_GROUP, _group(by)), groups.select(_group(by), *values), [_GROUP]).drop(_GROUP)


def f1(confusions: DataFrame, by: list[str] = ["model"]) -> DataFrame:
    """2TP / (2TP + FP + FN) from confusion counts; 0 if there is nothing positive."""
    cell = lambda y, p: F.sum(F.when((F.col("label") == y) & (F.col("predicted") == p), F.col("n")).otherwise(0))
    tp, fp, fn = cell(1, 1), cell(0, 1), cell(1, 0)
    return confusions.groupBy(*by).agg(F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("value"))


def calibration(pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob") -> DataFrame:
    """Mean probability and observed rate of every non-empty bin."""
    binned = pred.filter(F.col(label).isNotNull() & F.col(prob).isNotNull())
    return binned.groupBy(*by, bin_index(F.col(prob), CALIBRATION_EDGES).alias("bin")).agg(
        F.avg(prob).alias("prob_mean"), F.avg(label).alias("label_rate")
    )


def _bin_counts(pred: DataFrame, by: list[str], prob: str, edges: list[float]) -> DataFrame:
    """Counts of all bins, empty ones included, from one aggregation."""
    index = bin_index(F.col(prob), edges)
    bins = range(len(edges) + 1)
    counts = (
        pred.filter(F.col(prob).isNotNull())
        .groupBy(_group(by))
        .agg(*[F.sum((index == b).cast("bigint")).alias(f"b{b}") for b in bins])
    )
    rows = F.array(*[F.struct(F.lit(b).alias("bin"), F.col(f"b{b}").alias("n")) for b in bins])
    return counts.select(_GROUP, F.inline(rows)).select(*_ungroup(by), "bin", "n")


def bin_totals(pred: DataFrame, by: list[str] = ["model"], prob: str = "prob") -> DataFrame:
    """Number of predictions per calibration bin, empty bins included."""
    return _bin_counts(pred, by, prob, CALIBRATION_EDGES)


def missing_bins(pred: DataFrame, by: list[str] = ["model"], prob: str = "prob") -> DataFrame:
    """Midpoints of the empty calibration bins as text, in bin order."""
    empty = F.collect_list(F.when(F.col("n") == 0, F.col("bin")))
    midpoints = F.transform(F.array_sort(empty), lambda b: F.concat((b * 10 + 5).cast("string"), F.lit("%")))
    return bin_totals(pred, by, prob).groupBy(*by).agg(F.array_join(midpoints, ", ").alias("missing"))


def histogram(pred: DataFrame, by: list[str] = ["model"], prob: str = "prob") -> DataFrame:
    """Ten equal bins on [0, 1]: count and share of the group; the last bin includes 1."""
    inside = pred.filter((F.col(prob) >= 0) & (F.col(prob) <= 1))
    counts = _bin_counts(inside, by, prob, UNIT_EDGES).withColumn(_GROUP, _group(by))
    totals = inside.groupBy(_group(by)).agg(F.count(F.lit(1)).alias("total"))
    return counts.join(totals, _GROUP).select(*by, "bin", "n", (F.col("n") / F.col("total")).alias("share"))


def class_histogram(pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob") -> DataFrame:
    """Distribution of the probability within each true class."""
    return histogram(pred, [*by, label], prob)


def density(
    pred: DataFrame, by: list[str] = ["model"], prob: str = "prob", points: int = DENSITY_POINTS, bandwidth: float | None = None
) -> DataFrame:
    """Gaussian kernel density of the probabilities at ``points`` even places of [0, 1]: (by, point, x, density).

    Every value is split between the two places next to it (linear binning), so one aggregation reduces
    a group to the weights of its places, and the kernel runs over these alone. Without a ``bandwidth`` it
    is the sample deviation times n to the power of -1/5. A group of one value has no density: null.
    Values outside [0, 1], nulls and NaN do not count.
    """
    value = F.col(prob).cast("double")
    inside = pred.filter(F.col(prob).between(0, 1) & ~F.isnan(value)).withColumn("__x", value * (points - 1))
    low = F.least(F.floor("__x"), F.lit(points - 2)).cast("int")
    binned = inside.withColumn("__low", low).groupBy(_group(by), "__low").agg(
        F.sum(F.col("__x") - F.col("__low")).alias("__up"), F.count(F.lit(1)).alias("__n"),
        F.min("__x").alias("__min"), F.max("__x").alias("__max"), F.avg("__x").alias("__mean"), F.var_pop("__x").alias("__var"),
    )
    # a group has fewer rows than there are places
    spread = F.map_from_entries(F.collect_list(F.struct("__low", F.struct((F.col("__n") - F.col("__up")).alias("here"), F.col("__up").alias("next")))))
    n, mean = F.sum("__n"), F.sum(F.col("__n") * F.col("__mean")) / F.sum("__n")
    squares = F.sum(F.col("__n") * (F.col("__var") + F.col("__mean") * F.col("__mean")))
    groups = binned.groupBy(_GROUP).agg(
        spread.alias("m"), n.alias("n"), mean.alias("mean"), squares.alias("squares"), (F.min("__min") < F.max("__max")).alias("varies")
    )
    deviation = F.sqrt(F.greatest(F.col("squares") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0)) / (F.col("n") - 1))
    width = F.pow(F.col("n").cast("double"), F.lit(-0.2)) * deviation if bandwidth is None else F.lit(bandwidth * (points - 1))
    places = F.sequence(F.lit(0), F.lit(points - 1))
    at = lambda i, side: F.coalesce(F.try_element_at("m", i)[side], F.lit(0.0))
    weights = F.transform(places, lambda i: at(i, "here") + at(i - 1, "next"))
    known = groups.withColumns({"weights": weights, "h": F.when(F.col("varies"), width)}).filter("h is null or h > 0")
    each = known.select(_GROUP, "weights", "n", "h", F.explode(places).alias("point"))
    kernel = F.aggregate(
        F.transform("weights", lambda w, i: w * F.exp(F.lit(-0.5) * F.pow((i - F.col("point")) / F.col("h"), F.lit(2.0)))),
        F.lit(0.0),
        lambda a, v: a + v,
    )
    scaled = kernel * (points - 1) / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    return each.select(*_ungroup(by), "point", (F.col("point") / F.lit(float(points - 1))).alias("x"), scaled.alias("density"))


def class_density(
    pred: DataFrame, by: list[str] = ["model"], label: str = "label", prob: str = "prob", points: int = DENSITY_POINTS
) -> DataFrame:
    """Smooth distribution of the probability within each true class."""
    return density(pred.filter(F.col(label).isNotNull()), [*by, label], prob, points)


def auc_per_step(
    pred: DataFrame, by: list[str] = ["model"], step: str = "step", label: str = "label", prob: str = "prob"
) -> DataFrame:
    """ROC area over entities at every time step; null where a step has one class only."""
    return roc_auc(pred, [*by, step], label, prob).withColumnRenamed("value", "auc")


def before_onset(
    pred: DataFrame,
    key: str,
    ts: str,
    by: list[str] = ["model"],
    label: str = "label",
    prob: str = "prob",
) -> DataFrame:
    """One row per entity: its prediction at the first positive moment, otherwise at the last one.

    Of several predictions at that moment the lowest counts at an onset, otherwise the highest.
    """
    onset = F.min(F.when(F.col(label) == 1, F.struct(F.col(ts).alias("t"), F.col(prob).alias("p"))))
    last = F.max(F.struct(F.col(ts).alias("t"), F.col(prob).alias("p")))
    found = pred.groupBy(*by, key).agg(F.max(label).alias(label), F.coalesce(onset, last).alias("__at"))
    return found.select(*by, key, F.col("__at")["t"].alias(ts), label, F.col("__at")["p"].alias(prob))


def weighted_log_loss(
    pred: DataFrame,
    positive_weight: float | Column,
    by: list[str] = ["model"],
    label: str = "label",
    prob: str = "prob",
    eps: float = 1e-12,
) -> DataFrame:
    """Mean logistic loss with positives weighted."""
    weight = F.lit(positive_weight) if isinstance(positive_weight, (int, float)) else positive_weight
    p = F.greatest(F.least(F.col(prob), F.lit(1.0 - eps)), F.lit(eps))
    y = F.col(label)
    loss = -(weight * y * F.ln(p) + (F.lit(1) - y) * F.log1p(-p))
    return pred.groupBy(*by).agg(F.avg(loss).alias("value"))


def pad_steps(
    pred: DataFrame,
    key: str,
    steps: int,
    by: list[str] = ["model"],
    step: str = "step",
    label: str = "label",
    prob: str = "prob",
) -> DataFrame:
    """Add the padding steps up to ``steps`` as negatives with probability ``0.5``.

    Only for results that have to count padding; a padded step carries no information.
    """
    types = dict(pred.dtypes)
    last = pred.groupBy(*by, key).agg(F.max(step).alias("__last")).filter(F.col("__last") < steps)
    missing = F.explode(F.sequence(F.col("__last") + F.lit(1), F.lit(steps))).alias("__step")
    padded = last.select(*by, key, missing).select(
        *by,
        key,
        F.col("__step").cast(types[step]).alias(step),
        F.lit(0).cast(types[label]).alias(label),
        F.lit(0.5).alias(prob),
    )
    return pred.select(*by, key, step, label, prob).unionByName(padded)


def compare(predictions: dict[str, DataFrame], name: str = "model") -> DataFrame:
    """Stack the predictions of several models for side-by-side evaluation."""
    parts = [df.drop(name).withColumn(name, F.lit(model)) for model, df in predictions.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
