import math
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, frame, rows
from wardline.operators import evaluate

SCHEMA = "model string, label int, prob double"


def brute_auc(pairs):
    ones, zeros = [p for y, p in pairs if y == 1], [p for y, p in pairs if y == 0]
    if not ones or not zeros:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


def brute_pr_auc(pairs):
    """Trapezoids over the thresholds, starting at recall 0 and precision 1."""
    total, area, before = sum(y for y, _ in pairs), 0.0, (0.0, 1.0)
    for cut in sorted({p for _, p in pairs}, reverse=True):
        chosen = [y for y, p in pairs if p >= cut]
        here = (sum(chosen) / total, sum(chosen) / len(chosen))
        area += (here[0] - before[0]) * (here[1] + before[1]) / 2
        before = here
    return area


def sample(seed, n=300):
    draw = random.Random(seed)
    kinds = [lambda: draw.random(), lambda: round(draw.random(), 1), lambda: draw.random() * 1e-6, lambda: 1 - draw.random() * 1e-9, lambda: 0.0, lambda: 1.0]
    return [(f"m{i % 2}", int(draw.random() < 0.3), draw.choice(kinds)()) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_matches_pair_counting_and_spark_ml(spark, seed):
    data = sample(seed)
    df = frame(spark, SCHEMA, data)
    found = {r["model"]: r["value"] for r in evaluate.roc_auc(df).collect()}
    for model in ("m0", "m1"):
        assert found[model] == pytest.approx(brute_auc([(y, p) for m, y, p in data if m == model]))
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    one = df.filter("model = 'm0'").selectExpr("prob as rawPrediction", "cast(label as double) as label")
    assert found["m0"] == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(one))
    pr = {r["model"]: r["value"] for r in evaluate.pr_auc(df).collect()}
    for model in ("m0", "m1"):
        assert pr[model] == pytest.approx(brute_pr_auc([(y, p) for m, y, p in data if m == model]))


def test_cells_keep_the_order(spark):
    values = sorted({p for *_, p in sample(3, 2000)} | {0.5, math.nextafter(0.5, 1), math.nextafter(0.5, 0), 5e-324, 1e-300, math.nextafter(1, 0)})
    df = spark.createDataFrame([(v,) for v in values], "p double").select("p", evaluate.score_cell(df_col()).alias("c"))
    cells = [r["c"] for r in df.orderBy("p").collect()]
    assert cells == sorted(cells)


def df_col():
    from pyspark.sql import functions as F

    return F.col("p")


def test_one_class_has_no_area(spark):
    df = frame(spark, SCHEMA, [("a", 1, 0.2), ("a", 1, 0.3), ("b", 0, 0.2), ("b", 1, 0.9)])
    assert dict(rows(evaluate.roc_auc(df))) == {"a": None, "b": 1.0}
    assert dict(rows(evaluate.youden_cutoff(df))) == {"a": None, "b": 0.9}


def test_null_group_and_no_group(spark):
    df = frame(spark, SCHEMA, [(None, 0, 0.1), (None, 1, 0.2), ("b", 1, 0.3), ("b", 0, 0.9), ("b", 1, None), ("b", None, 0.4)])
    assert dict(rows(evaluate.roc_auc(df))) == {None: 1.0, "b": 0.0}
    assert rows(evaluate.roc_auc(df, by=[])) == [(0.5,)]
    cut = evaluate.youden_cutoff(df, by=[])
    assert {(r[0], r[1]): r[2] for r in evaluate.confusion(df, cut, by=[]).collect()}


def test_youden_highest_on_ties_and_strict_decision(spark):
    df = frame(spark, SCHEMA, [("m", 1, 0.9), ("m", 0, 0.8), ("m", 1, 0.7), ("m", 0, 0.1)])
    cut = evaluate.youden_cutoff(df)
    assert rows(cut) == [("m", 0.9)]
    cells = evaluate.confusion(df, cut)
    assert rows(cells) == [("m", 0, 0, 2), ("m", 0, 1, 0), ("m", 1, 0, 2), ("m", 1, 1, 0)]
    assert rows(evaluate.f1(cells)) == [("m", 0.0)]


def test_youden_without_gain(spark):
    df = frame(spark, SCHEMA, [("m", 0, 0.9), ("m", 1, 0.1)])
    assert rows(evaluate.youden_cutoff(df)) == [("m", 1.9)]


def test_calibration_and_missing_bins(spark):
    df = frame(spark, SCHEMA, [("m", 0, 0.05), ("m", 1, 0.95), ("m", 1, 1.0), ("m", 0, 0.1)])
    assert [r["bin"] for r in evaluate.calibration(df).orderBy("bin").collect()] == [0, 9]
    totals = {r["bin"]: r["n"] for r in evaluate.bin_totals(df).collect()}
    assert totals == {b: {0: 2, 9: 2}.get(b, 0) for b in range(10)}
    assert evaluate.missing_bins(df).first()["missing"] == "15%, 25%, 35%, 45%, 55%, 65%, 75%, 85%"


def test_histogram_equals_numpy(spark):
    import numpy as np

    values = [i / 100 for i in range(101)]
    df = frame(spark, SCHEMA, [("m", 0, v) for v in values])
    found = [r["n"] for r in evaluate.histogram(df).orderBy("bin").collect()]
    assert found == list(np.histogram(values, bins=10, range=(0, 1))[0])


def test_before_onset_picks_onset_or_last(spark):
    schema = "model string, stay_id long, charttime timestamp_ntz, label int, prob double"
    steps = [("m", 1, 0, 0, 0.1), ("m", 1, 6, 1, 0.2), ("m", 1, 12, 1, 0.3), ("m", 2, 0, 0, 0.4), ("m", 2, 6, 0, 0.5)]
    df = frame(spark, schema, [(m, s, at(h), y, p) for m, s, h, y, p in steps])
    assert rows(evaluate.before_onset(df, "stay_id", "charttime"), "stay_id", "label", "prob") == [(1, 1, 0.2), (2, 0, 0.5)]


def test_log_loss_is_finite_at_the_ends(spark):
    df = frame(spark, SCHEMA, [("m", 1, 0.0), ("m", 0, 1.0), ("m", 1, 1.0)])
    assert math.isfinite(evaluate.weighted_log_loss(df, 2.0).first()["value"])


def test_curve_is_not_sorted_in_one_task(spark, capsys):
    df = spark.range(1000).selectExpr("string(id % 3) as model", "int(id % 2) as label", "id / 1000 as prob")
    evaluate.roc_auc(df).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(__group" in plan and "__slice" in plan


def test_close_scores_are_divided(spark):
    """Ten thousand scores within a millionth, and scores outside of [0, 1], do not meet in one cell."""
    df = spark.range(10_000).selectExpr("'m' as model", "int(id % 7 = 0) as label", "0.5 + id / 1e9 as prob")
    wide = spark.range(3000).selectExpr("'w' as model", "int(id % 5 = 0) as label", "id / 10 as prob")
    both = df.union(wide)
    scanned = evaluate.curve(both, cell_scores=500)
    sliced = evaluate.curve(both, cell_scores=10**9)
    assert rows(evaluate.curve_area(scanned, ["model"])) == rows(evaluate.curve_area(sliced, ["model"]))
    plan = scanned._jdf.queryExecution().optimizedPlan().toString()
    assert "__low" in plan
    points = evaluate.curve_points(scanned, ["model"]).filter("model = 'm'").orderBy(F.desc("threshold")).collect()
    assert [r["tp"] + r["fp"] for r in points] == list(range(1, 10_001))


def test_rate_of_positives_counts_scored_rows_only(spark):
    df = frame(spark, SCHEMA, [("m", 1, 0.2), ("m", 0, 0.3), ("m", 1, None)])
    assert evaluate.positive_rate(df).first()["value"] == 0.5


def test_confusion_from_a_curve(spark):
    df = frame(spark, SCHEMA, [("a", 1, 0.9), ("a", 0, 0.9), ("a", 1, 0.4), ("a", 0, 0.1), ("b", 1, 0.2), ("b", 0, None)])
    scanned = evaluate.curve(df)
    cuts = evaluate.curve_cutoff(scanned, ["model"])
    assert rows(evaluate.curve_confusion(scanned, cuts, ["model"])) == rows(evaluate.confusion(df, cuts))
