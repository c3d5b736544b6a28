"""Second-order boosting against a plain version, attributions along paths, nested search."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from wardline.operators import boosting, models


def table(spark, n=80, width=4, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.random((n, width)) * rng.choice([0, 1], (n, width), p=[0.4, 0.6]), 2)
    y = (x[:, 0] + 0.7 * x[:, 2] + 0.3 * rng.standard_normal(n) > 0.7).astype(int)
    rows = [(i, int(y[i]), Vectors.dense(x[i])) for i in range(n)]
    schema = T.StructType([T.StructField("stay_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("features", VectorUDT())])
    return spark.createDataFrame(rows, schema).cache(), x, y


def plain_tree(x, g, h, depth, min_child, reg, rate, gamma):
    """The same tree grown by trying every value of every column."""
    tree = {}

    def grow(n, rows, level):
        gt, ht = g[rows].sum(), h[rows].sum()
        node = tree[n] = {"cover": ht, "value": -gt / (ht + reg) * rate, "gain": None, "feature": None, "cut": None}
        best = None
        for f in range(x.shape[1]) if level < depth else ():
            for cut in np.unique(x[rows, f]):
                left = rows & (x[:, f] <= cut)
                gl, hl = g[left].sum(), h[left].sum()
                if hl >= min_child and ht - hl >= min_child:
                    gain = round(gl**2 / (hl + reg) + (gt - gl) ** 2 / (ht - hl + reg) - gt**2 / (ht + reg), 9)
                    if gain > 1e-6 and (best is None or gain > best[0]):
                        best = (gain, f, cut, left)
        if best:
            node["gain"], node["feature"], node["cut"] = best[:3]
            grow(2 * n, best[3], level + 1)
            grow(2 * n + 1, rows & ~best[3], level + 1)
            if tree[2 * n]["gain"] is None and tree[2 * n + 1]["gain"] is None and best[0] < gamma:
                del tree[2 * n], tree[2 * n + 1]
                node["gain"] = node["feature"] = node["cut"] = None

    grow(1, np.ones(len(x), bool), 0)
    return tree


def walk(tree, row):
    n = 1
    while tree[n]["gain"] is not None:
        n = 2 * n + (row[tree[n]["feature"]] > tree[n]["cut"])
    return tree[n]["value"]


@pytest.fixture(scope="module")
def fitted(spark):
    df, x, y = table(spark)
    options = {"trees": 7, "depth": 3, "min_child": 1.5, "gamma": 0.4, "rows": 1.0, "columns": 1.0, "learning_rate": 0.3}
    return df, x, y, boosting.fit_trees(df, key="stay_id", **options)


def test_trees_equal_a_plain_version(fitted):
    _, x, y, model = fitted
    weight = np.where(y == 1, round((y == 0).sum() / (y == 1).sum(), 1), 1.0)
    margin = np.zeros(len(y))
    assert len(model.trees) == 7 and any(len(t) > 3 for t in model.trees)
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        expected = plain_tree(x, weight * (p - y), weight * p * (1 - p), 3, 1.5, 1.0, 0.3, 0.4)
        assert tree.keys() == expected.keys()
        for n, node in tree.items():
            assert (node.feature, node.cut) == (expected[n]["feature"], expected[n]["cut"])
            assert node.cover == pytest.approx(expected[n]["cover"]) and node.gain == (expected[n]["gain"] and pytest.approx(expected[n]["gain"]))
            if node.left is None:
                assert node.value == pytest.approx(expected[n]["value"])
        margin += [walk(expected, row) for row in x]


def test_scores_and_attributions_add_up(spark, fitted):
    df, x, _, model = fitted
    scored = {r.stay_id: r for r in boosting.score(model, df, "m", ["stay_id"]).collect()}
    told = boosting.attributions(model, df, ["stay_id"]).collect()
    for i in range(len(x)):
        mine = {r.feature: r.value for r in told if r.stay_id == i}
        assert sum(mine.values()) == pytest.approx(scored[i].margin)
        assert scored[i].prob == pytest.approx(1 / (1 + math.exp(-scored[i].margin)))
    assert {r.feature for r in told} > {None, 0, 2}
    nodes = model.table(spark)
    assert nodes.count() == sum(map(len, model.trees))
    root = nodes.filter("node = 1 and tree = 0").first()
    leaves = nodes.filter("tree = 0 and left is null").collect()
    assert root.expected == pytest.approx(sum(r.value * r.cover for r in leaves) / sum(r.cover for r in leaves))


def test_splits_are_pruned_from_the_bottom():
    leaf = lambda v, c: boosting.Node(None, None, None, None, v, 0.0, c, None)
    inner = lambda n, gain: boosting.Node(0, 0.5, 2 * n, 2 * n + 1, 9.0, 0.0, 2.0, gain)
    tree = {1: inner(1, 0.2), 2: inner(2, 0.1), 3: leaf(1, 1), 4: leaf(2, 1), 5: inner(5, 3.0), 10: leaf(3, 1), 11: leaf(4, 1)}
    assert boosting.pruned(tree, 0.15) == tree  # a kept split keeps what is above it
    assert boosting.pruned(tree | {5: leaf(3, 1)} | {}, 0.15).keys() == {1, 2, 3, 10, 11}


def test_rounds_end_by_the_held_out_loss(spark):
    df, _, _ = table(spark, 120, seed=4)
    train, valid = df.filter("stay_id % 3 > 0"), df.filter("stay_id % 3 = 0")
    options = {"key": "stay_id", "depth": 3, "min_child": 0.1, "gamma": 0, "learning_rate": 0.8}
    whole = boosting.fit_trees(train, valid, trees=14, patience=99, all_rounds=True, **options)
    short = boosting.fit_trees(train, valid, trees=14, patience=3, **options)
    rounds = models.best_rounds(whole.losses, 3)
    assert len(whole.trees) == 14 and short.trees == whole.trees[:rounds] and rounds < 14
    p = np.array([r.prob for r in boosting.score(short, valid, "m", ["stay_id"]).orderBy("stay_id").collect()])
    y = np.array([r.label for r in valid.orderBy("stay_id").collect()])
    assert -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() == pytest.approx(short.losses[-1])


def test_search_shares_fits_among_numbers_of_trees(spark):
    df, _, _ = table(spark, 60, seed=6)
    grid = {"trees": [1, 3, 4], "depth": [1, 2], "learning_rate": [0.5]}
    choices = models.sample_grid(grid, None)
    fixed = {"min_child": 0.5, "gamma": 0.0}
    best, metrics = boosting.search_trees(df, choices, "stay_id", folds=2, **fixed)
    found = {r.run: r.value for r in metrics.collect()}
    parted = models.with_folds(df, "stay_id", 2)
    for i in random.Random(1).sample(range(len(choices)), 3):
        value = 0.0
        for fold in range(2):
            model = boosting.fit_trees(parted.filter(F.col("fold") != fold), key="stay_id", **fixed, **choices[i])
            scored = boosting.score(model, parted.filter(F.col("fold") == fold), "m", [])
            value += scored.agg(F.avg(((F.col("margin") > 0).cast("int") == F.col("label")).cast("double"))).first()[0] / 2
        assert found[i] == pytest.approx(value)
    assert found[choices.index(best)] == max(found.values())


def test_forest_attributions_add_up(spark):
    df, _, _ = table(spark, 90, seed=8)
    fitted = models.fit_forest(df, trees=6, depth=5, min_leaf=2)
    trees, depth = boosting.forest_nodes(fitted.stages[0])
    expected = {r.stay_id: r.prob for r in models.predict(fitted, df, "f", ["stay_id"]).collect()}
    told = boosting.attributions(trees, df, ["stay_id"], depth=depth, root=0).groupBy("stay_id").agg(F.sum("value").alias("v"))
    assert {r.stay_id: pytest.approx(r.v) for r in told.collect()} == expected


def test_little_to_learn_from(spark):
    df, _, _ = table(spark, 10)
    one_class = boosting.fit_trees(df.withColumn("label", F.lit(0)), key="stay_id", trees=2)
    assert all(len(t) == 1 for t in one_class.trees)
    assert boosting.attributions(one_class, df, ["stay_id"]).filter("feature is not null").count() == 0
    assert boosting.fit_trees(df.limit(0), key="stay_id", trees=2).trees == []
