"""Forests against a plain version: every node, deep trees, split minimum, smaller forests within larger ones."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from wardline.operators import forest, models

SCHEMA = T.StructType([T.StructField("stay_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("features", VectorUDT())])


def frame(spark, x, y):
    return spark.createDataFrame([(i, None if v is None else int(v), Vectors.dense(r)) for i, (r, v) in enumerate(zip(x, y, strict=True))], SCHEMA)


def noisy(n=90, width=16, seed=3):
    """Six columns with values and ten of zeros, so that nodes often draw nothing to cut."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.random((n, width)) * rng.choice([0, 1], (n, width), p=[0.6, 0.4]), 2)
    x[:, 6:] = 0
    return x, (x[:, 0] + 0.7 * x[:, 2] + 0.4 * rng.standard_normal(n) > 0.5).astype(int)


def plain_tree(x, y, number, depth, min_split, min_leaf, taken, seed=42):
    """The same tree by trying every value of the drawn columns: {path: (n, positives, feature, cut)}."""
    tree = {}

    def grow(path, rows):
        n, p = int(rows.sum()), int(y[rows].sum())
        tree[path] = (n, p, None, None)
        if len(path) >= depth or n < max(min_split, 2 * min_leaf) or p in (0, n):
            return
        order = sorted(range(x.shape[1]), key=lambda f: hashlib.md5(f"{seed}|{number}|{path}|{f}".encode()).hexdigest())
        for tried in (order[:taken], order[taken:]):
            best = None
            for f in sorted(tried):
                for cut in np.unique(x[rows, f])[:-1]:
                    left = rows & (x[:, f] <= cut)
                    nl, pl = int(left.sum()), int(y[left].sum())
                    if min(nl, n - nl) < min_leaf:
                        continue
                    mean = lambda a, b: 2.0 * b * (a - b) / a
                    gain = round((mean(n, p) - mean(nl, pl) - mean(n - nl, p - pl)) / n, 9)
                    if best is None or gain > best[0]:
                        best = (gain, f, cut, left)
            if best:
                tree[path] = (n, p, best[1], best[2])
                grow(path + "0", best[3])
                grow(path + "1", rows & ~best[3])
                return

    grow("", np.ones(len(x), bool))
    return tree


def nodes(tree):
    return {n.path: (n.n, n.positives, n.feature, n.cut) for n in tree}


@pytest.mark.parametrize("per_job", [forest.NODES_PER_JOB, 7])
def test_every_node_equals_a_plain_version(spark, monkeypatch, per_job):
    monkeypatch.setattr(forest, "NODES_PER_JOB", per_job)
    x, y = noisy()
    model = forest.fit_forest(frame(spark, x, y), trees=5, depth=6, min_split=8, min_leaf=2)
    assert len(model.trees) == 5 and any(n.widened for tree in model.trees for n in tree)
    for i, tree in enumerate(model.trees):
        assert nodes(tree) == plain_tree(x, y, i, 6, 8, 2, 4)
    table = model.table(spark)
    assert table.filter("left IS NOT NULL AND n < 8").count() == 0 and table.agg(F.max("depth")).first()[0] <= 6


def test_small_nodes_need_no_round_each(spark, monkeypatch):
    rounds = []
    counted = forest.best_cuts
    monkeypatch.setattr(forest, "best_cuts", lambda histogram: rounds.append(1) or counted(histogram))
    x, y = noisy()
    df = frame(spark, x, y)
    whole = forest.fit_forest(df, trees=5, depth=None, min_split=2, bootstrap=True)
    assert not rounds and whole.depth() > 4
    # nodes of more than 20 rows by rounds, the others in groups: the same trees
    for group_values, columns in ((20 * 16, None), (20 * 16, 3), (1, None)):
        monkeypatch.setattr(forest, "GROUP_VALUES", group_values)
        parts = forest.fit_forest(df, trees=5, depth=None, min_split=2, bootstrap=True, columns=columns)
        monkeypatch.setattr(forest, "GROUP_VALUES", 1 << 27)
        monkeypatch.setattr(forest, "GROUP_CELLS", 200)
        again = forest.fit_forest(df, trees=5, depth=None, min_split=2, bootstrap=True, columns=columns)
        monkeypatch.setattr(forest, "GROUP_CELLS", 1 << 23)
        one = whole if columns is None else forest.fit_forest(df, trees=5, depth=None, min_split=2, bootstrap=True, columns=columns)
        for tree, *others in zip(one.trees, parts.trees, again.trees, strict=True):
            for other in others:
                assert nodes(other) == nodes(tree) and {n.path: n.gain for n in other} == {n.path: n.gain for n in tree}
    assert rounds


def test_rows_with_missing_values_grow(spark):
    rows = [(i, i % 2, v) for i, v in enumerate([[1.0, 2.0], [3.0, None], [1.0], None, [2.0, 5.0], [2.0, 1.0]] * 5)]
    df = spark.createDataFrame(rows, "stay_id bigint, label int, features array<double>")
    model = forest.fit_forest(df, trees=3, depth=4, min_split=2)
    assert all(t[0].n == 30 and t[0].positives == 15 for t in model.trees)


def test_trees_deeper_than_thirty(spark):
    # every cut sets one more row of a staircase apart
    x = np.array([[float(i)] for i in range(36)])
    y = np.array([i % 2 for i in range(36)])
    model = forest.fit_forest(frame(spark, x, y), trees=1, depth=None, min_split=2, min_leaf=1)
    assert nodes(model.trees[0]) == plain_tree(x, y, 0, 10**6, 2, 1, 1)
    assert model.depth() > models.MAX_TREE_DEPTH
    prob = forest.score(model, frame(spark, x, y), "forest", ["stay_id"]).collect()
    assert all(r["prob"] == r["label"] for r in prob)


def test_smaller_forests_are_parts_of_a_larger_one(spark):
    x, y = noisy()
    df = frame(spark, x, y)
    large = forest.fit_forest(df, trees=6, depth=None, min_split=2, bootstrap=True)
    small = forest.fit_forest(df, trees=4, depth=3, min_split=15, bootstrap=True)
    a = forest.score(large, df, "f", ["stay_id"], trees=4, depth=3, min_split=15).collect()
    b = forest.score(small, df, "f", ["stay_id"]).collect()
    assert sorted(a) == sorted(b)
    # bootstrap: trees see other rows, about as many
    roots = [t[0].n for t in large.trees]
    assert len(set(roots)) > 1 and all(60 < n < 120 for n in roots)


def test_search_equals_separate_fits(spark):
    x, y = noisy(70)
    df = frame(spark, x, y)
    choices = [
        {"trees": 3, "depth": 2, "min_split": 2, "min_leaf": 2, "bootstrap": False},
        {"trees": 5, "depth": None, "min_split": 10, "min_leaf": 2, "bootstrap": False},
        {"trees": 4, "depth": 4, "min_split": 5, "min_leaf": 4, "bootstrap": True},
    ]
    best, found = forest.search_forest(df, choices, "stay_id", folds=2)
    values = [r["value"] for r in found.orderBy("run").collect()]
    parted = models.with_folds(df, "stay_id", 2)
    for choice, value in zip(choices, values, strict=True):
        expected = 0.0
        for fold in range(2):
            model = forest.fit_forest(parted.filter(F.col("fold") != fold), **choice)
            scored = forest.score(model, parted.filter(F.col("fold") == fold), "f", [])
            expected += scored.agg(F.avg(((F.col("prob") > 0.5).cast("int") == F.col("label")).cast("double"))).first()[0] / 2
        assert value == pytest.approx(expected)
    assert best == choices[values.index(max(values))]


def test_edges(spark):
    empty = frame(spark, np.zeros((0, 2)), [])
    assert forest.fit_forest(empty, trees=2).trees == []
    assert forest.search_forest(empty, [{"trees": 2}], "stay_id")[1].collect()[0]["value"] == 0
    one_class = frame(spark, np.array([[0.0, 1.0]] * 30 + [[1.0, 0.0]]), [1] * 30 + [None])
    model = forest.fit_forest(one_class, trees=2)
    assert [nodes(t) for t in model.trees] == [{"": (30, 30, None, None)}] * 2
    scored = forest.score(model, one_class, "f", ["stay_id"]).collect()
    assert len(scored) == 31 and {r["prob"] for r in scored} == {1.0}
    # the same values everywhere: nothing to cut
    same = frame(spark, np.ones((20, 3)), [0, 1] * 10)
    assert [len(t) for t in forest.fit_forest(same, trees=2).trees] == [1, 1]
    none = forest.score(forest.Forest(), same, "f", ["stay_id"]).first()
    assert none["prob"] is None


def test_nodes_stay_out_of_the_driver(spark, monkeypatch):
    x, y = noisy(200)
    df = frame(spark, x, y)
    monkeypatch.setattr(forest.Forest, "trees", property(lambda self: pytest.fail("all nodes in the driver")))
    model = forest.fit_forest(df, trees=6, depth=None, min_split=2)
    assert all(len(tree) == 1 for tree in model.tops) and model.size() > 100
    table = model.table(spark)
    assert table.count() == model.size() and table.agg(F.max("depth")).first()[0] == model.depth()
    below = table.select("tree", F.explode(F.array("left", "right")).alias("node")).dropna()
    assert table.join(below, ["tree", "node"]).count() == below.count() == model.size() - 6
    # tasks of some trees and some rows each: the same sums
    whole = sorted(forest.score(model, df, "f", ["stay_id"]).collect())
    monkeypatch.setattr(forest, "SCORE_VALUES", 50 * 16)
    monkeypatch.setattr(forest, "BLOB", 7 * 16)
    parts = sorted(forest.score(model, df, "f", ["stay_id"]).collect())
    assert [r["prob"] for r in parts] == pytest.approx([r["prob"] for r in whole]) and len({r["prob"] for r in whole}) > 5


def pruned_as_spark(tree):
    """Nodes (path: n, positives, feature, cut) below which all leaves are of one class are leaves."""
    out, says = dict(tree), lambda p: 2 * tree[p][1] > tree[p][0]
    for path in sorted(tree, key=len, reverse=True):
        low, high = path + "0", path + "1"
        if low in out and out[low][2] is None and out[high][2] is None and says(low) == says(high):
            del out[low], out[high]
            out[path] = (*tree[path][:2], None, None)
    return out


def test_two_classes_grow_by_the_rules_of_spark(spark, monkeypatch):
    x, y = noisy(300)
    df = frame(spark, x, y)
    grown = lambda: [nodes(t) for t in forest.grow(df, [forest.Plan(4, 30, 2, 2, False)], "stay_id", as_spark=True).trees]
    one = grown()
    for bound in (40 * 16, 1):  # nodes of more rows by rounds, the others in groups: the same trees
        monkeypatch.setattr(forest, "GROUP_VALUES", bound)
        assert grown() == one
    monkeypatch.undo()
    # every node holds the rows of its path
    raw = {path: node for tree in one for path, node in tree.items()}
    assert max(map(len, raw)) > 4 and all(n >= 2 for n, _, _, _ in raw.values())
    for tree in one:
        assert pruned_as_spark(tree) == tree and tree[""][:2] == (300, int(y.sum()))
        for path, (n, p, feature, cut) in tree.items():
            mine = np.ones(300, bool)
            for depth, side in enumerate(path):
                _, _, f, c = tree[path[:depth]]
                mine &= (x[:, f] <= c) == (side == "0")
            assert (int(mine.sum()), int(y[mine].sum())) == (n, p)
            if feature is not None:
                left = mine & (x[:, feature] <= cut)
                assert 2 <= left.sum() <= n - 2 and tree[path + "0"][0] == left.sum()


def test_model_of_two_classes_is_stored_as_sparks(spark, tmp_path):
    x, y = noisy(200)
    df = frame(spark, x, y)
    fitted = models.fit_forest(df, trees=8, depth=6)
    model = fitted.stages[0]
    assert isinstance(model, forest.ForestModel) and model.getNumTrees == len(model.trees) == 8 and max(t.depth for t in model.trees) <= 6
    told = lambda m: {r.stay_id: (r.raw, r.probability[1], r.prediction) for r in m.transform(df).select("stay_id", vector_to_array("rawPrediction").alias("raw"), "probability", "prediction").collect()}
    path = f"file://{tmp_path}/model"
    models.save_model(fitted, path)
    loaded = models.load_model(path)
    assert isinstance(loaded.stages[0], RandomForestClassificationModel)
    mine, theirs = told(fitted), told(loaded)
    assert mine.keys() == theirs.keys() and len(mine) == 200
    for key, (raw, prob, prediction) in mine.items():
        assert raw == pytest.approx(theirs[key][0]) and prob == pytest.approx(theirs[key][1]) and prediction == theirs[key][2]
    assert model.featureImportances.toArray() == pytest.approx(loaded.stages[0].featureImportances.toArray(), abs=1e-6)
    assert [t.numNodes for t in loaded.stages[0].trees] == [t.numNodes for t in model.trees]
    # a forest of Spark's tells about the same rows apart
    sparks = told(models.random_forest(trees=8, depth=6).fit(df))
    assert np.mean([v[2] == sparks[key][2] for key, v in mine.items()]) > 0.8
    # with bootstrap, trees see other rows, about as many
    drawn = models.fit_forest(df, trees=5, depth=None, bootstrap=True).stages[0]
    roots = [r["n"] for r in drawn.forest.table(spark).filter("depth = 0").collect()]
    assert len(set(roots)) > 1 and all(140 < n < 260 for n in roots)
    with pytest.raises(ValueError, match="rows with a label"):
        models.fit_forest(df.limit(0), trees=2)
