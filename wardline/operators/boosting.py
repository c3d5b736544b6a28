"""Second-order boosted trees, their searches, and attributions along the paths of trees.

Values are binned once by quantiles. A level of a tree is one aggregation: gradients and Hessians are summed
per (node, feature, bin), with partial sums in the tasks, and a running sum over the bins gives the gain of
every cut. The driver gets one row per node and keeps the tree, which its depth bounds; rows never
move. Node ids are those of a heap: 1 is the root, 2n and 2n + 1 are the children of n.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardline.operators.models import BOOSTED, best_rounds, class_ratio, metric_rows, save_model, with_folds
from wardline.sources.tables import cut_lineage, shared_folder

MAX_BINS = 256
# Summed loss reduction below which a split is noise.
_LEAST_GAIN = 1e-6
# Trees after which the margins are stored, so that plans stay short.
_REFRESH = 5
_NODE = "struct<feature:int,cut:double,left:int,right:int,value:double,expected:double,cover:double,gain:double>"
_NODES = f"array<map<int,{_NODE}>>"


@dataclass(frozen=True)
class Node:
    """An inner node sends values up to ``cut`` left; a leaf has no feature and adds ``value``."""

    feature: int | None
    cut: float | None
    left: int | None
    right: int | None
    value: float
    expected: float
    cover: float
    gain: float | None


@dataclass
class Trees:
    """An additive model: ``base`` plus the leaf values of all trees; ``losses`` and ``accuracies`` by round on held-out rows."""

    base: float
    trees: list[dict[int, Node]]
    losses: list[float] = field(default_factory=list)
    accuracies: list[float] = field(default_factory=list)

    def first(self, rounds: int) -> Trees:
        """The model after so many rounds: later trees do not change earlier ones."""
        return Trees(self.base, self.trees[:rounds], self.losses[:rounds], self.accuracies[:rounds])

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node: (tree, node, feature, cut, left, right, value, expected, cover, gain)."""
        rows = [(t, n, *vars(x).values()) for t, tree in enumerate(self.trees) for n, x in tree.items()]
        schema = "tree int, node int, feature int, cut double, left int, right int, value double, expected double, cover double, gain double"
        return spark.createDataFrame(rows, schema)

    def column(self, spark: SparkSession) -> Column:
        """All nodes as one value (an array of maps), which tasks get once."""
        rows = [[{n: tuple(vars(x).values()) for n, x in tree.items()} for tree in self.trees]]
        return spark.createDataFrame([tuple(rows)], f"t {_NODES}").scalar()


def _next(tree: Column, node: Column, x: Column) -> Column:
    here = F.try_element_at(tree, node)
    return F.when(here["left"].isNull(), node).otherwise(F.when(F.get(x, here["feature"]) <= here["cut"], here["left"]).otherwise(here["right"]))


def leaf_of(tree: Column, x: Column, depth: int, root: int = 1) -> Column:
    """Leaf of a row's values ``x`` (an array) in one tree."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(root), lambda node, _: _next(tree, node, x))


def margin(trees: Column, x: Column, depth: int, base: float, root: int = 1) -> Column:
    return F.aggregate(trees, F.lit(float(base)), lambda a, t: a + F.try_element_at(t, leaf_of(t, x, depth, root))["value"])


def path_terms(trees: Column, x: Column, depth: int, root: int = 1) -> Column:
    """(feature, change of the expected value) of every step down every tree."""

    def of_tree(t: Column) -> Column:
        steps = F.sequence(F.lit(1), F.lit(max(1, depth)))
        path = F.aggregate(steps, F.array(F.lit(root)), lambda p, _: F.concat(p, F.array(_next(t, F.element_at(p, -1), x))))
        expected = lambda n: F.try_element_at(t, n)["expected"]
        moved = F.transform(steps, lambda i: F.struct(F.try_element_at(t, F.get(path, i - 1))["feature"].alias("feature"), (expected(F.get(path, i)) - expected(F.get(path, i - 1))).alias("change")))
        return F.filter(moved, lambda s: s["feature"].isNotNull())

    return F.flatten(F.transform(trees, of_tree))


def quantile_cuts(cells: DataFrame, max_bins: int = MAX_BINS) -> DataFrame:
    """Ascending cuts per feature from (feature, value): all values if there are no more than ``max_bins`` rows, else quantiles."""
    shares = F.array(*[F.lit(k / (max_bins - 1)) for k in range(max_bins)])
    return cells.groupBy("feature").agg(F.array_sort(F.array_distinct(F.percentile_approx("value", shares, F.lit(100 * max_bins)))).alias("cuts"))


def gains(histogram: DataFrame, min_child: float, reg: float) -> DataFrame:
    """Per node its sums and best cut, from (node, feature, bin, g, h).

    The gain of a cut is what it takes off twice the loss: the sum of g * g / (h + reg) of both sides less that of the
    whole. Of equal gains, to nine digits, the first feature and lowest cut count.
    """
    upto = Window.partitionBy("node", "feature").orderBy("bin")
    whole = Window.partitionBy("node", "feature")
    sums = histogram.select(
        "node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"), F.sum("g").over(whole).alias("gt"), F.sum("h").over(whole).alias("ht")
    )
    part = lambda g, h: g * g / (h + F.lit(float(reg)))
    gr, hr = F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")
    gain = part(F.col("gl"), F.col("hl")) + part(gr, hr) - part(F.col("gt"), F.col("ht"))
    fits = (F.col("hl") >= min_child) & (hr >= min_child) & (gain > _LEAST_GAIN)
    best = F.max(F.when(fits, F.struct(F.round(gain, 9).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl")))
    return sums.groupBy("node").agg(F.max("gt").alias("g"), F.max("ht").alias("h"), best.alias("best"))


def pruned(tree: dict[int, Node], gamma: float) -> dict[int, Node]:
    """Splits that gain less than ``gamma`` and have two leaves become leaves, from the bottom up."""
    out = dict(tree)
    for n in sorted(out, reverse=True):
        node = out[n]
        if node.left is not None and out[node.left].left is None and out[node.right].left is None and node.gain < gamma:
            del out[node.left], out[node.right]
            out[n] = Node(None, None, None, None, node.value, node.value, node.cover, None)
    return out


def with_expectations(tree: dict[int, Node], root: int = 1) -> dict[int, Node]:
    """Expected value of every node: that of a leaf, or the mean of the children by cover."""
    out = dict(tree)

    def visit(n: int) -> float:
        stack = [(n, False)]
        while stack:
            at, done = stack.pop()
            node = out[at]
            if node.left is None:
                out[at] = Node(**(vars(node) | {"expected": node.value}))
            elif not done:
                stack += [(at, True), (node.left, False), (node.right, False)]
            else:
                a, b = out[node.left], out[node.right]
                mean = (a.expected * a.cover + b.expected * b.cover) / (a.cover + b.cover)
                out[at] = Node(**(vars(node) | {"expected": mean}))
        return out[n].expected

    visit(root)
    return out


def _sampled(key: Column, share: float, seed: int, tree: int) -> Column:
    if share >= 1:
        return F.lit(True)
    text = F.concat_ws("|", key.cast("string"), F.lit(seed), F.lit(tree))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") < F.lit(share * 2.0**32)


def fit_trees(
    train: DataFrame, valid: DataFrame | None = None, key: str = "stay_id", label: str = "label", vector: str = "features",
    learning_rate: float = 0.1, trees: int = 70, depth: int = 7, min_child: float = 3, gamma: float = 0.5, rows: float = 0.8,
    columns: float = 0.8, reg: float = 1.0, seed: int = 42, scheme: str | None = "positive", patience: int = 40, max_bins: int = MAX_BINS,
    all_rounds: bool = False,
) -> Trees:
    """Boosted trees for the logistic loss by gradients and Hessians.

    ``min_child`` bounds the summed Hessian of a child, ``gamma`` the summed gain of a split (checked from the
    bottom up), ``rows`` and ``columns`` are the shares drawn per tree, the former by a hash of ``key``. With
    ``valid`` rows the rounds end where their loss has not fallen for ``patience`` rounds, and the model keeps the
    rounds up to the lowest loss (``all_rounds``: everything that was grown). Nothing is grown twice. Rows without label
    are left out; a table without rows gives a model without trees.
    """
    spark = train.sparkSession
    ratio = float(class_ratio(train, label).first()[0] or 1.0) if scheme == "positive" else 1.0
    x = vector_to_array(vector) if dict(train.dtypes)[vector] == "vector" else F.col(vector)
    told = lambda df, held: df.filter(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"), x.alias("x"), F.lit(held).alias("held"))
    raw = cut_lineage(told(train, False) if valid is None else told(train, False).unionByName(told(valid, True)))
    width = raw.agg(F.max(F.size("x"))).first()[0]
    model = Trees(0.0, [])
    if not width:
        return model
    cuts = cut_lineage(quantile_cuts(raw.filter("not held").select(F.posexplode("x").alias("feature", "value")), max_bins))
    edges = {f: list(c) for f, c in cuts.collect()}  # at most max_bins numbers per feature
    known = cuts.agg(F.map_from_entries(F.collect_list(F.struct("feature", "cuts")))).scalar()
    binned = F.transform("x", lambda v, f: F.size(F.filter(F.try_element_at(F.col("c"), f), lambda c: c < v)))
    weight = F.when(F.col("y") == 1, F.lit(ratio)).otherwise(F.lit(1.0))
    state = cut_lineage(raw.withColumn("c", known).select("key", "y", "held", weight.alias("w"), "x", binned.alias("bins"), F.lit(0.0).alias("m")))
    stored = 0
    for number in range(trees):
        drawn = sorted(random.Random(f"{seed}-{number}").sample(range(width), max(1, math.ceil(columns * width))))
        now = state.withColumn("t", Trees(0.0, model.trees[stored:]).column(spark)) if number > stored else state.withColumn("t", F.lit(None).cast(_NODES))
        margin_now = F.coalesce(margin(F.col("t"), F.col("x"), depth, 0.0), F.lit(0.0)) + F.col("m")
        p = 1 / (1 + F.exp(-margin_now))
        slopes = now.filter(~F.col("held") & _sampled(F.col("key"), rows, seed, number)).withColumn("p", p)
        slopes = slopes.select("x", "bins", (F.col("w") * (F.col("p") - F.col("y"))).alias("g"), F.greatest(F.col("w") * F.col("p") * (1 - F.col("p")), F.lit(1e-16)).alias("h"))
        tree = _grow(slopes, spark, edges, drawn, depth, min_child, reg, learning_rate)
        model.trees.append(with_expectations(pruned(tree, gamma)))
        if valid is not None:
            after = state.filter("held").withColumn("t", Trees(0.0, model.trees[stored:]).column(spark))
            z = margin(F.col("t"), F.col("x"), depth, 0.0) + F.col("m")
            loss = F.avg(F.greatest(z, F.lit(0.0)) - z * F.col("y") + F.log1p(F.exp(-F.abs(z))))
            found = after.agg(loss, F.avg(((z > 0).cast("int") == F.col("y")).cast("double"))).first()
            model.losses.append(math.inf if found[0] is None else found[0])
            model.accuracies.append(0.0 if found[1] is None else found[1])
            if best_rounds(model.losses, patience) + patience <= len(model.losses):
                break
        if len(model.trees) - stored == _REFRESH:
            kept = state.withColumn("t", Trees(0.0, model.trees[stored:]).column(spark))
            state = cut_lineage(kept.withColumn("m", margin(F.col("t"), F.col("x"), depth, 0.0) + F.col("m")).drop("t"))
            stored = len(model.trees)
    return model if valid is None or all_rounds else model.first(best_rounds(model.losses, patience))


def _grow(
    slopes: DataFrame, spark: SparkSession, edges: dict[int, list[float]], drawn: list[int], depth: int, min_child: float, reg: float, rate: float
) -> dict[int, Node]:
    tree: dict[int, Node] = {}
    leaf = lambda g, h: Node(None, None, None, None, -g / (h + reg) * rate, 0.0, h, None)
    for level in range(depth):
        if level:
            open_ = [n for n in tree if n >= 1 << level]
            if not open_:
                break
            held = slopes.withColumn("t", Trees(0.0, [tree]).column(spark))
            placed = held.withColumn("node", leaf_of(F.col("t")[0], F.col("x"), level)).filter(F.col("node").isin(open_))
        else:
            placed = slopes.withColumn("node", F.lit(1))
        cells = placed.select("node", "g", "h", F.posexplode("bins").alias("feature", "bin")).filter(F.col("feature").isin(drawn))
        histogram = cells.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        grown = False
        for node, g, h, best in gains(histogram, min_child, reg).collect():  # at most a row per node
            if not level:
                tree[1] = leaf(g, h)
            if best is None:
                continue
            grown = True
            f, b = -best["f"], -best["b"]
            tree[node] = Node(f, edges[f][b], 2 * node, 2 * node + 1, tree[node].value, 0.0, h, best["gain"])
            tree[2 * node], tree[2 * node + 1] = leaf(best["gl"], best["hl"]), leaf(g - best["gl"], h - best["hl"])
        if not grown:
            break
    return tree or {1: Node(None, None, None, None, 0.0, 0.0, 0.0, None)}


def _depth(model: Trees) -> int:
    return max((n.bit_length() - 1 for t in model.trees for n in t), default=0)


def score(model: Trees, df: DataFrame, name: str, keep: list[str], vector: str = "features") -> DataFrame:
    """Prediction table of a boosted model: the kept columns, model name, label, probability and margin."""
    x = vector_to_array(vector) if dict(df.dtypes)[vector] == "vector" else F.col(vector)
    told = df.select(*keep, "label", x.alias("__x")).withColumn("__t", model.column(df.sparkSession))
    scored = told.withColumn("margin", margin(F.col("__t"), F.col("__x"), _depth(model), model.base))
    return scored.select(*keep, F.lit(name).alias("model"), F.col("label").cast("int").alias("label"), (1 / (1 + F.exp(-F.col("margin")))).alias("prob"), "margin")


def attributions(model: Trees, df: DataFrame, keep: list[str], vector: str = "features", depth: int | None = None, root: int = 1) -> DataFrame:
    """(kept columns, feature, value) per row: how the expected value changes at the splits of each feature.

    ``keep`` has to tell the rows apart. What no feature explains is a row with the feature null: the base and the expected
    values of all roots. The values of a row add up to its margin.
    """
    x = vector_to_array(vector) if dict(df.dtypes)[vector] == "vector" else F.col(vector)
    bias = model.base + sum(t[root].expected for t in model.trees)
    told = df.select(*keep, x.alias("__x")).withColumn("__t", model.column(df.sparkSession))
    start = F.struct(F.lit(None).cast("int").alias("feature"), F.lit(float(bias)).alias("change"))
    terms = F.concat(F.array(start), path_terms(F.col("__t"), F.col("__x"), _depth(model) if depth is None else depth, root))
    return told.select(*keep, F.inline(terms)).groupBy(*keep, "feature").agg(F.sum("change").alias("value"))


def forest_nodes(model: Model) -> tuple[Trees, int]:
    """A fitted forest as trees whose leaves hold the share of class 1, divided by their number; and its depth.

    Read from the stored model, whose node table has any depth; the root of each tree is node 0.
    """
    spark, path = SparkSession.getActiveSession(), shared_folder(SparkSession.getActiveSession())
    save_model(model, path)
    count = model.getNumTrees
    trees: list[dict[int, Node]] = [{} for _ in range(count)]
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toLocalIterator():
        cover = sum(row["impurityStats"])
        value = row["impurityStats"][1] / cover / count
        inner = row["leftChild"] >= 0
        cut = row["split"]["leftCategoriesOrThreshold"][0] if inner else None
        trees[row["treeID"]][row["id"]] = Node(
            row["split"]["featureIndex"] if inner else None, cut, row["leftChild"] if inner else None, row["rightChild"] if inner else None,
            value, 0.0, cover, row["gain"] if inner else None,
        )
    return Trees(0.0, [with_expectations(t, 0) for t in trees]), max(t.depth for t in model.trees)


def search_trees(
    train: DataFrame, choices: list[dict], key: str, folds: int = 5, metric: str = "accuracy", **fixed
) -> tuple[dict, DataFrame]:
    """Cross-validated search over boosted trees: the best choice, and one (run, params, metric, value) row per choice.

    Choices that differ in the number of trees alone share one fit per fold: the model after so many rounds is the
    beginning of the longest one, and the held-out measures are known after every round. ``metric`` is accuracy or
    loss; an entity is in one fold with all its rows.
    """
    parted = cut_lineage(with_folds(train, key, folds))
    settings: dict[tuple, list[int]] = {}
    for i, choice in enumerate(choices):
        settings.setdefault(tuple(sorted((k, v) for k, v in choice.items() if k != "trees")), []).append(i)
    totals = [0.0] * len(choices)
    for fold in range(folds):
        rest, held = parted.filter(F.col("fold") != fold), parted.filter(F.col("fold") == fold)
        for setting, runs in settings.items():
            counts = [choices[i].get("trees", BOOSTED["trees"]) for i in runs]
            longest = {"trees": max(counts), "patience": max(counts), "all_rounds": True}
            model = fit_trees(rest, held, key=key, **(fixed | dict(setting) | longest))
            measured = model.accuracies if metric == "accuracy" else model.losses
            for i, count in zip(runs, counts, strict=True):
                totals[i] += measured[count - 1] / folds
    best = (max if metric == "accuracy" else min)(range(len(choices)), key=totals.__getitem__)
    return choices[best], metric_rows(train, choices, metric, totals)
