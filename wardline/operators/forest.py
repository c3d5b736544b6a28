"""Forests of any depth with a split minimum, and their search.

All trees grow together: a round is one aggregation that counts rows and positives per (tree, open node, feature,
bin), with partial sums in the tasks, and a running sum over the bins gives the impurity that every cut takes
off. A row keeps the place of its open node in every tree and does not move while that node is large. The driver gets
one row per open node and keeps these large nodes; the tables that tasks get hold
``NODES_PER_JOB`` nodes at most. Nodes of few enough rows are dealt out in groups with their rows, and a task grows
those of a group to their ends, level by level; a group is bounded by ``GROUP_VALUES`` and ``GROUP_CELLS``. What the
groups grow stays a stored table, and rows are scored by tasks that get some of the trees each: nearly all nodes are
in small subtrees, so the driver's part does not grow with the forest.

What is drawn for a node depends on the seed, the tree and the path to the node alone. So a forest holds all
smaller ones: fewer trees, less depth and a larger split minimum are beginnings of the same trees, and a search
fits once for all of them.
"""

from __future__ import annotations

import json
import math
import time
from dataclasses import dataclass, field, replace

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.ml.util import MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardline.operators.boosting import MAX_BINS, quantile_cuts
from wardline.operators.models import metric_rows, with_folds
from wardline.sources.tables import cut_lineage

NODES_PER_JOB = 20_000
# Rounds after which the places of the rows are stored, so that plans stay short.
_REFRESH = 4
# Values (rows times features) and tried values of a node up to which it is grown to its end within a group, and groups at least.
GROUP_VALUES = 1 << 27
GROUP_CELLS = 1 << 23
GROUPS = 24
# Values and nodes that a task of a scoring gets, and bytes of rows that are sent as one.
SCORE_VALUES = 1 << 26
SCORE_NODES = 1 << 22
BLOB = 1 << 20
# Values that a task looks up at once while it grows a node.
BLOCK = 1 << 16
_DEALT = "bundle int, y binary, bins binary, rows binary, slots binary, times binary"
_GROWN = "slot int, node int, depth int, n bigint, positives bigint, feature int, bin int, cut double, lower int, gain double, widened boolean"
_NODES = "tree int, node int, depth int, n bigint, positives bigint, feature int, bin int, cut double, left int, right int, gain double"
# Parameters of the published forest and its search grid.
FOREST = {"trees": 700, "depth": 40, "min_split": 10, "min_leaf": 2, "bootstrap": False}
FOREST_GRID = {
    "trees": [100, 200, 300, 400, 500, 600, 700, 800, 900, 1000],
    "depth": [10, 15, 21, 26, 32, 37, 43, 48, 54, 60, None],
    "min_split": [2, 5, 10],
    "min_leaf": [2, 4],
    "bootstrap": [True, False],
}
_SPLITS = "array<struct<feature:int,bin:int,left:int,right:int>>"
_TREES = "array<array<struct<feature:int,cut:double,left:int,right:int,share:double,n:bigint>>>"
# Poisson counts of mean 1 are the number of these shares that a uniform number exceeds.
_POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(12)]


@dataclass
class Node:
    """An inner node sends values up to ``cut`` left; ``left`` and ``right`` are places in the list of its tree."""

    path: str
    n: int = 0
    positives: int = 0
    feature: int | None = None
    cut: float | None = None
    left: int | None = None
    right: int | None = None
    gain: float | None = None
    widened: bool = False
    bin: int | None = None


@dataclass
class Forest:
    """Trees: ``tops`` are lists of the nodes that were split in rounds, the root first, ``rest`` is a stored table of what groups grew.

    ``small`` are the nodes (tree, place) that ``rest`` goes on from, a slot each, and ``sizes`` its nodes and depth by slot.
    ``group`` tells which of several fits a tree belongs to.
    """

    tops: list[list[Node]] = field(default_factory=list)
    group: list[int] = field(default_factory=list)
    edges: dict[int, list[float]] = field(default_factory=dict)
    width: int = 0
    small: list[tuple[int, int]] = field(default_factory=list)
    rest: DataFrame | None = None
    sizes: list[tuple[int, int]] = field(default_factory=list)
    _whole: list[list[Node]] | None = None

    @property
    def trees(self) -> list[list[Node]]:
        """All nodes as lists in the driver, for small forests; ``table`` and ``score`` do without."""
        if self._whole is None:
            whole = [[replace(node) for node in tree] for tree in self.tops]
            starts = self._starts()
            for row in self.rest.orderBy("slot", "node").toLocalIterator() if self.rest is not None else ():
                t, top = self.small[row["slot"]]
                tree, start = whole[t], starts[row["slot"]]
                if row["node"] == 0:
                    tree.extend(Node("") for _ in range(self.sizes[row["slot"]][0] - 1))
                node = tree[start + row["node"] if row["node"] else top]
                node.n, node.positives, node.widened = row["n"], row["positives"], row["widened"]
                if row["lower"] is not None:  # a node comes after the one above it
                    node.feature, node.cut, node.gain, node.bin = row["feature"], row["cut"], row["gain"], row["bin"]
                    node.left, node.right = start + row["lower"], start + row["lower"] + 1
                    tree[node.left].path, tree[node.right].path = node.path + "0", node.path + "1"
            self._whole = whole
        return self._whole

    def of(self, group: int) -> Forest:
        return Forest([t for t, g in zip(self.trees, self.group, strict=True) if g == group], [group] * self.group.count(group), self.edges, self.width)

    def depth(self) -> int:
        return max([*(len(n.path) for tree in self.tops for n in tree), *(d for _, d in self.sizes)], default=0)

    def size(self) -> int:
        """Nodes of all trees."""
        return sum(map(len, self.tops)) + sum(n - 1 for n, _ in self.sizes)

    def _starts(self) -> list[int]:
        """Per slot the number that node 0 of the slot would have in its tree; the others follow."""
        held, starts = [len(tree) for tree in self.tops], []
        for (t, _), (n, _) in zip(self.small, self.sizes, strict=True):
            starts.append(held[t] - 1)
            held[t] += n - 1
        return starts

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row per node, with the bin of its cut: (tree, node, depth, n, positives, feature, bin, cut, left, right, gain)."""
        gone = set(self.small)
        rows = [
            (t, i, len(n.path), n.n, n.positives, n.feature, n.bin, n.cut, n.left, n.right, n.gain)
            for t, tree in enumerate(self.tops) for i, n in enumerate(tree) if (t, i) not in gone
        ]
        told = spark.createDataFrame(rows, _NODES)
        if self.rest is None:
            return told
        slots = [(slot, t, top, start) for slot, ((t, top), start) in enumerate(zip(self.small, self._starts(), strict=True))]
        placed = self.rest.join(spark.createDataFrame(slots, "slot int, tree int, top int, start int"), "slot")
        node = F.when(F.col("node") == 0, F.col("top")).otherwise(F.col("start") + F.col("node"))
        left = F.col("start") + F.col("lower")
        grown = placed.select("tree", node.alias("node"), "depth", "n", "positives", "feature", "bin", "cut", left.alias("left"), (left + 1).alias("right"), "gain")
        return told.unionByName(grown)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node: (tree, node, depth, n, positives, feature, cut, left, right, gain)."""
        return self.nodes(spark).drop("bin")

    def column(self, spark: SparkSession) -> Column:
        """All nodes as one value, which tasks get once."""
        share = lambda n: n.positives / n.n if n.n else None
        rows = [[(n.feature, n.cut, n.left, n.right, share(n), n.n) for n in tree] for tree in self.trees]
        return spark.createDataFrame([(rows,)], f"t {_TREES}").scalar()


@dataclass(frozen=True)
class Plan:
    """How the trees of one group grow; rows of the fold ``without`` take no part."""

    trees: int
    depth: int | None
    min_split: int
    min_leaf: int
    bootstrap: bool
    without: int | None = None


def drawn_features(seed: int, tree: Column, path: Column, width: int) -> Column:
    """All features in the order in which a node tries them: by the hash of seed, tree, path and feature."""
    text = lambda f: F.concat_ws("|", F.lit(seed), tree, path, f)
    hashed = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda f: F.struct(F.md5(text(f)).alias("h"), f.cast("int").alias("f")))
    return F.transform(F.array_sort(hashed), lambda s: s["f"])


def best_cuts(histogram: DataFrame) -> DataFrame:
    """Per slot (an open node) its rows and positives, and the cut that takes off most impurity, from counts per bin.

    ``gain`` is the mean decrease of the Gini impurity over the rows of the node. Of equal gains, to nine digits, the first
    feature and lowest cut count. A cut that takes off nothing is one too, as long as both sides hold ``least`` rows.
    """
    whole = Window.partitionBy("slot", "feature")
    upto = whole.orderBy("bin")
    sums = histogram.select(
        "slot", "least", "feature", "bin", F.sum("n").over(upto).alias("nl"), F.sum("p").over(upto).alias("pl"), F.sum("n").over(whole).alias("n"), F.sum("p").over(whole).alias("p")
    )
    impurity = lambda n, p: F.try_divide(F.lit(2.0) * p * (n - p), n)
    nr, pr = F.col("n") - F.col("nl"), F.col("p") - F.col("pl")
    gain = (impurity(F.col("n"), F.col("p")) - impurity(F.col("nl"), F.col("pl")) - impurity(nr, pr)) / F.col("n")
    fits = (F.col("nl") >= F.col("least")) & (nr >= F.col("least")) & (nr > 0)
    best = F.max(F.when(fits, F.struct(F.round(gain, 9).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "nl", "pl")))
    return sums.groupBy("slot").agg(F.max("n").alias("n"), F.max("p").alias("p"), best.alias("best"))


def _grows(node: Node, plan: Plan) -> bool:
    deep = plan.depth is not None and len(node.path) >= plan.depth
    return not deep and node.n >= max(plan.min_split, 2 * plan.min_leaf) and 0 < node.positives < node.n


def _values(df: DataFrame, vector: str) -> Column:
    return vector_to_array(vector) if dict(df.dtypes)[vector] == "vector" else F.col(vector)


def fit_forest(
    train: DataFrame, key: str = "stay_id", label: str = "label", vector: str = "features", trees: int = 700, depth: int | None = 40,
    min_split: int = 10, min_leaf: int = 2, bootstrap: bool = False, columns: int | None = None, seed: int = 42, max_bins: int = MAX_BINS,
) -> Forest:
    """A forest by Gini impurity with the square root of the features (or ``columns``) tried per node.

    A node with fewer than ``min_split`` rows is a leaf, a side holds ``min_leaf`` rows or more, ``depth`` None is no bound. A
    node without any cut among the drawn features tries all others at once. ``bootstrap`` gives every row a Poisson count per
    tree by a hash of ``key``. Values are binned by quantiles. Rows without label are left out; a table without rows, or
    with vectors of no width, gives a forest without trees.
    """
    return grow(train, [Plan(trees, depth, min_split, min_leaf, bootstrap)], key, label, vector, columns, seed, max_bins)


def grow(
    train: DataFrame, plans: list[Plan], key: str, label: str = "label", vector: str = "features", columns: int | None = None, seed: int = 42,
    max_bins: int = MAX_BINS, as_spark: bool = False,
) -> Forest:
    """The forests of all plans in the same rounds; with folds, ``train`` has a column ``fold``.

    ``as_spark`` takes the rules of Spark's forest: the square root is rounded up, a node whose drawn features have no cut
    that gains is a leaf, and two leaves of one class below a node become one. Its draws are integer hashes.
    """
    spark = train.sparkSession
    fold = F.col("fold") if any(p.without is not None for p in plans) else F.lit(None).cast("int")
    known = train.filter(F.col(label).isNotNull())
    raw = cut_lineage(known.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"), _values(train, vector).alias("x"), fold.alias("fold")))
    width = raw.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return Forest()
    cuts = cut_lineage(quantile_cuts(raw.select(F.posexplode("x").alias("feature", "value")), max_bins))
    edges = {f: list(c) for f, c in cuts.collect()}  # at most max_bins numbers per feature
    n_bins = max((len(c) for c in edges.values()), default=0) + 1
    group = [g for g, p in enumerate(plans) for _ in range(p.trees)]
    number = [i for p in plans for i in range(p.trees)]

    forest = Forest([[Node("")] for _ in group], group, edges, width)
    taken = columns or (math.ceil(math.sqrt(width)) if as_spark else max(1, math.isqrt(width)))
    more = taken < width and not as_spark
    rows = raw.count()
    few = max(1, min(GROUP_VALUES // width, GROUP_CELLS // min(taken, width)))
    small = [(t, 0) for t in range(len(group))] if rows <= few else []
    if small and not any(p.bootstrap or p.without is not None for p in plans):
        packed = raw.mapInArrow(_packer(edges, width, n_bins, "y"), "own binary, bins binary").withColumnRenamed("own", "y")
        _finish(None, packed, forest, small, plans, number, taken, seed, n_bins, rows, few, as_spark)
        return forest
    state = _state(raw, plans, group, number, seed)
    state = state.mapInArrow(_binner(edges, width), "y int, bins array<int>, times array<int>")
    open_ = [] if small else [(t, 0) for t in range(len(group))]
    first = F.sequence(F.lit(-1 if small else 0), F.lit(-len(group) if small else len(group) - 1))
    taking = F.when(F.col("times").isNull(), first).otherwise(F.zip_with(first, "times", lambda slot, k: F.when(k > 0, slot)))
    state = state.withColumn("at", taking)
    state = cut_lineage(state) if open_ else state
    rounds = 0
    while open_:
        found = {}
        for begin in range(0, len(open_), NODES_PER_JOB):
            tries = []
            for t, i in open_[begin : begin + NODES_PER_JOB]:
                node = forest.tops[t][i]
                first, count = (taken + 1, width - taken) if node.widened else (1, taken)
                tries.append((number[t], node.path, first, count, plans[group[t]].min_leaf))
            counted = _histogram(state, _tried(spark, tries, width, seed, as_spark), begin)
            found |= {row["slot"]: row for row in best_cuts(counted).collect()}  # at most NODES_PER_JOB rows
        moves, open_ = _split(forest, open_, found, plans, edges, more, small, few, as_spark)
        moved = spark.createDataFrame([(moves,)], f"m {_SPLITS}").scalar()
        state = state.withColumn("moved", moved).withColumn("at", F.transform("at", _place)).drop("moved")
        rounds += 1
        if rounds % _REFRESH == 0 and open_:
            state = cut_lineage(state)
    if small:
        _finish(state, None, forest, small, plans, number, taken, seed, n_bins, rows, few, as_spark)
    elif as_spark:
        _prune(forest)
    return forest


def _state(raw: DataFrame, plans: list[Plan], group: list[int], number: list[int], seed: int) -> DataFrame:
    """Rows with the count that every tree gives them; no counts where all trees take every row once."""
    if not any(p.bootstrap or p.without is not None for p in plans):
        return raw.select("y", "x", F.lit(None).cast("array<int>").alias("times"))
    told = [(i, plans[g].bootstrap, plans[g].without) for i, g in zip(number, group, strict=True)]
    each = raw.sparkSession.createDataFrame([(told,)], "e array<struct<i:int,bootstrap:boolean,without:int>>").scalar()
    uniform = lambda i: F.pmod(F.xxhash64("key", F.lit(seed), i), F.lit(1 << 40)).cast("double") / F.lit(float(1 << 40))
    poisson = lambda i: F.aggregate(F.array(*map(F.lit, _POISSON)), F.struct(F.lit(0).alias("k"), uniform(i).alias("u")), lambda a, c: F.struct((a["k"] + (a["u"] >= c).cast("int")).alias("k"), a["u"].alias("u")), lambda a: a["k"])
    out = lambda e: F.coalesce(e["without"] == F.col("fold"), F.lit(False))
    times = F.transform("e", lambda e: F.when(out(e), 0).when(e["bootstrap"], poisson(e["i"])).otherwise(1))
    return raw.withColumn("e", each).select("y", "x", times.alias("times"))


def _binner(edges: dict[int, list[float]], width: int):
    """Task: bins instead of values, the number of cuts below a value; a missing value has none."""

    def told(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = batch.column("x")
            rows = len(x)
            place, of = np.zeros(rows, np.int64), x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            values = x.flatten()
            known = values.is_valid().to_numpy(zero_copy_only=False)
            flat = values.fill_null(0.0).to_numpy(zero_copy_only=False)
            place[1:] = np.cumsum(of)[:-1]
            bins = np.zeros((rows, width), np.int32)
            for f in range(width):
                held = np.flatnonzero(of > f)
                at = place[held] + f
                bins[held, f] = np.where(known[at], np.searchsorted(edges.get(f, []), flat[at], "left"), 0)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(bins.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("y"), listed, batch.column("times")], names=["y", "bins", "times"])

    return told


def _packer(edges: dict[int, list[float]], width: int, n_bins: int, own: str):
    """Task: many rows as one, the column ``own`` and the bins of the values ``x``; a missing value has the lowest bin."""
    binned, blob = _binner(edges, width), BLOB

    def told(batches):
        import numpy as np
        import pyarrow as pa

        kind = np.uint8 if n_bins <= 256 else np.uint16
        step = max(1, blob // (width * np.dtype(kind).itemsize))
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                listed = pa.RecordBatch.from_arrays([part.column(own), part.column("x"), part.column(own)], names=["y", "x", "times"])
                bins = next(binned([listed])).column("bins").flatten().to_numpy(zero_copy_only=False).astype(kind)
                mine = part.column(own).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([mine.tobytes()], pa.binary()), pa.array([bins.tobytes()], pa.binary())], names=["own", "bins"])

    return told


def _own_tasks(spark: SparkSession, parts: int) -> list[int]:
    """A number for each of so many groups, such that Spark deals every group to a task of its own."""
    dealt = spark.range(64 * parts).select(F.col("id").cast("int").alias("i")).select("i", F.pmod(F.hash("i"), F.lit(parts)).alias("part"))
    own = {r["part"]: r["i"] for r in dealt.groupBy("part").agg(F.min("i").alias("i")).collect()}
    return [own.get(b, 64 * parts + b) for b in range(parts)]


def _finish(
    state: DataFrame | None, packed: DataFrame | None, forest: Forest, small: list[tuple[int, int]], plans: list[Plan], number: list[int], taken: int,
    seed: int, n_bins: int, rows: int, few: int, as_spark: bool,
) -> None:
    """Grow the nodes ``small``, whose rows have the places -1, -2 and so on in ``state``, to their ends, as the table ``rest``.

    Each group gets some of the nodes, and each row of these once. Groups hold ``few`` rows at most. ``packed`` instead has the
    rows of a forest whose trees all take every row once.
    """
    spark = (packed if state is None else state).sparkSession
    sizes = [forest.tops[t][i].n or rows for t, i in small]
    wanted = sum(sizes) / max(GROUPS, spark.sparkContext.defaultParallelism)
    wanted = wanted if rows <= few else min(wanted, few)
    bundle, held, last = [], 0, 0
    for n in sizes:
        if held and held + n / 2 > wanted:
            held, last = 0, last + 1
        held += n
        bundle.append(last)
    own = _own_tasks(spark, last + 1)
    names = [own[b] for b in bundle]
    roots = []
    for t, i in small:
        plan, node = plans[forest.group[t]], forest.tops[t][i]
        roots.append((number[t], node.path, plan.depth, plan.min_split, plan.min_leaf))
    if state is None:
        none = F.lit(None).cast("binary")
        dealt = packed.select(F.explode(F.array(*map(F.lit, own))).alias("bundle"), "y", "bins", none.alias("rows"), none.alias("slots"), none.alias("times"))
    else:
        dealt = state.mapInArrow(_dealer(names, n_bins), _DEALT)
    grower = _grower(roots, names, forest.edges, forest.width, taken, seed, n_bins, as_spark, min(BLOCK, GROUP_CELLS))
    rest = cut_lineage(dealt.repartition(last + 1, "bundle").groupBy("bundle").applyInArrow(grower, _GROWN))
    root = F.when(F.col("node") == 0, F.struct("n", "positives"))
    told = rest.groupBy("slot").agg(F.count(F.lit(1)).alias("nodes"), F.max("depth").alias("depth"), F.first(root, ignorenulls=True).alias("root"))
    found = {r["slot"]: r for r in told.collect()}  # a row per small node
    single = []
    for slot, (t, i) in enumerate(small):
        if slot not in found or found[slot]["nodes"] == 1:  # its tree drew no row, or it is a leaf, which the driver can keep
            single.append(slot)
            if slot in found:
                node = forest.tops[t][i]
                node.n, node.positives = found[slot]["root"]
    kept = [slot for slot in range(len(small)) if slot not in set(single)]
    forest.small = [small[slot] for slot in kept]
    if as_spark:
        _prune(forest)
    forest.sizes = [(found[slot]["nodes"], found[slot]["depth"]) for slot in kept]
    if single:
        renamed = spark.createDataFrame(list(enumerate(kept)), "now int, slot int")
        rest = rest.join(renamed, "slot").withColumn("slot", F.col("now")).drop("now")
    forest.rest = rest if kept else None


def _prune(forest: Forest) -> None:
    """The same for the nodes in the driver, whose small ones go on: two leaves of one class become one."""
    goes_on = set(forest.small)
    for t, tree in enumerate(forest.tops):
        leaf = lambda i: tree[i].feature is None and (t, i) not in goes_on  # noqa: B023, E731
        says = lambda i: 2 * tree[i].positives > tree[i].n  # noqa: B023, E731
        gone = set()
        for i in range(len(tree) - 1, -1, -1):  # a node comes after the one above it
            node = tree[i]
            if node.feature is not None and leaf(node.left) and leaf(node.right) and says(node.left) == says(node.right):
                gone |= {node.left, node.right}
                node.feature = node.cut = node.left = node.right = node.gain = node.bin = None
        if gone:
            place = {old: new for new, old in enumerate(i for i in range(len(tree)) if i not in gone)}
            forest.tops[t] = [tree[i] for i in place]
            for node in forest.tops[t]:
                if node.feature is not None:
                    node.left, node.right = place[node.left], place[node.right]
            forest.small = [(u, place[i]) if u == t else (u, i) for u, i in forest.small]


def _dealer(names: list[int], n_bins: int):
    """Task: rows to the groups whose nodes they are in, with their places and counts there."""

    def deal(batches):
        import numpy as np
        import pyarrow as pa

        name = np.array(names, np.int32)
        groups, group = np.unique(name, return_inverse=True)
        group = group.astype(np.int16 if len(groups) < 1 << 15 else np.int32)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            flat = lambda c: batch.column(c).flatten().fill_null(0).to_numpy(zero_copy_only=False).reshape(rows, -1)
            at = flat("at")
            row, tree = np.nonzero(at < 0)
            slot = -1 - at[row, tree]
            times = np.ones(len(row), np.int8) if batch.column("times").null_count else flat("times")[row, tree].astype(np.int8)
            of = group[slot]
            order = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[order], np.arange(len(groups) + 1))
            bins = flat("bins").astype(np.uint8 if n_bins <= 256 else np.uint16)
            y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
            for g in range(len(groups)):
                mine = order[ends[g] : ends[g + 1]]
                if not len(mine):
                    continue
                held, places = np.unique(row[mine], return_inverse=True)
                told = (y[held], bins[held], places.astype(np.int32), slot[mine].astype(np.int32), times[mine])
                columns = [pa.array([groups[g]], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in told)]
                yield pa.RecordBatch.from_arrays(columns, names=["bundle", "y", "bins", "rows", "slots", "times"])

    return deal


def _drawer(seed: int, width: int, taken: int, quick: bool):
    """The state of a node's draw, those of the nodes below, and the features it tries, ascending: by hashes of seed, tree and path."""
    import hashlib

    import numpy as np

    golden, ways = np.uint64(0x9E3779B97F4A7C15), (0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7)

    def spread(z):
        with np.errstate(over="ignore"):
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))

    def below(states, side):
        return spread(states ^ np.uint64(ways[side])) if quick else np.array([text + str(side) for text in states], object)

    def start(number, path):
        if not quick:
            return np.array([f"{seed}|{number}|{path}"], object)
        state = spread(spread(np.array([seed % (1 << 64)], np.uint64) ^ golden) ^ np.uint64(number))
        for side in path:
            state = below(state, int(side))
        return state

    def drawn(states, later):
        if not quick:
            return np.array([ranked(text, later) for text in states], np.int64).reshape(len(states), -1)
        # so many different features by Floyd's rule
        with np.errstate(over="ignore"):
            parts = spread(states[:, None] + np.arange(1, taken + 1, dtype=np.uint64) * golden) >> np.uint64(32)
        out = np.empty((len(states), min(taken, width)), np.int64)
        for i in range(out.shape[1]):
            last = width - out.shape[1] + i
            one = ((parts[:, i] * np.uint64(last + 1)) >> np.uint64(32)).astype(np.int64)
            out[:, i] = np.where((out[:, :i] == one[:, None]).any(axis=1), last, one)
        out.sort(axis=1)
        return out

    def ranked(text, later):
        begun, hashes = hashlib.md5(f"{text}|".encode()), []
        for f in range(width):
            one = begun.copy()
            one.update(b"%d" % f)
            hashes.append(one.digest())
        order = sorted(range(width), key=hashes.__getitem__)
        return sorted(order[taken:] if later else order[:taken])

    return start, below, drawn


def _grower(
    roots: list[tuple], names: list[int], edges: dict[int, list[float]], width: int, taken: int, seed: int, n_bins: int, as_spark: bool, block: int
):
    """Task: the nodes of one group grown to their ends, a row per node; the same cuts as ``best_cuts`` finds.

    Rows of an open node lie next to each other. Nodes of many rows are counted feature by feature, others many at a time:
    in a table of all bins, or where that had more cells than the nodes have values, by sorting.
    """
    start, below, drawn = _drawer(seed, width, taken, as_spark)
    shift = (2 * n_bins - 1).bit_length()
    dense, large = 2 * n_bins, max(1024, 4 * n_bins)

    def grown(table):
        import numpy as np
        import pyarrow as pa

        blobs = lambda name, kind: [np.frombuffer(v.as_buffer(), kind) for v in table[name]]
        y = np.concatenate(blobs("y", np.int64)).astype(np.int8)
        columns = np.empty((width, len(y)), np.uint8 if n_bins <= 256 else np.uint16)
        begin = 0
        for part in blobs("bins", columns.dtype):
            part = part.reshape(-1, width)
            columns[:, begin : begin + len(part)] = part.T
            begin += len(part)
        values = columns.ravel()
        total = len(y)

        def impurity(n, p):
            return 2.0 * p * (n - p) / n

        def search(some, tried, rows, begins, n, p, least, found):
            """Best cuts of the nodes ``some`` over the features ``tried``, into ``found``: gain, feature, bin, rows and positives below."""

            def keep(w, gain, feature, b, nl, pl):
                better = gain > found[0][w]
                for kept, new in zip(found, (gain, feature, b, nl, pl), strict=True):
                    kept[w[better]] = new[better]

            def from_counts(places, counts, part):
                nl = np.cumsum(counts.sum(axis=2), axis=2)
                pl = np.cumsum(counts[:, :, 1], axis=2)
                whole, positives = n[places][:, None, None], p[places][:, None, None]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = (impurity(whole, positives) - impurity(nl, pl) - impurity(whole - nl, positives - pl)) / whole
                gain = np.where((nl >= least) & (whole - nl >= least), np.floor(gain * 1e9 + 0.5) / 1e9, -np.inf).reshape(len(places), -1)
                best, each = gain.argmax(axis=1), np.arange(len(places))
                keep(places, gain[each, best], part[each, best // n_bins], best % n_bins, nl.reshape(len(places), -1)[each, best], pl.reshape(len(places), -1)[each, best])

            def from_sorted(places, key, part, many):
                key = key.ravel()
                key.sort()
                whole, positives = n[places], p[places]
                ends = np.flatnonzero((key[1:] ^ key[:-1]) > 1)
                segment = key[ends] >> shift
                node = segment // many
                before = segment - node * many
                below_n = (np.cumsum(whole) - whole)[node] * many + before * whole[node]
                nl = ends + 1 - below_n
                fits = np.flatnonzero((nl >= least) & (whole[node] - nl >= least))
                if not len(fits):
                    return
                ends, node, before, nl = ends[fits], node[fits], before[fits], nl[fits]
                pl = np.cumsum(key & 1, dtype=np.int64)[ends] - (np.cumsum(positives) - positives)[node] * many - before * positives[node]
                nw, pw = whole[node], positives[node]
                gain = np.floor((impurity(nw, pw) - impurity(nl, pl) - impurity(nw - nl, pw - pl)) / nw * 1e9 + 0.5) / 1e9
                starts = np.flatnonzero(np.diff(node, prepend=-1))
                highest = np.repeat(np.maximum.reduceat(gain, starts), np.diff(np.append(starts, len(node))))
                hits = np.flatnonzero(gain == highest)
                hits = hits[np.flatnonzero(np.diff(node[hits], prepend=-1))]
                keep(places[node[hits]], gain[hits], part[node[hits], before[hits]], (key[ends[hits]] & ((1 << shift) - 1)) >> 1, nl[hits], pl[hits])

            step = max(1, min(tried.shape[1], block))
            for first in range(0, tried.shape[1], step):
                part = tried[:, first : first + step]
                many = part.shape[1]
                # blocks of nodes: of many rows, of fewer, of few
                size = n[some]
                kinds = np.where(size >= large, 0, np.where(size >= dense, 1, 2))
                for kind in (0, 1, 2):
                    own = np.flatnonzero(kinds == kind)
                    weight = np.full(len(own), many * dense) if kind == 0 else size[own] * many
                    upto = np.cumsum(weight)
                    at = 0
                    while at < len(own):
                        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + block, "right")))
                        picked, at = own[at:to], to
                        places, tries = some[picked], part[picked]
                        if kind == 0:
                            counts = np.empty((len(places), many, 2, n_bins), np.int64)
                            for i, w in enumerate(places):
                                mine = rows[begins[w] : begins[w] + n[w]]
                                sides = [mine[y[mine] == label] for label in (0, 1)]
                                for j in range(many):
                                    column = columns[tries[i, j]]
                                    for label in (0, 1):
                                        counts[i, j, label] = np.bincount(column.take(sides[label]), minlength=n_bins)
                            from_counts(places, counts, tries)
                            continue
                        k = n[places]
                        mine = rows[np.repeat(begins[places] - np.cumsum(k) + k, k) + np.arange(k.sum())]
                        local = np.repeat(np.arange(len(places)), k)
                        index = (tries * total).take(local, axis=0)
                        index += mine[:, None]
                        value = values.take(index)
                        if kind == 1:
                            key = (local * (many * dense) + y[mine].astype(np.int64) * n_bins)[:, None] + np.arange(many) * dense
                            key += value
                            from_counts(places, np.bincount(key.ravel(), minlength=len(places) * many * dense).reshape(-1, many, 2, n_bins), tries)
                        else:
                            short = np.int32 if (len(places) * many) << shift < 1 << 31 else np.int64
                            key = ((local * many << shift) + y[mine]).astype(short)[:, None] + (np.arange(many) << shift).astype(short)
                            key += value.astype(short) << 1
                            from_sorted(places, key, tries, many)

        def tree(rows, number, root, depth, min_split, min_leaf):
            """Arrays of the nodes below ``root``: number, depth, rows, positives, feature, bin, lower, gain, widened."""
            least, enough = max(1, min_leaf), max(min_split, 2 * min_leaf)
            grows = lambda n, p, level: (n >= enough) & (p > 0) & (p < n) & ((level < depth) if depth is not None else True)
            ids, levels, state, wide = np.zeros(1, np.int64), np.full(1, len(root)), start(number, root), np.zeros(1, bool)
            n, p, made = np.array([len(rows)]), np.array([y[rows].sum(dtype=np.int64)]), 1
            out = []

            def leaves(ids, levels, n, p, wide):
                none = np.full(len(ids), -1)
                out.append((ids, levels, n, p, none, none, none, np.zeros(len(ids)), wide))

            if not grows(n, p, levels)[0]:
                leaves(ids, levels, n, p, wide)
                ids = ids[:0]
            while len(ids):
                begins = np.cumsum(n) - n
                found = [np.full(len(ids), 0.0 if as_spark else -np.inf), *(np.full(len(ids), -1) for _ in range(4))]
                for later in (False, True):
                    some = np.flatnonzero(wide == later)
                    if len(some):
                        search(some, drawn(state[some], later), rows, begins, n, p, least, found)
                gain, feature, b, nl, pl = found
                cut = np.flatnonzero(feature >= 0)
                again = np.flatnonzero((feature < 0) & ~wide & (taken < width and not as_spark))
                ends = np.flatnonzero((feature < 0) & (wide | (taken >= width) | as_spark))
                lower = made + 2 * np.arange(len(cut))
                made += 2 * len(cut)
                out.append((ids[cut], levels[cut], n[cut], p[cut], feature[cut], b[cut], lower, gain[cut], wide[cut]))
                leaves(ids[ends], levels[ends], n[ends], p[ends], np.ones(len(ends), bool))
                # the nodes below, two for each cut
                two = lambda a, b: np.stack([a, b], axis=1)
                kids, level = two(lower, lower + 1), two(levels[cut] + 1, levels[cut] + 1)
                kn, kp = two(nl[cut], n[cut] - nl[cut]), two(pl[cut], p[cut] - pl[cut])
                stay = grows(kn, kp, level)
                leaves(kids[~stay], level[~stay], kn[~stay], kp[~stay], np.zeros(int((~stay).sum()), bool))
                slot = np.full((len(ids), 2), -1)
                slot[again] = np.arange(len(again))[:, None]
                slot[cut] = np.where(stay, len(again) + np.cumsum(stay.ravel()).reshape(stay.shape) - 1, -1)
                # their rows
                live = (slot >= 0).any(axis=1)
                node = np.repeat(np.arange(len(ids)), n)
                if not live.all():
                    mine = np.flatnonzero(live[node])
                    node, rows = node[mine], rows[mine]
                high = values.take(np.maximum(feature, 0)[node] * total + rows) > np.where(feature < 0, n_bins, b)[node]
                to = slot.ravel().take(node * 2 + high)
                sums = np.concatenate([n[again], kn[stay]])
                first = np.cumsum(sums) - sums
                placed = np.empty(int(sums.sum()), np.int64)
                for side in (False, True):
                    mine = np.flatnonzero((high == side) & (to >= 0))
                    slots = to[mine]
                    begun = np.flatnonzero(np.diff(slots, prepend=-1))
                    placed[np.arange(len(mine)) + np.repeat(first[slots[begun]] - begun, np.diff(np.append(begun, len(mine))))] = rows[mine]
                state = np.concatenate([state[again], two(below(state[cut], 0), below(state[cut], 1))[stay]])
                ids, levels = np.concatenate([ids[again], kids[stay]]), np.concatenate([levels[again], level[stay]])
                wide = np.concatenate([np.ones(len(again), bool), np.zeros(int(stay.sum()), bool)])
                n, p, rows = sums, np.concatenate([p[again], kp[stay]]), placed
            nodes = [np.concatenate(c) for c in zip(*out, strict=True)]
            return pruned(nodes) if as_spark else nodes

        def pruned(nodes):
            """Without cuts that do not change the class: from the bottom up, two leaves of one class become one."""
            order = np.argsort(nodes[0])
            ids, levels, n, p, feature, b, lower, gain, wide = (c[order] for c in nodes)
            says, leaf = 2 * p > n, feature < 0
            for level in range(int(levels.max()), int(levels[0]) - 1, -1):
                inner = np.flatnonzero((levels == level) & ~leaf)
                low, high = lower[inner], lower[inner] + 1
                leaf[inner[leaf[low] & leaf[high] & (says[low] == says[high])]] = True
            held = np.zeros(len(ids), bool)
            held[0] = True
            for level in range(int(levels[0]), int(levels.max())):
                inner = np.flatnonzero((levels == level) & ~leaf & held)
                held[lower[inner]] = held[lower[inner] + 1] = True
            places = np.cumsum(held) - 1
            none = np.where(leaf, -1, 0)
            columns = places, levels, n, p, np.where(leaf, none, feature), np.where(leaf, none, b), np.where(leaf, none, places[lower]), np.where(leaf, 0.0, gain), wide
            return [c[held] for c in columns]

        def slots_with_rows():
            if table["slots"].null_count:
                name = table["bundle"][0].as_py()
                for slot in (s for s, own in enumerate(names) if own == name):
                    yield slot, np.arange(total)
                return
            held = np.cumsum([0, *map(len, blobs("y", np.int64))])
            place = np.concatenate([v + at for v, at in zip(blobs("rows", np.int32), held[:-1], strict=True)])
            slots, times = np.concatenate(blobs("slots", np.int32)), np.concatenate(blobs("times", np.int8))
            order = np.argsort(slots, kind="stable")
            begins = np.append(np.flatnonzero(np.diff(slots[order], prepend=-1)), len(order))
            for begin, end in zip(begins[:-1], begins[1:], strict=True):
                mine = order[begin:end]
                yield int(slots[mine[0]]), np.repeat(place[mine], times[mine]).astype(np.int64)

        told = []
        for slot, rows in slots_with_rows():
            nodes = tree(rows, *roots[slot])
            told.append((np.full(len(nodes[0]), slot), *nodes))
        slot, ids, levels, n, p, feature, b, lower, gain, wide = (np.concatenate(c) for c in zip(*told, strict=True))
        leaf = feature < 0
        bounds = np.zeros((width, n_bins))
        for f, c in edges.items():
            bounds[f, : len(c)] = c
        inner = lambda v, kind: pa.array(v, kind, mask=leaf)
        arrays = [pa.array(v, pa.int32()) for v in (slot, ids, levels)] + [pa.array(v, pa.int64()) for v in (n, p)]
        arrays += [inner(v, pa.int32()) for v in (feature, b)] + [inner(bounds[np.maximum(feature, 0), np.maximum(b, 0)], pa.float64())]
        arrays += [inner(lower, pa.int32()), inner(gain, pa.float64()), pa.array(wide)]
        return pa.table(arrays, names=["slot", "node", "depth", "n", "positives", "feature", "bin", "cut", "lower", "gain", "widened"])

    return grown


def _tried(spark: SparkSession, tries: list[tuple], width: int, seed: int, as_spark: bool) -> Column:
    """Features that the open nodes of a job try, and the rows a side needs, in the order of the nodes."""
    if as_spark:
        start, _, drawn = _drawer(seed, width, tries[0][3], True)
        told = [(j, drawn(start(i, path), False)[0].tolist(), least) for j, (i, path, _, _, least) in enumerate(tries)]
        frame = spark.createDataFrame(told, "j int, d array<int>, least int")
        return frame.agg(F.array_sort(F.collect_list(F.struct("j", "d", "least")))).scalar()
    frame = spark.createDataFrame([(j, *row) for j, row in enumerate(tries)], "j int, i int, path string, first int, count int, least int")
    drawn = F.slice(drawn_features(seed, F.col("i"), F.col("path"), width), F.col("first"), F.col("count"))
    return frame.agg(F.array_sort(F.collect_list(F.struct("j", drawn.alias("d"), "least")))).scalar()


def _histogram(state: DataFrame, tried: Column, begin: int) -> DataFrame:
    none = F.array().cast("array<int>")

    def cells(slot: Column, tree: Column) -> Column:
        node = F.get(F.col("tried"), F.when(slot >= 0, slot - begin))
        cell = lambda f: F.struct(slot.alias("slot"), node["least"].alias("least"), f.alias("feature"), F.get(F.col("bins"), f).alias("bin"), F.coalesce(F.get(F.col("times"), tree), F.lit(1)).alias("k"))
        return F.transform(F.coalesce(node["d"], none), cell)

    flat = state.withColumn("tried", tried).select("y", F.inline(F.flatten(F.transform("at", cells))))
    return flat.groupBy("slot", "least", "feature", "bin").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("y")).alias("p"))


def _place(slot: Column) -> Column:
    """Slot of a row in the next round; none where it came to a leaf, and that of a small node stays."""
    to = F.get(F.col("moved"), F.when(slot >= 0, slot))
    return F.when(slot < 0, slot).when(to["feature"].isNull() | (F.get(F.col("bins"), to["feature"]) <= to["bin"]), to["left"]).otherwise(to["right"])


def _split(
    forest: Forest, open_: list[tuple[int, int]], found: dict, plans: list[Plan], edges: dict[int, list[float]], more: bool,
    small: list[tuple[int, int]], few: int, as_spark: bool,
) -> tuple[list, list[tuple[int, int]]]:
    """Split the open nodes by their best cuts: where their rows go, and the nodes open next.

    A node without a cut stays open once, to try the other features, if there are ``more``. Nodes of up to ``few`` rows go to ``small``
    instead, with places below zero.
    """
    moves, after = [], []

    def stays(t: int, i: int, wanted: bool) -> int | None:
        if not wanted:
            return None
        # a node that stays open to try the other features is not small
        if forest.tops[t][i].n <= few:
            small.append((t, i))
            return -len(small)
        after.append((t, i))
        return len(after) - 1

    for slot, (t, i) in enumerate(open_):
        tree, plan, row = forest.tops[t], plans[forest.group[t]], found.get(slot)
        node = tree[i]
        if row is not None:  # else the tree drew no row
            node.n, node.positives = row["n"], row["p"]
        grows = _grows(node, plan)
        if not grows or row["best"] is None or (as_spark and row["best"]["gain"] <= 0):
            moves.append((None, None, stays(t, i, grows and more and not node.widened), None))
            node.widened = True
            continue
        best = row["best"]
        f, b = -best["f"], -best["b"]
        node.feature, node.cut, node.gain, node.left, node.right, node.bin = f, edges[f][b], best["gain"], len(tree), len(tree) + 1, b
        tree.append(Node(node.path + "0", best["nl"], best["pl"]))
        tree.append(Node(node.path + "1", node.n - best["nl"], node.positives - best["pl"]))
        moves.append((f, b, *[stays(t, j, _grows(tree[j], plan)) for j in (node.left, node.right)]))
    return moves, after


def share_of(trees: Column, x: Column, depth: int, min_split: int = 2) -> Column:
    """Mean share of positives in the leaves of ``x``; trees end at ``depth`` and at nodes of fewer than ``min_split`` rows."""

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = F.get(tree, at)
            ends = here["left"].isNull() | (here["n"] < min_split)
            return F.when(ends, at).when(F.get(x, here["feature"]) <= here["cut"], here["left"]).otherwise(here["right"])

        end = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)
        return F.get(tree, end)["share"]

    shares = F.filter(F.transform(trees, leaf), lambda s: s.isNotNull())
    return F.try_divide(F.aggregate(shares, F.lit(0.0), lambda a, s: a + s), F.size(shares))


def score(
    model: Forest, df: DataFrame, name: str, keep: list[str], vector: str = "features", trees: int | None = None, depth: int | None = None,
    min_split: int = 2,
) -> DataFrame:
    """Prediction table of a forest, or of a smaller one within it: kept columns, model name, label, probability.

    Trees that drew no row do not count; without any tree the probability is null. Runs at once.
    """
    told = cut_lineage(df.select(*keep, "label", _values(df, vector).alias("__x")).withColumn("__id", F.monotonically_increasing_id()))
    scored = told.join(votes(model, told.select("__id", F.col("__x").alias("x")), trees, depth, min_split), "__id", "left")
    return scored.select(*keep, F.lit(name).alias("model"), F.col("label").cast("int").alias("label"), F.try_divide("votes", "counted").alias("prob"))


def votes(model: Forest, rows: DataFrame, trees: int | None = None, depth: int | None = None, min_split: int = 2) -> DataFrame:
    """Per row (__id, x) the sum of the shares of positives in its leaves, ``votes``, and the trees that had rows, ``counted``.

    A task gets some of the trees and, where there are many rows, some of these. ``rows`` should be stored; the result is.
    """
    spark = rows.sparkSession
    count = len(model.tops) if trees is None else min(trees, len(model.tops))
    if not count:
        return rows.limit(0).select("__id", F.lit(0.0).alias("votes"), F.lit(0).alias("counted"))
    n_bins = max((len(c) for c in model.edges.values()), default=0) + 1
    chunks = max(1, math.ceil(rows.count() * model.width / SCORE_VALUES))
    bundles = min(count, max(math.ceil(GROUPS / chunks), math.ceil(model.size() / SCORE_NODES)))
    own = F.array(*map(F.lit, _own_tasks(spark, bundles * chunks)))
    named = lambda bundle, chunk: F.get(own, bundle * chunks + chunk).alias("group")
    each = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    nodes = model.nodes(spark).filter(F.col("tree") < count).select("tree", "node", "n", "positives", "feature", "bin", "left", each(chunks, "c"))
    nodes = nodes.select(named(F.pmod("tree", F.lit(bundles)), F.col("c")), "tree", "node", "n", "positives", "feature", "bin", "left")
    packed = rows.mapInArrow(_packer(model.edges, model.width, n_bins, "__id"), "own binary, bins binary")
    packed = packed.withColumn("c", F.pmod(F.xxhash64("own"), F.lit(chunks)).cast("int")).select("own", "bins", "c", each(bundles, "b"))
    packed = packed.select(named(F.col("b"), F.col("c")), "own", "bins")
    pairs = [frame.repartition(bundles * chunks, "group").groupBy("group") for frame in (nodes, packed)]
    parts = pairs[0].cogroup(pairs[1]).applyInArrow(_walker(model.width, n_bins, depth, min_split), "group int, __id bigint, votes double, counted int")
    # in the order of the groups, so that equal rows get equal sums
    summed = F.aggregate(F.array_sort(F.collect_list(F.struct("group", "votes"))), F.lit(0.0), lambda a, v: a + v["votes"])
    return cut_lineage(parts.groupBy("__id").agg(summed.alias("votes"), F.sum("counted").cast("int").alias("counted")))


def _walker(width: int, n_bins: int, depth: int | None, min_split: int):
    """Task: rows down the trees of a group; trees end at ``depth`` and at nodes of fewer than ``min_split`` rows."""

    def walked(nodes, rows):
        import numpy as np
        import pyarrow as pa

        blobs = lambda name, kind: [np.frombuffer(v.as_buffer(), kind) for v in rows[name]]
        names = ["group", "__id", "votes", "counted"]
        kinds = [pa.int32(), pa.int64(), pa.float64(), pa.int32()]
        if not nodes.num_rows or not rows.num_rows:
            return pa.table([pa.array([], kind) for kind in kinds], names=names)
        ident = np.concatenate(blobs("own", np.int64))
        values = np.concatenate(blobs("bins", np.uint8 if n_bins <= 256 else np.uint16))
        column = lambda name: nodes[name].fill_null(-1).to_numpy()
        number, place = column("tree"), column("node")
        order = np.lexsort((place, number))
        number, n, positives, feature, b, left = (column(c)[order].astype(np.int64) for c in ("tree", "n", "positives", "feature", "bin", "left"))
        feature[n < min_split] = -1
        votes, counted = np.zeros(len(ident)), np.zeros(len(ident), np.int32)
        begins = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(number))
        for begin, end in zip(begins[:-1], begins[1:], strict=True):
            f, cut, below, held = feature[begin:end], b[begin:end], left[begin:end], n[begin:end]
            at, active, steps = np.zeros(len(ident), np.int64), np.arange(len(ident)), 0
            while depth is None or steps < depth:
                here = at[active]
                inner = f[here] >= 0
                if not inner.all():
                    active, here = active[inner], here[inner]
                if not len(active):
                    break
                at[active] = below[here] + (values.take(active * width + f[here]) > cut[here])
                steps += 1
            share = np.divide(positives[begin:end], held, out=np.zeros(len(held)), where=held > 0)
            votes += share[at]
            counted += held[at] > 0
        group = np.full(len(ident), nodes["group"][0].as_py())
        return pa.table([pa.array(v, kind) for v, kind in zip((group, ident, votes, counted), kinds, strict=True)], names=names)

    return walked


@dataclass(frozen=True)
class TreeSize:
    numNodes: int
    depth: int


class ForestModel(Model, MLWritable):
    """A fitted forest of two classes with the columns, importances and stored form of Spark's, whose nodes stay a table.

    ``RandomForestClassificationModel`` loads what it stores. ``transform`` runs at once. ``release`` deletes the nodes.
    """

    def __init__(self, forest: Forest, estimator):
        super().__init__()
        self.forest, self.estimator = forest, estimator
        self._resetUid(estimator.uid)

    @property
    def getNumTrees(self) -> int:
        return len(self.forest.tops)

    @property
    def numFeatures(self) -> int:
        return self.forest.width

    @property
    def trees(self) -> list[TreeSize]:
        """Nodes and depth of every tree, one row each."""
        found = self.forest.nodes(SparkSession.active()).groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("d")).orderBy("tree").collect()
        return [TreeSize(r["n"], r["d"]) for r in found]

    @property
    def featureImportances(self) -> SparseVector:
        """Per feature the gains of its cuts, weighted by rows; every tree with a cut counts the same."""
        gains = self.forest.nodes(SparkSession.active()).filter(F.col("feature").isNotNull()).groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
        whole = gains.groupBy("tree").agg(F.sum("g").alias("whole"))
        shares = gains.join(whole, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("whole")).alias("share")).collect()  # a row per feature
        total = math.fsum(r["share"] for r in shares)
        return Vectors.sparse(self.forest.width, {r["feature"]: r["share"] / total for r in shares})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        told = cut_lineage(dataset.withColumn("__id", F.monotonically_increasing_id()))
        found = votes(self.forest, told.select("__id", _values(told, self.estimator.getFeaturesCol()).alias("x")))
        share = F.col("votes") / F.col("counted")
        added = {
            self.estimator.getRawPredictionCol(): array_to_vector(F.array(F.col("counted") - F.col("votes"), "votes")),
            self.estimator.getProbabilityCol(): array_to_vector(F.array(1 - share, share)),
            self.estimator.getPredictionCol(): (share > 0.5).cast("double"),
        }
        return told.join(found, "__id").withColumns(added).drop("__id", "votes", "counted")

    def write(self) -> MLWriter:
        return _ForestWriter(self)


class _ForestWriter(MLWriter):
    """Stores a forest as Spark does; the nodes do not pass the driver."""

    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, model = self.sparkSession, self.model
        estimator, count = model.estimator, model.getNumTrees
        plain = lambda params: {p.name: v for p, v in params.items()}
        about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        told = about | {
            "class": "org.apache.spark.ml.classification.RandomForestClassificationModel", "uid": model.uid, "paramMap": plain(estimator._paramMap),
            "defaultParamMap": plain(estimator._defaultParamMap), "numFeatures": model.numFeatures, "numClasses": 2, "numTrees": count,
        }
        spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        of_tree = {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel", "defaultParamMap": {}}
        of_tree |= {"paramMap": {k: v for k, v in told["paramMap"].items() if k in ("maxDepth", "minInstancesPerNode", "featuresCol", "labelCol", "impurity", "seed")}}
        trees = [(t, json.dumps(about | of_tree | {"uid": f"{model.uid}_{t}"}), 1.0) for t in range(count)]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        share, inner = F.try_divide("positives", "n"), F.col("feature").isNotNull()
        split = F.struct(
            F.coalesce("feature", F.lit(-1)).alias("featureIndex"),
            F.when(inner, F.array("cut")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"),
        )
        node = F.struct(
            F.col("node").alias("id"), (share > 0.5).cast("double").alias("prediction"), (2 * share * (1 - share)).alias("impurity"),
            F.array((F.col("n") - F.col("positives")).cast("double"), F.col("positives").cast("double")).alias("impurityStats"), F.col("n").alias("rawCount"),
            F.coalesce("gain", F.lit(-1.0)).alias("gain"), F.coalesce("left", F.lit(-1)).alias("leftChild"), F.coalesce("right", F.lit(-1)).alias("rightChild"),
            split.alias("split"),
        )
        model.forest.nodes(spark).select(F.col("tree").alias("treeID"), node.alias("nodeData")).write.parquet(f"{path}/data")


def fit_model(train: DataFrame, estimator) -> ForestModel:
    """What Spark's ``RandomForestClassifier`` with these settings is for two classes: its rules, with cuts of its number of bins."""
    columns = [estimator.getLabelCol(), estimator.getFeaturesCol()]
    plan = Plan(estimator.getNumTrees(), estimator.getMaxDepth(), 2, estimator.getMinInstancesPerNode(), estimator.getBootstrap())
    keyed = train.select(*columns, F.monotonically_increasing_id().alias("__key"))
    made = grow(keyed, [plan], "__key", *columns, seed=estimator.getSeed(), max_bins=estimator.getMaxBins(), as_spark=True)
    if not made.tops:
        raise ValueError("a forest needs rows with a label and values")
    return ForestModel(made, estimator)


def search_forest(train: DataFrame, choices: list[dict], key: str, folds: int = 5, seed: int = 42, **fixed) -> tuple[dict, DataFrame]:
    """Cross-validated search by accuracy: the best choice, and one (run, params, metric, value) row per choice.

    ``choices`` have the parameters of ``fit_forest``. Those that differ only in trees, depth and split minimum share one fit, the
    largest of them; all folds and fits grow in the same rounds. A value is the mean over the folds; an entity is in one fold with all its rows.
    """
    parted = cut_lineage(with_folds(train, key, folds))
    parts: dict[tuple, list[int]] = {}
    for i, choice in enumerate(choices):
        parts.setdefault((choice.get("min_leaf", 2), choice.get("bootstrap", False)), []).append(i)
    plans, place = [], {}
    for part, runs in parts.items():
        depths = [choices[i].get("depth", 40) for i in runs]
        deepest = None if None in depths else max(depths)
        largest = Plan(max(choices[i].get("trees", 700) for i in runs), deepest, min(choices[i].get("min_split", 10) for i in runs), *part)
        for fold in range(folds):
            place[part, fold] = len(plans)
            plans.append(Plan(*[*vars(largest).values()][:-1], fold))
    model = grow(parted, plans, key, seed=seed, **fixed)
    totals = [0.0] * len(choices)
    for (part, fold), g in place.items() if model.trees else ():
        one, runs = model.of(g), parts[part]
        held = parted.filter((F.col("fold") == fold) & F.col("label").isNotNull())
        told = held.select(F.col("label").cast("int").alias("y"), _values(train, "features").alias("x")).withColumn("t", one.column(train.sparkSession))
        hits = []
        for i in runs:
            c, all_ = choices[i], one.depth()
            depth = all_ if c.get("depth", 40) is None else min(all_, c.get("depth", 40))
            prob = share_of(F.slice("t", 1, c.get("trees", 700)), F.col("x"), depth, c.get("min_split", 10))
            hits.append(F.avg(((prob > 0.5).cast("int") == F.col("y")).cast("double")).alias(str(i)))
        for i, value in zip(runs, told.agg(*hits).first(), strict=True):
            totals[i] += (value or 0.0) / folds
    return choices[max(range(len(choices)), key=totals.__getitem__)], metric_rows(train, choices, "accuracy", totals)
