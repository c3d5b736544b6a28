"""Model queries, with the parameters of the library.

Training has no SQL counterpart, but its facts have: which stays are predicted and with which label,
that a probability is what the model's coefficients say, that a fit meets the conditions of an
optimum, that a search tried every choice. They are columns of the results.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Window, functions as F

from catalog.registry import labelled_sql, query, rounded
from catalog.timeline import FIRST_ONSET, KEY, TS, labelled_grid
from wardline.operators import boosting, evaluate, features, forest as forests, grid, importance, models, sequences
from wardline.operators.cohort import assign_split
from wardline.operators.labels import first_onset
from wardline.plans import study
from wardline.sources.tables import cut_lineage, shared_folder

# The stage to predict: about half of the stays reach it.
STAGE = 3
FEATURES = ["value_mean", "value_max"]
HISTORY = [f"{c}_{k}" for c in FEATURES for k in ("lag1", "lag4", "mean8")]


def flat_set(t):
    """One flat vector per stay, scaled on the training stays, with its split."""
    rows = cut_lineage(first_onset(labelled_grid(t, STAGE), KEY, TS, "label").fillna(0, subset=FEATURES))
    rows = assign_split(rows, KEY)
    bounds = features.fit_scaler(rows.filter(F.col("split") == "train"), FEATURES, FEATURES)
    scaled = features.apply_scaler(rows, bounds, FEATURES, FEATURES)
    return cut_lineage(sequences.to_vectors(scaled, KEY, TS, FEATURES, carry=["label", "split"]))


def _part(rows, *names):
    return rows.filter(F.col("split").isin(*names))


def _scaled_sql(column: str) -> str:
    bounded = f"least(greatest({column}, {column}_lo), {column}_hi)"
    low = f"least(greatest({column}_min, {column}_lo), {column}_hi)"
    high = f"least(greatest({column}_max, {column}_lo), {column}_hi)"
    return f"({bounded} - {low}) / ({high} - {low}) AS {column}"


_BOUNDS = ", ".join(
    f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi, min({c}) AS {c}_min, max({c}) AS {c}_max"
    for c in FEATURES
)
_SPLIT = """CASE WHEN position <= total - ceil(0.2 * total) THEN 'train'
    WHEN position <= total - ceil(0.5 * ceil(0.2 * total)) THEN 'valid' ELSE 'test' END AS split"""
_ROWS = f"""WITH {labelled_sql(STAGE)}, {FIRST_ONSET},
ids AS (SELECT DISTINCT stay_id FROM truncated),
ranked AS (SELECT stay_id, row_number() OVER (ORDER BY md5(stay_id || '|42'), stay_id) AS position, count(*) OVER () AS total FROM ids),
rows AS (SELECT t.stay_id, label, coalesce(value_mean, 0) AS value_mean, coalesce(value_max, 0) AS value_max,
    row_number() OVER (PARTITION BY t.stay_id ORDER BY charttime) - 1 AS step, {_SPLIT}
  FROM truncated t JOIN ranked r ON r.stay_id = t.stay_id),
stays AS (SELECT DISTINCT stay_id, label, split FROM rows)"""
_CELLS = f"""{_ROWS},
bounds AS (SELECT {_BOUNDS} FROM rows WHERE split = 'train'),
scaled AS (SELECT stay_id, step, {', '.join(_scaled_sql(c) for c in FEATURES)} FROM rows, bounds),
places AS (SELECT * FROM stays CROSS JOIN (SELECT unnest(range(max(step) + 1)) AS step FROM rows) CROSS JOIN (SELECT unnest([0, 1]) AS f)),
cells AS (
  SELECT p.stay_id, label, split, p.step, f, coalesce(CASE f WHEN 0 THEN value_mean ELSE value_max END, 0) AS value
  FROM places p LEFT JOIN scaled s ON s.stay_id = p.stay_id AND s.step = p.step)"""


@query(
    "vectors",
    f"""{_CELLS}
SELECT stay_id, label, split, (step * 2 + f)::INTEGER AS pos, round(value, 6) AS value FROM cells""",
)
def vectors(t):
    """The flat vectors of the model queries, one row per position."""
    flat = flat_set(t)
    return rounded(flat.select(KEY, "label", "split", F.posexplode(vector_to_array("features")).alias("pos", "value")), "value")


def _is_optimal(model, rows, C: float, slack: float = 2e-3) -> bool:
    """Conditions of the weighted L1 optimum: no slope at the intercept, a slope of the penalty at every coefficient."""
    weighted = models.with_weight(rows)
    p = vector_to_array("probability")[1]
    scored = model.transform(weighted).select("weight", (F.col("weight") * (p - F.col("label"))).alias("r"), vector_to_array("features").alias("x"))
    total, intercept = scored.agg(F.sum("weight"), F.sum("r")).first()
    slopes = scored.select("r", F.posexplode("x").alias("pos", "v")).groupBy("pos").agg((F.sum(F.col("r") * F.col("v")) / total).alias("g"))
    penalty = 1.0 / (C * total)
    fitted = model.stages[0].coefficients.toArray()
    if abs(intercept / total) > slack:
        return False
    for pos, g in slopes.collect():  # a row per position of the vector
        gap = abs(g) - penalty if fitted[pos] == 0 else abs(g + penalty * (1 if fitted[pos] > 0 else -1))
        if gap > slack:
            return False
    return True


@query("logreg", f"{_ROWS}\nSELECT stay_id, label, true AS consistent, true AS optimal FROM stays WHERE split = 'test'")
def logreg(t):
    """L1 logistic regression: test stays, their probability recomputed from the coefficients, and the optimum."""
    rows = flat_set(t)
    learnt = _part(rows, "train", "valid")
    model = models.fit_logistic(learnt, **models.LOGISTIC)
    inner = model.stages[0]
    coefficients = F.array(*[F.lit(float(c)) for c in inner.coefficients.toArray()])
    terms = F.zip_with(vector_to_array("features"), coefficients, lambda x, c: x * c)
    linear = F.aggregate(terms, F.lit(float(inner.intercept)), lambda a, v: a + v)
    test = _part(rows, "test")
    expected = test.select(KEY, (1 / (1 + F.exp(-linear))).alias("expected"))
    pred = models.predict(model, test, "logistic", [KEY]).join(expected, KEY)
    optimal = _is_optimal(model, learnt, models.LOGISTIC["C"])
    return pred.select(KEY, "label", (F.abs(F.col("prob") - F.col("expected")) < 1e-9).alias("consistent"), F.lit(optimal).alias("optimal"))


@query(
    "logreg_importance",
    f"""{_CELLS},
coef AS (SELECT step, f, avg(value) FILTER (label = 1) - avg(value) FILTER (label = 0) AS c FROM cells WHERE split <> 'test' GROUP BY 1, 2),
means AS (SELECT step, f, avg(value) AS m FROM cells GROUP BY 1, 2)
SELECT CASE f WHEN 0 THEN 'value_mean' ELSE 'value_max' END AS feature,
  round(avg(exp(c)) * CASE WHEN avg(c) < 0 THEN -1 ELSE 1 END, 6) AS importance, round(avg(c * m), 6) AS attribution
FROM coef JOIN means USING (step, f) GROUP BY f""",
)
def logreg_importance(t):
    """Signed odds ratios and mean attributions per feature, of the linear model of class mean differences."""
    rows = flat_set(t)
    means = _part(rows, "train", "valid").groupBy("label").agg(Summarizer.mean(F.col("features")).alias("m")).collect()
    by_label = {r["label"]: r["m"].toArray() for r in means}
    coefficients = Vectors.dense(by_label[1] - by_label[0])
    odds = importance.signed_odds(importance.position_values(t.spark, coefficients, FEATURES))
    given = importance.linear_attribution(rows, coefficients, FEATURES).withColumnRenamed("importance", "attribution")
    return rounded(odds.join(given, "feature"), "importance", "attribution")


_TREES = f"{_ROWS}\nSELECT stay_id, label, true AS in_range, true AS learnt, true AS adds_up FROM stays WHERE split = 'test'"


def _tree_facts(model, rows, name: str):
    """Test stays, whether probabilities are in range, the area on the training stays is above one half, and importances add up.

    Trees without a single split, which very few stays leave, have no importances and learn nothing.
    """
    split = any(tree.numNodes > 1 for tree in model.stages[0].trees)
    area = evaluate.roc_auc(models.predict(model, _part(rows, "train"), name, [])).first()["value"]
    adds_up = abs(sum(model.stages[0].featureImportances.toArray()) - split) < 1e-9
    pred = models.predict(model, _part(rows, "test"), name, [KEY])
    learnt = area is None or area > 0.5 or not split
    return pred.select(KEY, "label", F.col("prob").between(0, 1).alias("in_range"), F.lit(learnt).alias("learnt"), F.lit(adds_up).alias("adds_up"))


@query("gbt", _TREES)
def gbt(t):
    """Boosted trees whose rounds end by the validation stays."""
    rows = flat_set(t)
    return _tree_facts(models.fit_boosted(_part(rows, "train"), _part(rows, "valid"), **models.BOOSTED), rows, "boosted")


@query("forest", _TREES)
def forest(t):
    rows = flat_set(t)
    return _tree_facts(models.fit_forest(_part(rows, "train", "valid"), **models.FOREST), rows, "forest")


@query("forest_importance", "SELECT unnest(['value_max', 'value_mean']) AS feature, true AS rolled_up, true AS adds_up")
def forest_importance(t):
    """The roll-up of a forest's importances over the steps, compared with a sum in the driver."""
    rows = flat_set(t)
    found = models.fit_forest(_part(rows, "train", "valid"), **models.FOREST).stages[0].featureImportances
    ranked = importance.top(importance.total_importance(importance.position_values(t.spark, found, FEATURES)), 10)
    sums = {f: float(found.toArray()[i :: len(FEATURES)].sum()) for i, f in enumerate(FEATURES)}
    expected = F.create_map(*[F.lit(x) for pair in sums.items() for x in pair])[F.col("feature")]
    whole = F.abs(F.sum("importance").over(Window.partitionBy()) - 1) < 1e-9
    return ranked.select("feature", (F.abs(F.col("importance") - expected) < 1e-9).alias("rolled_up"), whole.alias("adds_up"))


_CHOICES = """SELECT (row_number() OVER (ORDER BY c.i, b.i, p.i) - 1)::INTEGER AS run,
  '{"C":"' || c.v || '","fit_intercept":"' || b.v || '","penalty":"' || p.v || '"}' AS params, METRIC AS metric, true AS in_range, true AS best_is_largest
FROM (VALUES (0, '0.001'), (1, '0.01'), (2, '0.1'), (3, '1'), (4, '10'), (5, '100')) c(i, v),
  (VALUES (0, 'True'), (1, 'False')) b(i, v), (VALUES (0, 'l1'), (1, 'l2')) p(i, v)"""


def _sorted_json(params: str):
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(params))))


def _search_facts(model, metrics, choices):
    """Every choice with its metric in range; the model kept is one of those with the largest."""
    metrics = cut_lineage(metrics)
    largest = metrics.agg(F.max("value")).first()[0]
    best = [r["run"] for r in metrics.filter(F.col("value") == largest).collect()]
    inner = model.stages[0]
    kept = any(
        inner.getFitIntercept() == choices[i]["fit_intercept"] and inner.getElasticNetParam() == (1.0 if choices[i]["penalty"] == "l1" else 0.0)
        for i in best
    )
    return metrics.select("run", _sorted_json("params").alias("params"), "metric", F.col("value").between(0, 1).alias("in_range"), F.lit(kept).alias("best_is_largest"))


@query("random_search_cv", _CHOICES.replace("METRIC", "'accuracy'"))
def random_search_cv(t):
    """The published search: 25 draws, which are all 24 choices, five folds by stay, balanced weights."""
    choices = models.sample_grid(models.LOGISTIC_GRID, 25, seed=42)
    model, metrics = models.random_search(models.logistic(1.0), choices, _part(flat_set(t), "train", "valid"), KEY, scheme="balanced", parallelism=8)
    return _search_facts(model, metrics, choices)


@query("grid_search_auc", _CHOICES.replace("METRIC", "'auc'"))
def grid_search_auc(t):
    """All choices, judged on the validation stays by the area."""
    rows, choices = flat_set(t), models.sample_grid(models.LOGISTIC_GRID, None)
    model, metrics = models.grid_search(models.logistic(1.0), choices, _part(rows, "train"), _part(rows, "valid"), scheme="balanced", parallelism=8)
    return _search_facts(model, metrics, choices)


def _rounded_set(t):
    """The flat set with the values as an array, rounded so that equal ones are equal in SQL too."""
    rows = flat_set(t).withColumn("features", F.transform(vector_to_array("features"), lambda v: F.round(v, 9)))
    return cut_lineage(rows)


_FIRST_SPLIT = f"""{_CELLS},
c AS (SELECT stay_id, label, step * 2 + f AS pos, round(value, 9) AS v FROM cells WHERE split = 'train'),
r AS (SELECT coalesce(round(count(*) FILTER (label = 0)::DOUBLE / nullif(count(*) FILTER (label = 1), 0), 1), 1.0) AS ratio FROM stays WHERE split = 'train'),
s AS (SELECT pos, v, CASE label WHEN 1 THEN -0.5 * ratio ELSE 0.5 END AS g, CASE label WHEN 1 THEN 0.25 * ratio ELSE 0.25 END AS h FROM c, r),
b AS (SELECT pos, v, sum(g) AS g, sum(h) AS h FROM s GROUP BY 1, 2),
u AS (SELECT pos, v, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY pos) AS g, sum(h) OVER (PARTITION BY pos) AS h
  FROM b WINDOW w AS (PARTITION BY pos ORDER BY v)),
e AS (SELECT *, round(gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1), 9) AS gain FROM u WHERE hl >= 3 AND h - hl >= 3),
best AS (SELECT * FROM e WHERE gain > 1e-6 ORDER BY gain DESC, pos, v LIMIT 1),
root AS (SELECT sum(g) AS g, sum(h) AS h FROM b WHERE pos = 0)"""


@query(
    "boosted_first_split",
    f"""{_FIRST_SPLIT}
SELECT 1 AS node, pos::INTEGER AS feature, round(v, 6) AS cut, round(gain, 6) AS gain, round(root.h, 6) AS cover, round(-root.g / (root.h + 1) * 0.1, 6) AS value
FROM root LEFT JOIN best ON true
UNION ALL SELECT 2, NULL, NULL, NULL, round(hl, 6), round(-gl / (hl + 1) * 0.1, 6) FROM best
UNION ALL SELECT 3, NULL, NULL, NULL, round(h - hl, 6), round(-(g - gl) / (h - hl + 1) * 0.1, 6) FROM best""",
)
def boosted_first_split(t):
    """The first split of second-order boosting on the training stays: feature, cut, gain, summed Hessians and leaf values."""
    rows = _part(_rounded_set(t), "train")
    model = boosting.fit_trees(rows, key=KEY, trees=1, depth=1, gamma=0, rows=1.0, columns=1.0, min_child=3)
    table = model.table(t.spark).select("node", "feature", "cut", "gain", "cover", "value")
    return rounded(table, "cut", "gain", "cover", "value")


@query(
    "boosted_attribution",
    f"""{_FIRST_SPLIT},
node AS (SELECT pos, v AS cut, -gl / (hl + 1) * 0.1 AS lower, -(g - gl) / (h - hl + 1) * 0.1 AS upper, hl, h FROM best),
root_value AS (SELECT coalesce((SELECT (lower * hl + upper * (h - hl)) / h FROM node), -g / (h + 1) * 0.1) AS expected FROM root)
SELECT stay_id, NULL::INTEGER AS feature, round(expected, 6) AS value FROM stays, root_value WHERE split = 'test'
UNION ALL
SELECT stay_id, n.pos::INTEGER, round(CASE WHEN round(value, 9) <= cut THEN lower ELSE upper END - expected, 6)
FROM cells t JOIN node n ON step * 2 + f = n.pos, root_value WHERE t.split = 'test'""",
)
def boosted_attribution(t):
    """What the first split adds to each test stay, and the expected value of the root."""
    rows = _rounded_set(t)
    model = boosting.fit_trees(_part(rows, "train"), key=KEY, trees=1, depth=1, gamma=0, rows=1.0, columns=1.0, min_child=3)
    return rounded(boosting.attributions(model, _part(rows, "test"), [KEY]), "value")


_FOREST_FIRST = f"""{_CELLS},
c AS (SELECT label, step * 2 + f AS pos, round(value, 9) AS v FROM cells WHERE split <> 'test'),
size AS (SELECT max(pos) + 1 AS width, greatest(1, floor(sqrt(max(pos) + 1))) AS taken FROM c),
b AS (SELECT pos, v, count(*) AS n, sum(label) AS p FROM c GROUP BY 1, 2),
u AS (SELECT pos, v, sum(n) OVER w AS nl, sum(p) OVER w AS pl, sum(n) OVER (PARTITION BY pos) AS n, sum(p) OVER (PARTITION BY pos) AS p
  FROM b WINDOW w AS (PARTITION BY pos ORDER BY v)),
e AS (SELECT *, round((2.0 * p * (n - p) / n - 2.0 * pl * (nl - pl) / nl - 2.0 * (p - pl) * (n - nl - p + pl) / (n - nl)) / n, 9) AS gain
  FROM u WHERE nl >= 2 AND n - nl >= 2 AND n >= 10 AND p > 0 AND p < n),
per AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY gain DESC, v) AS k FROM e) WHERE k = 1),
tree AS (SELECT unnest(range(700)) AS tree),
drawn AS (SELECT tree, pos, row_number() OVER (PARTITION BY tree ORDER BY md5('42|' || tree || '||' || pos)) > taken AS later, width
  FROM tree, size, (SELECT DISTINCT pos FROM c)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY later, gain DESC, pos) AS place FROM drawn JOIN per USING (pos)) WHERE place = 1),
root AS (SELECT sum(n) AS n, sum(p) AS p FROM b WHERE pos = 0)
SELECT tree::INTEGER AS tree, root.n::BIGINT AS n, root.p::BIGINT AS positives, pos::INTEGER AS feature, round(v, 6) AS cut, round(gain, 6) AS gain,
  nl::BIGINT AS lower_n, pl::BIGINT AS lower_positives, (root.n - nl)::BIGINT AS upper_n, (root.p - pl)::BIGINT AS upper_positives, true AS bounds_kept
FROM tree LEFT JOIN best USING (tree), root"""


@query("forest_first_splits", _FOREST_FIRST)
def forest_first_splits(t):
    """The published forest (depth 40, split minimum 10): first split of every tree, and whether all nodes keep the bounds."""
    model = forests.fit_forest(_part(_rounded_set(t), "train", "valid"), key=KEY, **forests.FOREST)
    nodes = cut_lineage(model.table(t.spark))
    inner = F.col("left").isNotNull()
    kept = (F.col("n") >= F.when(F.col("node") > 0, 2).otherwise(0)) & (F.col("depth") <= 40) & (~inner | (F.col("n") >= 10))
    bounds = nodes.groupBy("tree").agg(F.bool_and(kept).alias("bounds_kept"))
    root = nodes.filter("depth = 0").drop("depth", "node")
    child = lambda side, name: nodes.select("tree", F.col("node").alias(side), F.col("n").alias(f"{name}_n"), F.col("positives").alias(f"{name}_positives"))
    whole = root.join(child("left", "lower"), ["tree", "left"], "left").join(child("right", "upper"), ["tree", "right"], "left")
    return rounded(whole.drop("left", "right").join(bounds, "tree"), "cut", "gain")


def continuous_set(t):
    """A row per grid step with features of the stay's history so far."""
    made = grid.history_features(labelled_grid(t, STAGE), KEY, TS, FEATURES, [1, 4], [8])
    inputs = FEATURES + HISTORY
    filled = cut_lineage(grid.step_index(made, KEY, TS).fillna(0, subset=inputs))
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(assign_split(filled, KEY))
    return cut_lineage(assembled.select(KEY, TS, "step", "label", "split", "features"))


@query(
    "continuous_scoring",
    f"""WITH {labelled_sql(STAGE)},
ids AS (SELECT DISTINCT stay_id FROM labelled),
ranked AS (SELECT stay_id, row_number() OVER (ORDER BY md5(stay_id || '|42'), stay_id) AS position, count(*) OVER () AS total FROM ids),
rows AS (SELECT l.stay_id, label, row_number() OVER (PARTITION BY l.stay_id ORDER BY charttime) AS step, {_SPLIT}
  FROM labelled l JOIN ranked r ON r.stay_id = l.stay_id)
SELECT step::INTEGER AS step, sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives,
  sum(label) > 0 AND sum(1 - label) > 0 AS has_area FROM rows WHERE split = 'test' GROUP BY 1""",
)
def continuous_scoring(t):
    """A probability at every grid step of the test stays: cases per step, and whether the step has an area."""
    rows = continuous_set(t)
    model = models.fit_logistic(_part(rows, "train"), **models.LOGISTIC)
    scored = cut_lineage(models.predict(model, _part(rows, "test"), "history", [KEY, TS, "step"]))
    cases = scored.groupBy("step").agg(F.sum("label").alias("positives"), F.sum(1 - F.col("label")).alias("negatives"))
    areas = evaluate.auc_per_step(scored, by=[]).select("step", F.col("auc").isNotNull().alias("has_area"))
    return cases.join(areas, "step")


@query("model_roundtrip", f"{_ROWS}\nSELECT stay_id, label, true AS same, true AS best FROM stays WHERE split = 'test'")
def model_roundtrip(t):
    """Keep the better of two models by validation area, store it, load it, predict as before."""
    rows = flat_set(t)
    train, valid, test = _part(rows, "train"), _part(rows, "valid"), _part(rows, "test")
    path = shared_folder(t.spark)
    candidates = {p: models.fit_logistic(train, **(models.LOGISTIC | {"penalty": p})) for p in ("l1", "l2")}
    areas = {p: evaluate.roc_auc(models.predict(m, valid, p, [])).first()["value"] for p, m in candidates.items()}
    best, _ = models.keep_best(candidates, valid, path)
    before = models.predict(candidates[best], test, best, [KEY]).select(KEY, F.col("prob").alias("before"))
    loaded = models.predict(models.load_model(path), test, best, [KEY]).join(before, KEY)
    return loaded.select(KEY, "label", (F.col("prob") == F.col("before")).alias("same"), F.lit(areas[best] == max(areas.values(), key=lambda a: a or 0)).alias("best"))


@query(
    "baseline_report",
    f"""{_ROWS},
share AS (SELECT round(avg(label), 6) AS rate FROM stays WHERE split = 'test')
SELECT model, metric, CASE metric WHEN 'no_skill' THEN rate END AS no_skill, true AS in_range
FROM share, (SELECT unnest(['logistic', 'boosted', 'forest']) AS model), (SELECT unnest(['roc_auc', 'pr_auc', 'brier', 'no_skill', 'f1']) AS metric)""",
)
def baseline_report(t):
    """Scores of the three baseline models on the test stays; areas are null if these have one class only."""
    pred = cut_lineage(study.baseline_predictions(flat_set(t)))
    scores = study.report(pred)["scores"]
    one_class = pred.agg(F.count_distinct("label")).first()[0] < 2
    in_range = F.coalesce(F.col("value").between(0, 1), F.lit(one_class) & F.col("metric").endswith("auc"))
    return scores.select(
        "model", "metric", F.when(F.col("metric") == "no_skill", F.round("value", 6)).alias("no_skill"), in_range.alias("in_range")
    )
