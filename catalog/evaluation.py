"""Evaluation of prediction tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import SQL, labelled_sql, query, rounded
from wardline.functions.columns import decide, sigmoid
from wardline.operators import evaluate, importance
from wardline.operators.models import class_counts, class_ratio, with_weight
from wardline.sources.tables import cut_lineage

_CURVE = f"""WITH {SQL['pred']},
counts AS (SELECT model, prob, sum(label) AS pos, sum(1 - label) AS neg FROM pred GROUP BY 1, 2),
curve AS (SELECT model, prob AS threshold, pos, neg,
  sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
  sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
  FROM counts WINDOW w AS (PARTITION BY model ORDER BY prob DESC ROWS UNBOUNDED PRECEDING))"""


@query("roc_points", f"{_CURVE}\nSELECT model, round(threshold, 9) AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round(tp / p, 6) AS tpr, round(fp / n, 6) AS fpr FROM curve")
def roc_points(t):
    return rounded(rounded(evaluate.roc_points(t.predictions), "tpr", "fpr"), "threshold", digits=9)


def _auc_sql(groups: str) -> str:
    """Area from mean ranks of the positives."""
    return f"""ranks AS (SELECT {groups}, label,
    rank() OVER (PARTITION BY {groups} ORDER BY prob) + (count(*) OVER (PARTITION BY {groups}, prob) - 1) / 2.0 AS r FROM pred)"""


_AUC_VALUE = "(sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) / nullif(count(*) FILTER (label = 1) * count(*) FILTER (label = 0), 0)"


@query("roc_auc", f"WITH {SQL['pred']}, {_auc_sql('model')}\nSELECT model, round({_AUC_VALUE}, 6) AS value FROM ranks GROUP BY 1")
def roc_auc(t):
    return rounded(evaluate.roc_auc(t.predictions), "value")


@query("auc_per_step", f"WITH {SQL['pred']}, {_auc_sql('model, step')}\nSELECT model, step, round({_AUC_VALUE}, 6) AS auc FROM ranks GROUP BY 1, 2")
def auc_per_step(t):
    return rounded(evaluate.auc_per_step(t.predictions), "auc")


_PR = """points AS (SELECT model, threshold, tp / (tp + fp) AS precision, tp / p AS recall,
  lag(tp / (tp + fp), 1, 1) OVER (PARTITION BY model ORDER BY threshold DESC) AS p0,
  lag(tp / p, 1, 0) OVER (PARTITION BY model ORDER BY threshold DESC) AS r0 FROM curve)"""


@query("pr_points", f"{_CURVE}, {_PR}\nSELECT model, round(threshold, 9) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM points")
def pr_points(t):
    return rounded(rounded(evaluate.pr_points(t.predictions), "precision", "recall"), "threshold", digits=9)


@query("pr_auc", f"{_CURVE}, {_PR}\nSELECT model, round(sum((recall - r0) * (precision + p0) / 2), 6) AS value FROM points GROUP BY 1")
def pr_auc(t):
    return rounded(evaluate.pr_auc(t.predictions), "value")


@query(
    "brier",
    f"""WITH {SQL['pred']}
SELECT model, round(avg((prob - label) * (prob - label)), 3) AS brier, round(avg(label), 6) AS no_skill FROM pred GROUP BY 1""",
)
def brier(t):
    scores = evaluate.brier(t.predictions).withColumnRenamed("value", "brier")
    return scores.join(rounded(evaluate.positive_rate(t.predictions), "value").withColumnRenamed("value", "no_skill"), "model")


_CUT = """gains AS (SELECT model, threshold, tp / p - fp / n AS gain FROM curve),
tops AS (SELECT model, max(gain) AS best FROM gains GROUP BY 1),
cuts AS (SELECT g.model, round(max(threshold), 4) AS cutoff FROM gains g JOIN tops t ON t.model = g.model AND g.gain = t.best GROUP BY 1)"""


@query("youden_cutoff", f"{_CURVE}, {_CUT}\nSELECT model, cutoff FROM cuts")
def youden_cutoff(t):
    return evaluate.youden_cutoff(t.predictions)


@query(
    "youden_confusion_f1",
    f"""{_CURVE}, {_CUT},
said AS (SELECT p.model, label, (prob > cutoff)::INTEGER AS predicted FROM pred p JOIN cuts c ON c.model = p.model)
SELECT model, cutoff, n00, n01, n10, n11, round(2.0 * n11 / (2 * n11 + n01 + n10), 6) AS f1
FROM cuts JOIN (SELECT model, count(*) FILTER (label = 0 AND predicted = 0) AS n00, count(*) FILTER (label = 0 AND predicted = 1) AS n01,
  count(*) FILTER (label = 1 AND predicted = 0) AS n10, count(*) FILTER (label = 1 AND predicted = 1) AS n11 FROM said GROUP BY 1) USING (model)""",
)
def youden_confusion_f1(t):
    """Cut-off, the four confusion counts n<label><predicted> and F1."""
    scanned = cut_lineage(evaluate.curve(t.predictions))
    cuts = cut_lineage(evaluate.curve_cutoff(scanned, ["model"]))
    cells = evaluate.curve_confusion(scanned, cuts, ["model"])
    counts = cells.groupBy("model").agg(
        *[F.sum(F.when((F.col("label") == y) & (F.col("predicted") == p), F.col("n"))).alias(f"n{y}{p}") for y in (0, 1) for p in (0, 1)]
    )
    return cuts.join(counts, "model").join(rounded(evaluate.f1(cells), "value").withColumnRenamed("value", "f1"), "model")


# The edges once more, for the oracle.
_CALIBRATION = "0.100000001 0.200000002 0.300000003 0.400000004 0.500000005 0.600000006 0.700000007 0.800000008 0.900000009".split()
_UNIT = "0.1 0.2 0.30000000000000004 0.4 0.5 0.6000000000000001 0.7000000000000001 0.8 0.9".split()


def _bin_sql(edges: list[str], prob: str = "prob") -> str:
    return " + ".join(f"({prob} >= {edge}e0)::INTEGER" for edge in edges)


@query(
    "calibration",
    f"""WITH {SQL['pred']}
SELECT model, {_bin_sql(_CALIBRATION)} AS bin, round(avg(prob), 6) AS prob_mean, round(avg(label), 6) AS label_rate FROM pred GROUP BY 1, 2""",
)
def calibration(t):
    return rounded(evaluate.calibration(t.predictions), "prob_mean", "label_rate")


_BINS = f"""WITH {SQL['pred']}, linear AS (SELECT model, label, least(prob * prob, 0.35e0) AS prob FROM pred),
binned AS (SELECT model, {_bin_sql(_CALIBRATION)} AS bin FROM linear),
totals AS (SELECT m.model, b.bin, count(x.bin) AS n FROM (SELECT DISTINCT model FROM pred) m CROSS JOIN (SELECT unnest(range(10)) AS bin) b
  LEFT JOIN binned x ON x.model = m.model AND x.bin = b.bin GROUP BY 1, 2)"""


def _bounded(t):
    """Probabilities that leave the upper bins empty."""
    return t.predictions.withColumn("prob", F.least(F.col("prob") * F.col("prob"), F.lit(0.35)))


@query("bin_totals", f"{_BINS}\nSELECT model, bin::INTEGER AS bin, n FROM totals")
def bin_totals(t):
    return evaluate.bin_totals(_bounded(t))


@query("missing_bins", f"{_BINS}\nSELECT model, string_agg((bin * 10 + 5) || '%', ', ' ORDER BY bin) FILTER (n = 0) AS missing FROM totals GROUP BY 1")
def missing_bins(t):
    return evaluate.missing_bins(_bounded(t))


def _histogram_sql(groups: list[str]) -> str:
    g = ", ".join(groups)
    same = " AND ".join(f"x.{c} = m.{c}" for c in groups)
    return f"""WITH {SQL['pred']}, binned AS (SELECT {g}, {_bin_sql(_UNIT)} AS bin FROM pred),
sizes AS (SELECT {g}, count(*) AS total FROM pred GROUP BY ALL)
SELECT {', '.join('m.' + c for c in groups)}, b.bin::INTEGER AS bin, count(x.bin) AS n, round(count(x.bin) / max(total), 6) AS share
FROM sizes m CROSS JOIN (SELECT unnest(range(10)) AS bin) b LEFT JOIN binned x ON {same} AND x.bin = b.bin GROUP BY ALL"""


@query("prob_histogram", _histogram_sql(["model"]))
def prob_histogram(t):
    return rounded(evaluate.histogram(t.predictions), "share")


@query("class_histogram", _histogram_sql(["model", "label"]))
def class_histogram(t):
    return rounded(evaluate.class_histogram(t.predictions), "share")


@query(
    "compare_models",
    f"""WITH {SQL['pred']},
stacked AS (SELECT 'odds' AS model, label, prob FROM pred UNION ALL SELECT 'inverse', label, 1 - prob FROM pred UNION ALL SELECT 'square', label, prob * prob FROM pred)
SELECT model, {_bin_sql(_CALIBRATION)} AS bin, round(avg(prob), 6) AS prob_mean, round(avg(label), 6) AS label_rate FROM stacked GROUP BY 1, 2""",
)
def compare_models(t):
    """Calibration of three models side by side."""
    base = t.predictions.select("label", "prob")
    p = F.col("prob")
    stacked = evaluate.compare({"odds": base, "inverse": base.withColumn("prob", 1 - p), "square": base.withColumn("prob", p * p)})
    return rounded(evaluate.calibration(stacked), "prob_mean", "label_rate")


@query(
    "before_onset_eval",
    f"""WITH {SQL['pred']},
picked AS (SELECT model, stay_id, max(label) AS label,
  coalesce(arg_min(prob, charttime) FILTER (label = 1), arg_max(prob, charttime)) AS prob,
  coalesce(min(charttime) FILTER (label = 1), max(charttime)) AS charttime FROM pred GROUP BY 1, 2)
SELECT model, stay_id, charttime, label, round(prob, 6) AS prob FROM picked""",
)
def before_onset_eval(t):
    return rounded(evaluate.before_onset(t.predictions, "stay_id", "charttime"), "prob")


@query(
    "continuous_vs_onset",
    f"""WITH {SQL['pred']}, {_auc_sql('model')}
SELECT model, round({_AUC_VALUE}, 6) AS continuous,
  any_value(b.brier) AS onset_brier FROM ranks
JOIN (SELECT model, round(avg((prob - label) * (prob - label)), 3) AS brier FROM (
  SELECT model, stay_id, max(label) AS label, coalesce(arg_min(prob, charttime) FILTER (label = 1), arg_max(prob, charttime)) AS prob
  FROM pred GROUP BY 1, 2) GROUP BY 1) b USING (model) GROUP BY 1""",
)
def continuous_vs_onset(t):
    """Area over all steps next to the Brier score of one row per stay."""
    onset = evaluate.brier(evaluate.before_onset(t.predictions, "stay_id", "charttime")).withColumnRenamed("value", "onset_brier")
    return rounded(evaluate.roc_auc(t.predictions), "value").withColumnRenamed("value", "continuous").join(onset, "model")


@query(
    "padded_evaluation",
    f"""WITH {SQL['pred']},
own AS (SELECT model, stay_id, step, label, prob FROM pred),
lasts AS (SELECT model, stay_id, max(step) AS last FROM own GROUP BY 1, 2),
padded AS (SELECT * FROM own UNION ALL SELECT model, stay_id, unnest(range(last + 1, 41)), 0, 0.5 FROM lasts)
SELECT model, count(*) AS n, round(avg(label), 6) AS positive, round(avg((prob - label) * (prob - label)), 6) AS brier FROM padded GROUP BY 1""",
)
def padded_evaluation(t):
    """Counting the padding up to 40 steps as negatives."""
    padded = evaluate.pad_steps(t.predictions, "stay_id", 40)
    loss = F.pow(F.col("prob") - F.col("label"), F.lit(2.0))
    out = padded.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("positive"), F.avg(loss).alias("brier"))
    return rounded(out, "positive", "brier")


@query(
    "weighted_logloss",
    f"""WITH {SQL['pred']}
SELECT model, round(avg(-(3.0 * label * ln(least(greatest(prob, 1e-12), 1 - 1e-12)) + (1 - label) * ln(1 - least(greatest(prob, 1e-12), 1 - 1e-12)))), 6) AS value FROM pred GROUP BY 1""",
)
def weighted_logloss(t):
    return rounded(evaluate.weighted_log_loss(t.predictions, 3.0), "value")


@query(
    "class_balance",
    f"""WITH {labelled_sql()}, c AS (SELECT label, count(*) AS n FROM labelled GROUP BY 1)
SELECT label, n, round((SELECT sum(n) FROM c) / (2.0 * n), 6) AS weight,
  round((SELECT n FROM c WHERE label = 0) / (SELECT n FROM c WHERE label = 1), 1) AS ratio FROM c""",
)
def class_balance(t):
    from catalog.timeline import labelled_grid

    rows = labelled_grid(t).select("label")
    weights = with_weight(rows).groupBy("label").agg(F.max("weight").alias("weight"))
    counted = class_counts(rows).join(rounded(weights, "weight"), "label")
    return counted.withColumn("ratio", class_ratio(rows).scalar())


@query(
    "topk_abs",
    f"""WITH {SQL['log']}, f AS (SELECT n_name AS feature, sum(c_acctbal - 4500) AS importance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT feature, round(importance, 4) AS importance FROM f ORDER BY abs(importance) DESC, feature LIMIT 10""",
)
def topk_abs(t):
    named = t.read("customer").join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    totals = named.groupBy(F.col("n_name").alias("feature")).agg(F.sum(F.col("c_acctbal") - 4500).alias("importance"))
    return rounded(importance.top(totals, 10), "importance", digits=4)


@query(
    "sigmoid_decision",
    f"""WITH {SQL['log']}, scored AS (SELECT event_id, 1 / (1 + exp(-(value - 50) / 25)) AS prob FROM log)
SELECT event_id, round(prob, 6) AS prob, (prob > 0.5)::INTEGER AS predicted FROM scored""",
)
def sigmoid_decision(t):
    """Logits to probabilities, and the decision strictly above a cut-off."""
    scored = t.log.select("event_id", sigmoid((F.col("value") - 50) / 25).alias("prob"))
    return rounded(scored.withColumn("predicted", decide(F.col("prob"), F.lit(0.5))), "prob")
