"""Grid, labels, imputation, scaling and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import SQL, grid_sql, labelled_sql, query, rounded
from wardline.functions.columns import midpoint
from wardline.operators import features, grid, labels, sequences
from wardline.operators.cohort import assign_split
from wardline.sources.tables import cut_lineage

KEY, TS = "stay_id", "charttime"
GRID = {"value_mean": "mean", "value_max": "max", "stage": "max"}


def event_log(t):
    return t.log.select(KEY, TS, F.col("value").alias("value_mean"), F.col("value").alias("value_max"), "stage")


def event_grid(t):
    return grid.resample(event_log(t), KEY, TS, 6, GRID)


def labelled_grid(t, threshold=1):
    """Grid rows with the 48 hour label."""
    filled = grid.forward_fill(event_grid(t), KEY, TS, ["stage"], 16, 6).fillna(0, subset=["stage"])
    return labels.shift_label(filled, KEY, TS, "stage", 48, 6, threshold).withColumnRenamed("stage", "label")


@query("bucket_agg", f"WITH {grid_sql()} SELECT stay_id, charttime, round(value_mean, 6) AS value_mean, value_max, stage FROM buckets")
def bucket_agg(t):
    return rounded(grid.bucket_aggregate(event_log(t), KEY, TS, 6, GRID), "value_mean")


@query("resample_gapfill", f"WITH {grid_sql()} SELECT stay_id, charttime, round(value_mean, 6) AS value_mean, value_max, stage FROM grid")
def resample_gapfill(t):
    return rounded(event_grid(t), "value_mean")


_MODAL = """coarse AS (SELECT user_id AS stay_id, time_bucket(INTERVAL '6 hours', ts) AS charttime, floor(value / 20) AS level FROM events),
counted AS (SELECT stay_id, charttime, level, count(*) AS n FROM coarse GROUP BY 1, 2, 3),
modal AS (SELECT stay_id, charttime, level FROM counted
  QUALIFY row_number() OVER (PARTITION BY stay_id, charttime ORDER BY n DESC, level) = 1),
slots AS (SELECT stay_id, unnest(generate_series(min(charttime), max(charttime), INTERVAL '6 hours')) AS charttime FROM modal GROUP BY 1)"""


@query(
    "resample_mode",
    f"WITH {_MODAL}\nSELECT s.stay_id, s.charttime, level FROM slots s LEFT JOIN modal m ON m.stay_id = s.stay_id AND m.charttime = s.charttime",
)
def resample_mode(t):
    coarse = t.log.select(KEY, TS, F.floor(F.col("value") / 20).cast("double").alias("level"))
    return grid.resample(coarse, KEY, TS, 6, {"level": "mode"})


@query(
    "group_mode",
    """WITH c AS (SELECT user_id AS stay_id, floor(value / 10) AS level, count(*) AS n FROM events GROUP BY 1, 2)
SELECT stay_id, level FROM c QUALIFY row_number() OVER (PARTITION BY stay_id ORDER BY n DESC, level) = 1""",
)
def group_mode(t):
    coarse = t.log.select(KEY, F.floor(F.col("value") / 10).cast("double").alias("level"))
    return grid.group_mode(coarse, [KEY], ["level"])


@query(
    "ffill_limit",
    f"""WITH {grid_sql()}
SELECT stay_id, charttime,
  round(last_value(value_mean IGNORE NULLS) OVER w, 6) AS value_mean, last_value(stage IGNORE NULLS) OVER w AS stage
FROM grid WINDOW w AS (PARTITION BY stay_id ORDER BY charttime ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def ffill_limit(t):
    filled = grid.forward_fill(event_grid(t), KEY, TS, ["value_mean", "stage"], 2, 6)
    return rounded(filled.select(KEY, TS, "value_mean", "stage"), "value_mean")


@query("label_lead", f"WITH {labelled_sql()} SELECT stay_id, charttime, round(value_mean, 6) AS value_mean, label FROM labelled")
def label_lead(t):
    return rounded(labelled_grid(t).select(KEY, TS, "value_mean", "label"), "value_mean")


FIRST_ONSET = """cutoffs AS (
  SELECT stay_id, coalesce(min(charttime) FILTER (label = 1), max(charttime)) AS cutoff, max(label) AS final FROM labelled GROUP BY 1),
truncated AS (
  SELECT l.stay_id, l.charttime, l.value_mean, l.value_max, final AS label
  FROM labelled l JOIN cutoffs c ON c.stay_id = l.stay_id AND l.charttime <= c.cutoff)"""


@query("first_onset", f"WITH {labelled_sql()}, {FIRST_ONSET} SELECT stay_id, charttime, round(value_mean, 6) AS value_mean, label FROM truncated")
def first_onset(t):
    return rounded(labels.first_onset(labelled_grid(t), KEY, TS, "label").select(KEY, TS, "value_mean", "label"), "value_mean")


@query(
    "onset_cutoff",
    """WITH c AS (SELECT user_id, coalesce(min(ts) FILTER (event_type = 'error' AND value > 200), max(ts)) AS cutoff FROM events GROUP BY 1)
SELECT e.user_id AS stay_id, event_id FROM events e JOIN c ON c.user_id = e.user_id AND ts <= cutoff""",
)
def onset_cutoff(t):
    """The same on raw events, where an entity may have any number of rows."""
    marked = t.log.withColumn("label", ((F.col("event_type") == "error") & (F.col("value") > 200)).cast("int"))
    return labels.cut_at(marked, labels.onset_cutoffs(marked, KEY, TS, "label"), KEY, TS).select(KEY, "event_id")


@query("last_observation", f"WITH {labelled_sql()} SELECT stay_id, max(charttime) AS charttime, arg_max(label, charttime) AS label FROM labelled GROUP BY 1")
def last_observation(t):
    return labels.last_label(labelled_grid(t), KEY, TS, "label")


@query(
    "step_index",
    f"WITH {grid_sql()} SELECT stay_id, charttime, (row_number() OVER (PARTITION BY stay_id ORDER BY charttime))::INTEGER AS step FROM grid",
)
def step_index(t):
    return grid.step_index(event_grid(t), KEY, TS).select(KEY, TS, "step")


@query(
    "history_features",
    f"""WITH {grid_sql()}
SELECT stay_id, charttime, round(lag(value_max, 1) OVER o, 6) AS value_max_lag1, round(lag(value_max, 4) OVER o, 6) AS value_max_lag4,
  round(avg(value_max) OVER (PARTITION BY stay_id ORDER BY charttime ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), 6) AS value_max_mean8
FROM grid WINDOW o AS (PARTITION BY stay_id ORDER BY charttime)""",
)
def history_features(t):
    made = grid.history_features(event_grid(t), KEY, TS, ["value_max"], [1, 4], [8])
    names = ["value_max_lag1", "value_max_lag4", "value_max_mean8"]
    return rounded(made.select(KEY, TS, *names), *names)


_PAIR = "pairs AS (SELECT user_id AS stay_id, event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS v_min, value * 2 AS v_max FROM events)"


@query("midpoint", f"WITH {_PAIR} SELECT stay_id, event_id, round((v_min + v_max) / 2, 6) AS v_avg FROM pairs")
def midpoint_pairs(t):
    low = F.when(F.pmod("event_id", F.lit(7)) != 0, F.col("value"))
    pairs = t.log.select(KEY, "event_id", low.alias("v_min"), (F.col("value") * 2).alias("v_max"))
    return rounded(pairs.select(KEY, "event_id", midpoint("v_min", "v_max").alias("v_avg")), "v_avg")


_GAPPY = """gappy AS (SELECT user_id AS stay_id, event_id, CASE WHEN event_id % 4 <> 0 THEN floor(value / 10) END AS a,
  CASE WHEN event_id % 9 <> 0 THEN floor(value / 30) END AS b FROM events)"""


def _gappy(t):
    level = lambda step, width: F.when(F.pmod("event_id", F.lit(step)) != 0, F.floor(F.col("value") / width).cast("double"))
    return t.log.select(KEY, "event_id", level(4, 10).alias("a"), level(9, 30).alias("b"))


def _mode_sql(column: str, by: str) -> str:
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""m_{column} AS (SELECT {group}{column} AS m FROM (SELECT {group}{column}, count(*) AS n FROM gappy WHERE {column} IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER ({part}ORDER BY n DESC, {column}) = 1)"""


@query(
    "entity_mode_impute",
    f"""WITH {_GAPPY}, {_mode_sql('a', 'stay_id')}, {_mode_sql('b', 'stay_id')}
SELECT g.stay_id, event_id, coalesce(a, m_a.m, 0) AS a, coalesce(b, m_b.m, 0) AS b
FROM gappy g LEFT JOIN m_a ON m_a.stay_id = g.stay_id LEFT JOIN m_b ON m_b.stay_id = g.stay_id""",
)
def entity_mode_impute(t):
    return features.fill_constant(features.impute_entity_mode(_gappy(t), KEY, ["a", "b"]), 0, ["a", "b"])


@query(
    "global_mode_impute",
    f"""WITH {_GAPPY}, {_mode_sql('a', '')}, {_mode_sql('b', '')}
SELECT stay_id, event_id, coalesce(a, (SELECT m FROM m_a)) AS a, coalesce(b, (SELECT m FROM m_b)) AS b FROM gappy""",
)
def global_mode_impute(t):
    return features.impute_column_mode(_gappy(t), ["a", "b"])


@query(
    "exact_quantiles",
    """SELECT 'l_extendedprice' AS column, quantile_cont(l_extendedprice, 0.01) AS q0, quantile_cont(l_extendedprice, 0.5) AS q1, quantile_cont(l_extendedprice, 0.99) AS q2 FROM lineitem
UNION ALL SELECT 'l_quantity', quantile_cont(l_quantity, 0.01), quantile_cont(l_quantity, 0.5), quantile_cont(l_quantity, 0.99) FROM lineitem
UNION ALL SELECT 'l_discount', quantile_cont(l_discount, 0.01), quantile_cont(l_discount, 0.5), quantile_cont(l_discount, 0.99) FROM lineitem""".replace(
        "quantile_cont(", "round(quantile_cont("
    ).replace(", 0.01)", ", 0.01), 6)").replace(", 0.5)", ", 0.5), 6)").replace(", 0.99)", ", 0.99), 6)"),
)
def exact_quantiles(t):
    found = features.exact_quantiles(t.read("lineitem"), ["l_extendedprice", "l_quantity", "l_discount"], [0.01, 0.5, 0.99])
    return rounded(found, "q0", "q1", "q2")


@query(
    "quantile_cap",
    """WITH q AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM events)
SELECT event_id, round(least(greatest(value, lo), hi), 6) AS value FROM events, q""",
)
def quantile_cap(t):
    rows = t.log.select("event_id", "value")
    return rounded(features.cap(rows, features.quantile_bounds(rows, ["value"], 0.01, 0.99), ["value"]), "value")


@query(
    "minmax_scale",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT event_id, round((value - lo) / (hi - lo), 6) AS value, CAST(0 AS DOUBLE) AS fixed FROM events, b""",
)
def minmax_scale(t):
    """A constant column scales to 0."""
    rows = t.log.select("event_id", "value", F.lit(5.0).alias("fixed"))
    return rounded(features.scale(rows, features.value_bounds(rows, ["value", "fixed"]), ["value", "fixed"]), "value")


@query(
    "fit_apply_scaler",
    """WITH ids AS (SELECT DISTINCT user_id FROM events),
ranked AS (SELECT user_id, row_number() OVER (ORDER BY md5(user_id || '|42'), user_id) AS position, count(*) OVER () AS total FROM ids),
train AS (SELECT e.* FROM events e JOIN ranked r ON r.user_id = e.user_id WHERE position <= total - ceil(0.2 * total)),
q AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM train),
b AS (SELECT min(least(greatest(value, lo), hi)) AS mn, max(least(greatest(value, lo), hi)) AS mx FROM train, q)
SELECT event_id, round((least(greatest(value, lo), hi) - mn) / (mx - mn), 6) AS value FROM events, q, b""",
)
def fit_apply_scaler(t):
    """Bounds from the training entities, applied to all rows."""
    rows = assign_split(t.log.select(KEY, "event_id", "value"), KEY)
    bounds = features.fit_scaler(rows.filter(F.col("split") == "train"), ["value"], ["value"])
    return rounded(features.apply_scaler(rows, bounds, ["value"], ["value"]).select("event_id", "value"), "value")


@query(
    "prepared_rows",
    f"""WITH {labelled_sql()}, {FIRST_ONSET}, {SQL['detail']},
ids AS (SELECT DISTINCT stay_id FROM truncated),
ranked AS (SELECT stay_id, row_number() OVER (ORDER BY md5(stay_id || '|42'), stay_id) AS position, count(*) OVER () AS total FROM ids),
rows AS (SELECT t.stay_id, t.charttime, t.label, coalesce(value_mean, 0) AS value_mean, age,
    CASE WHEN position <= total - ceil(0.2 * total) THEN 'train' WHEN position <= total - ceil(0.5 * ceil(0.2 * total)) THEN 'valid' ELSE 'test' END AS split
  FROM truncated t LEFT JOIN detail d ON d.stay_id = t.stay_id JOIN ranked r ON r.stay_id = t.stay_id),
q AS (SELECT quantile_cont(value_mean, 0.01) AS lo, quantile_cont(value_mean, 0.99) AS hi, min(age) AS a0, max(age) AS a1 FROM rows WHERE split = 'train'),
m AS (SELECT min(least(greatest(value_mean, lo), hi)) AS mn, max(least(greatest(value_mean, lo), hi)) AS mx FROM rows, q WHERE split = 'train')
SELECT stay_id, charttime, label, split, round((least(greatest(value_mean, lo), hi) - mn) / (mx - mn), 6) AS value_mean, round((age - a0) / (a1 - a0), 6) AS age
FROM rows, q, m""",
)
def prepared_rows(t):
    """Events to scaled, labelled and split rows: grid, fill, horizon, onset, static block, scaler."""
    rows = labels.first_onset(labelled_grid(t), KEY, TS, "label").fillna(0, subset=["value_mean"])
    rows = features.static_features(rows, t.detail, KEY, ["age"], {})
    rows = cut_lineage(assign_split(rows.select(KEY, TS, "label", "value_mean", "age"), KEY))
    bounds = cut_lineage(features.fit_scaler(rows.filter(F.col("split") == "train"), ["value_mean"], ["value_mean", "age"]))
    return rounded(features.apply_scaler(rows, bounds, ["value_mean"], ["value_mean", "age"]), "value_mean", "age")


_SEQ = f"""WITH {grid_sql()},
steps AS (SELECT stay_id, row_number() OVER (PARTITION BY stay_id ORDER BY charttime) - 1 AS step,
  coalesce(value_mean, 0) AS a, coalesce(value_max, 0) AS b FROM grid)"""


@query(
    "sequence_pad",
    f"""{_SEQ},
places AS (SELECT stay_id, step FROM (SELECT DISTINCT stay_id FROM steps) CROSS JOIN (SELECT unnest(range(max(step) + 1)) AS step FROM steps)),
cells AS (SELECT s.stay_id, s.step, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM places s LEFT JOIN steps x ON x.stay_id = s.stay_id AND x.step = s.step)
SELECT stay_id, (step * 2 + f)::INTEGER AS pos, round(CASE f WHEN 0 THEN a ELSE b END, 6) AS value
FROM cells CROSS JOIN (SELECT unnest([0, 1]) AS f)""",
)
def sequence_pad(t):
    """Sequences padded to the length of the study, flattened, one row per position."""
    sequence = cut_lineage(sequences.to_sequences(event_grid(t), KEY, TS, ["value_mean", "value_max"]))
    flat = sequences.flatten_padded(sequence, sequences.longest(sequence), 2)
    return rounded(flat.select(KEY, F.posexplode("flat").alias("pos", "value")), "value")


@query("sequence_shape", f"{_SEQ} SELECT count(DISTINCT stay_id) AS sequences, (max(step) + 1)::INTEGER AS steps, 2 AS features FROM steps")
def sequence_shape(t):
    return sequences.sequence_shape(sequences.to_sequences(event_grid(t), KEY, TS, ["value_mean", "value_max"]))


@query(
    "length_batches",
    f"""{_SEQ},
lengths AS (SELECT stay_id, count(*) AS length FROM steps GROUP BY 1),
placed AS (SELECT *, row_number() OVER (ORDER BY length DESC, stay_id) AS position FROM lengths),
batched AS (SELECT stay_id, length, position, (position - 1) // 5 AS batch FROM placed)
SELECT stay_id, length::INTEGER AS length, position::BIGINT AS position, batch::BIGINT AS batch,
  (max(length) OVER (PARTITION BY batch))::INTEGER AS batch_steps,
  (max(length) OVER (PARTITION BY batch))::INTEGER AS padded FROM batched""",
)
def length_batches(t):
    sequence = sequences.to_sequences(event_grid(t), KEY, TS, ["value_mean", "value_max"])
    batches = sequences.length_batches(sequence, KEY, 5, 2)
    return batches.select(KEY, "length", "position", "batch", "batch_steps", F.size("seq").alias("padded"))
