"""Matches of moments with intervals, slices of large groups, alignment with repeats, published versions, densities, decayed history."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import SQL, grid_sql, query, rounded
from catalog.timeline import KEY, TS, event_grid
from wardline.operators import align, evaluate, features, grid, intervals
from wardline.sources import tables as sources

_FEW_SHIPMENTS = SQL["shipments"].replace("o_custkey AS stay_id", "CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS stay_id")
_FEW_TIMES = SQL["times"].replace("o_custkey AS stay_id", "CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS stay_id").replace(
    "UNION SELECT o_custkey,", "UNION SELECT CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END,"
)
_MEETS = "i.stay_id = t.stay_id AND i.starttime <= t.charttime AND i.endtime >= t.charttime"


def _times(t):
    return t.order_times.unionByName(t.ship_times)


def _hot(df):
    """A third of the stays become one."""
    return df.withColumn("stay_id", F.when(F.col("stay_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("stay_id")))


@query(
    "interval_matches",
    f"""WITH {SQL['shipments']}, {SQL['times']}
SELECT t.stay_id, t.charttime, starttime, endtime, o_orderpriority FROM times t JOIN shipments i ON {_MEETS}""",
)
def interval_matches(t):
    """Every moment with every interval around it, and what the interval carries."""
    return intervals.intervals_at(_times(t), t.shipments, ["stay_id"])


@query(
    "interval_matches_hot",
    f"""WITH {_FEW_SHIPMENTS}, {_FEW_TIMES}
SELECT t.stay_id, t.charttime, count(*) AS n, min(starttime) AS first_start, max(endtime) AS last_end,
  count(DISTINCT o_orderpriority) AS priorities
FROM times t JOIN shipments i ON {_MEETS} GROUP BY 1, 2""",
)
def interval_matches_hot(t):
    """The same with a third of all rows at one stay, summed up per moment."""
    found = intervals.intervals_at(_hot(_times(t)), _hot(t.shipments), ["stay_id"])
    return found.groupBy("stay_id", "charttime").agg(
        F.count(F.lit(1)).alias("n"), F.min("starttime").alias("first_start"), F.max("endtime").alias("last_end"),
        F.count_distinct("o_orderpriority").alias("priorities"),
    )


@query(
    "first_interval",
    f"""WITH {SQL['shipments']}, {SQL['times']}
SELECT t.stay_id, t.charttime, count(i.stay_id) AS n_intervals, min(struct_pack(s := starttime, e := endtime, p := o_orderpriority)).s AS starttime,
  min(struct_pack(s := starttime, e := endtime, p := o_orderpriority)).e AS endtime,
  min(struct_pack(s := starttime, e := endtime, p := o_orderpriority)).p AS o_orderpriority
FROM times t LEFT JOIN shipments i ON {_MEETS} GROUP BY 1, 2""".replace("min(struct_pack(s := starttime, e := endtime, p := o_orderpriority))", "min(CASE WHEN i.stay_id IS NOT NULL THEN struct_pack(s := starttime, e := endtime, p := o_orderpriority) END)"),
)
def first_interval(t):
    """Per moment the number of intervals around it and the earliest one; moments outside all stay."""
    return intervals.first_interval_at(_times(t), t.shipments, ["stay_id"], columns=["o_orderpriority"])


_NULL_INFUSIONS = SQL["infusions"].replace("user_id AS stay_id", "CASE WHEN user_id % 3 <> 0 THEN user_id % 2 END AS stay_id")


@query(
    "carry_sliced",
    f"""WITH {_NULL_INFUSIONS},
rates AS (SELECT stay_id, itemid, starttime, max(rate) AS rate FROM infusions GROUP BY 1, 2, 3)
SELECT stay_id, itemid, starttime, rate,
  last_value(rate IGNORE NULLS) OVER (PARTITION BY stay_id, itemid ORDER BY starttime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried_rate,
  last_value(rate IGNORE NULLS) OVER (PARTITION BY stay_id, itemid ORDER BY starttime ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_rate
FROM rates""",
)
def carry_sliced(t):
    """Carried rates of large groups, one of them without a stay, cut into slices."""
    few = t.infusions.withColumn("stay_id", F.when(F.col("stay_id") % 3 != 0, F.col("stay_id") % 2))
    return intervals.carry_rate(few, ["stay_id", "itemid"], max_rows=100)


_REPEATS = """a AS (SELECT CASE WHEN event_id % 7 > 0 THEN user_id END AS stay_id, ts::DATE AS charttime, event_id AS a FROM events WHERE event_type = 'error'),
b AS (SELECT user_id AS stay_id, CASE WHEN event_id % 5 > 0 THEN ts::DATE END AS charttime, event_id AS b FROM events WHERE event_type = 'view' AND event_id % 3 = 0),
c AS (SELECT DISTINCT user_id AS stay_id, ts::DATE AS charttime FROM events WHERE event_type = 'click' AND event_id % 3 = 1),
d AS (SELECT user_id AS stay_id, ts::DATE AS charttime, event_id AS d, value FROM events WHERE event_id % 9 = 0)"""


@query(
    "align_stacked",
    f"""WITH {_REPEATS}
SELECT stay_id, charttime, a, b, d, value FROM a FULL JOIN b USING (stay_id, charttime) FULL JOIN c USING (stay_id, charttime)
FULL JOIN d USING (stay_id, charttime)""",
)
def align_stacked(t):
    """Full join of four sources by one shuffle: days with repeats, days without a date or stay, a source without values."""
    log = t.log.withColumn("charttime", F.to_date("charttime"))
    kind = lambda k: F.col("event_type") == k
    stay = F.when(F.col("event_id") % 7 > 0, F.col("stay_id"))
    day = F.when(F.col("event_id") % 5 > 0, F.col("charttime"))
    a = log.filter(kind("error")).select(stay.alias("stay_id"), "charttime", F.col("event_id").alias("a"))
    b = log.filter(kind("view") & (F.col("event_id") % 3 == 0)).select("stay_id", day.alias("charttime"), F.col("event_id").alias("b"))
    c = log.filter(kind("click") & (F.col("event_id") % 3 == 1)).select("stay_id", "charttime").distinct()
    d = log.filter(F.col("event_id") % 9 == 0).select("stay_id", "charttime", F.col("event_id").alias("d"), "value")
    return align.align([a, b, c, d], ["stay_id", "charttime"], mode="stacked")


@query(
    "publish_versions",
    """SELECT 1 AS version, c_custkey, c_acctbal FROM customer
UNION ALL SELECT 2, c_custkey, c_acctbal * 2 FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 3, c_custkey, c_acctbal * 2 FROM customer WHERE c_custkey % 4 = 0""",
)
def publish_versions(t):
    """A derived table replaced twice by what is read from it; the old versions stay readable."""
    path = sources.shared_folder(t.spark)
    named = [sources.publish(t.read("customer").select("c_custkey", "c_acctbal"), path)]
    now = sources.read_published(t.spark, path)
    named.append(sources.publish(now.filter("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") * 2), path))
    named.append(sources.publish(sources.read_published(t.spark, path).filter("c_custkey % 4 = 0"), path))
    read = [sources.read_published(t.spark, path, v).withColumn("version", F.lit(i + 1)) for i, v in enumerate(named)]
    return read[0].unionByName(read[1]).unionByName(read[2])


_PLACES = evaluate.DENSITY_POINTS


@query(
    "density_by_class",
    f"""WITH {SQL['pred']},
x AS (SELECT model, label, prob * {_PLACES - 1} AS x, least(floor(prob * {_PLACES - 1}), {_PLACES - 2})::INTEGER AS low FROM pred),
w AS (
  SELECT model, label, place, sum(weight) AS weight FROM (
    SELECT model, label, low AS place, 1 - (x - low) AS weight FROM x UNION ALL SELECT model, label, low + 1, x - low FROM x) GROUP BY 1, 2, 3),
s AS (SELECT model, label, count(*) AS n, stddev_samp(prob) * pow(count(*), -0.2) AS h FROM pred GROUP BY 1, 2)
SELECT w.model, w.label, r.place::INTEGER AS point, round(r.place / {_PLACES - 1}, 6) AS x,
  round(sum(weight * exp(-0.5 * pow((w.place - r.place) / {_PLACES - 1} / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM w JOIN s ON s.model = w.model AND s.label = w.label CROSS JOIN range({_PLACES}) r(place) GROUP BY w.model, w.label, r.place""",
)
def density_by_class(t):
    """Smooth distribution of the probabilities of each model and true class."""
    return rounded(evaluate.class_density(t.predictions), "x", "density")


def _decay_sql(source: str) -> str:
    """Sums that halve in so many hours, row by row: the first row starts them, each later one adds to what is left."""
    left = lambda half: f"pow(0.5, hours / {half}.0)"
    return f"""r AS (
  SELECT stay_id, charttime, value_mean AS v, row_number() OVER w AS i,
    (epoch_us(charttime) - epoch_us(lag(charttime) OVER w)) / 3.6e9 AS hours
  FROM {source} WINDOW w AS (PARTITION BY stay_id ORDER BY charttime)),
s AS (
  SELECT stay_id, charttime, i, coalesce(v, 0.0) AS f, (v IS NOT NULL)::DOUBLE AS fn, coalesce(v, 0.0) AS l, (v IS NOT NULL)::DOUBLE AS ln,
    CASE WHEN v IS NOT NULL THEN charttime END AS seen FROM r WHERE i = 1
  UNION ALL
  SELECT r.stay_id, r.charttime, r.i, f * {left(12)} + coalesce(v, 0.0), fn * {left(12)} + (v IS NOT NULL)::DOUBLE,
    l * {left(72)} + coalesce(v, 0.0), ln * {left(72)} + (v IS NOT NULL)::DOUBLE, CASE WHEN v IS NOT NULL THEN r.charttime ELSE seen END
  FROM s JOIN r ON r.stay_id = s.stay_id AND r.i = s.i + 1)
SELECT stay_id, charttime, round(f / nullif(fn, 0), 6) AS value_mean_fast, round(l / nullif(ln, 0), 6) AS value_mean_slow, round(f / nullif(fn, 0) - l / nullif(ln, 0), 6) AS value_mean_trend,
  round((epoch_us(charttime) - epoch_us(seen)) / 3.6e9, 6) AS value_mean_since FROM s"""


_DECAYED = ["value_mean_fast", "value_mean_slow", "value_mean_trend", "value_mean_since"]


@query("decayed_history", f"WITH RECURSIVE {grid_sql()}, {_decay_sql('grid')}")
def decayed_history(t):
    """Means of a stay's whole history that halve in 12 and 72 hours, their difference, and the time since the last value."""
    made = grid.decayed_history(event_grid(t).select(KEY, TS, "value_mean"), KEY, TS, ["value_mean"], 12, 72)
    return rounded(made.select(KEY, TS, *_DECAYED), *_DECAYED)


_RAW = "raw AS (SELECT user_id % 3 AS stay_id, ts AS charttime, max(CASE WHEN event_id % 4 > 0 THEN value END) AS value_mean FROM events GROUP BY 1, 2)"


@query("decayed_history_sliced", f"WITH RECURSIVE {_RAW}, {_decay_sql('raw')}")
def decayed_history_sliced(t):
    """The same over raw rows of three large groups, cut into slices."""
    value = F.when(F.col("event_id") % 4 > 0, F.col("value"))
    raw = t.log.groupBy((F.col("stay_id") % 3).alias(KEY), TS).agg(F.max(value).alias("value_mean"))
    made = grid.decayed_history(raw, KEY, TS, ["value_mean"], 12, 72, max_rows=500)
    return rounded(made.select(KEY, TS, *_DECAYED), *_DECAYED)


@query(
    "quantiles_sliced",
    """SELECT 'value' AS "column", round(min(x), 9) AS q0, round(quantile_cont(x, 0.3), 9) AS q1, round(quantile_cont(x, 0.999), 9) AS q2, round(max(x), 9) AS q3
FROM (SELECT 1 + value / 1e9 AS x FROM events UNION ALL SELECT 1.0001)""",
)
def quantiles_sliced(t):
    """Exact quantiles of values that nearly all lie in one cell, which is cut by counts."""
    dense = t.read("events").select((1 + F.col("value") / 1e9).alias("value")).union(t.spark.range(1).select(F.lit(1.0001).alias("value")))
    found = features.exact_quantiles(dense, ["value"], [0.0, 0.3, 0.999, 1.0], max_values=200)
    return rounded(found, "q0", "q1", "q2", "q3", digits=9)
