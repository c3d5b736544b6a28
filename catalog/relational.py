"""Scans, predicates, joins, pivots, intervals and cohorts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.registry import SQL, coded_sql, query, rounded
from wardline.functions.codes import LAB_RULES, SEDATIVE_ORDER_CODES, SEDATIVE_RATE_CODES, VITAL_RULES, labels_of
from wardline.functions.columns import hours_between, is_distinct_from, one_hot, stage_label, swap_if
from wardline.operators import align, cohort, features, intervals, pivot
from wardline.operators.scans import number_rows
from wardline.plans import extract, preparation
from wardline.sources import tables as sources
from wardline.sources.schemas import METRICS

LAB_CODES = [r.code for r in LAB_RULES]
VITAL_CODES = [r.code for r in VITAL_RULES]


@query(
    "scan_csv_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer",
)
def scan_csv_roundtrip(t):
    path = sources.shared_folder(t.spark)
    customers = t.read("customer")
    sources.write_delimited(customers, path)
    return rounded(sources.read_delimited(t.spark, path, customers.schema), "c_acctbal")


@query("scan_csv_times", "SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders")
def scan_csv_times(t):
    """Timestamps through a delimited file, parsed by the schema."""
    path = sources.shared_folder(t.spark)
    orders = t.read("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    sources.write_delimited(orders, path, sort=["o_custkey", "o_orderdate"])
    return sources.read_delimited(t.spark, path, orders.schema)


@query(
    "sorted_sink",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS place FROM orders""",
)
def sorted_sink(t):
    """The order of rows over the files of a sorted delimited table: file by file, line by line."""
    path = sources.shared_folder(t.spark)
    orders = t.read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sources.write_delimited(orders, path, sort=["o_custkey", "o_orderdate", "o_orderkey"])
    lines = sources.read_delimited(t.spark, path, orders.schema).select(
        "o_orderkey", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line")
    )
    return number_rows(lines, [F.col("file").asc(), F.col("line").asc()], "place").select("o_orderkey", "place")


@query("named_tables", "SELECT c_custkey, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def named_tables(t):
    """Tables resolved by name, one of them bucketed in the catalog and qualified by its database."""
    t.read("customer").createOrReplaceTempView("wardline_customer")
    name = f"wardline_nation_{uuid.uuid4().hex}"
    sources.materialise_table(t.read("nation"), name, bucket_by="n_nationkey", buckets=4)
    customer, nation = sources.read_named(t.spark, "wardline_customer"), sources.read_named(t.spark, name, "default")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select("c_custkey", "c_mktsegment", "n_name")


@query(
    "feature_fallback",
    f"""WITH {SQL['log']}
SELECT 'wide' AS source, event_id, round(value, 6) AS value, event_type FROM log
UNION ALL SELECT 'narrow', event_id, round(value, 6), NULL FROM log""",
)
def feature_fallback(t):
    """The full feature list where the table has it, otherwise the minimal one."""
    parts = {}
    for source, df in (("wide", t.log), ("narrow", t.log.drop("event_type"))):
        chosen = preparation.select_features(df, ["event_id", "value", "event_type"], ["event_id", "value"])
        parts[source] = df.select(F.lit(source).alias("source"), *chosen)
    return rounded(parts["wide"].unionByName(parts["narrow"], allowMissingColumns=True), "value")


@query(
    "align_mixed_keys",
    f"""WITH {SQL['log']}, {SQL['stays']},
a AS (SELECT l.stay_id, charttime, subject_id, max(value) AS a FROM log l JOIN stays s ON s.stay_id = l.stay_id WHERE event_type = 'click' GROUP BY 1, 2, 3),
b AS (SELECT l.stay_id, time_bucket(INTERVAL '1 day', charttime) AS charttime, max(value) AS b FROM log l WHERE event_type = 'view' GROUP BY 1, 2),
c AS (SELECT l.stay_id, charttime, subject_id, hadm_id, max(value) AS c FROM log l JOIN stays s ON s.stay_id = l.stay_id WHERE event_type = 'click' OR value > 50 GROUP BY 1, 2, 3, 4)
SELECT coalesce(ab.stay_id, c.stay_id) AS stay_id, coalesce(ab.charttime, c.charttime) AS charttime,
  coalesce(ab.subject_id, c.subject_id) AS subject_id, c.hadm_id, a, b, c
FROM (SELECT coalesce(a.stay_id, b.stay_id) AS stay_id, coalesce(a.charttime, b.charttime) AS charttime, subject_id, a, b
      FROM a FULL JOIN b ON b.stay_id = a.stay_id AND b.charttime = a.charttime) ab
FULL JOIN c ON c.stay_id = ab.stay_id AND c.charttime = ab.charttime AND c.subject_id = ab.subject_id""",
)
def align_mixed_keys(t):
    """Two full joins, the second on one key more."""
    log = t.log.join(t.stays, "stay_id")
    top = F.max("value")
    a = log.filter(F.col("event_type") == "click").groupBy("stay_id", "charttime", "subject_id").agg(top.alias("a"))
    daily = F.date_trunc("day", "charttime").cast("timestamp_ntz").alias("charttime")
    b = t.log.filter(F.col("event_type") == "view").groupBy("stay_id", daily).agg(top.alias("b"))
    c = log.filter((F.col("event_type") == "click") | (F.col("value") > 50))
    c = c.groupBy("stay_id", "charttime", "subject_id", "hadm_id").agg(top.alias("c"))
    return align.align([a, b, c], [["stay_id", "charttime"], ["stay_id", "charttime", "subject_id"]])


@query(
    "null_safe_filter",
    f"""WITH {coded_sql('charted', VITAL_CODES)}, {SQL['infusions']}
SELECT 'not_an_error' AS kept, count(*) AS n FROM charted WHERE warning IS DISTINCT FROM 1
UNION ALL SELECT 'not_rewritten', count(*) FROM infusions WHERE statusdescription <> 'Rewritten'""",
)
def null_safe_filter(t):
    """Null passes the distinct-from test and fails the plain inequality."""
    charted = t.coded(VITAL_CODES, stay=True).filter(is_distinct_from("warning", 1))
    valid = t.infusions.filter(F.col("statusdescription") != "Rewritten")
    count = F.count(F.lit(1)).alias("n")
    return (
        charted.agg(count).select(F.lit("not_an_error").alias("kept"), "n")
        .unionByName(valid.agg(count).select(F.lit("not_rewritten").alias("kept"), "n"))
    )


@query(
    "drop_any_all_null",
    f"""WITH {SQL['infusions']}, x AS (SELECT stay_id, starttime, rate, statusdescription FROM infusions)
SELECT 'any' AS mode, stay_id, count(*) AS n FROM x WHERE rate IS NOT NULL AND statusdescription IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'all', stay_id, count(*) FROM x WHERE rate IS NOT NULL OR statusdescription IS NOT NULL GROUP BY 2""",
)
def drop_any_all_null(t):
    columns = ["rate", "statusdescription"]
    both = {"any": cohort.drop_any_null(t.infusions, columns), "all": cohort.drop_all_null(t.infusions, columns)}
    return cohort.union_all(
        [df.groupBy("stay_id").agg(F.count(F.lit(1)).alias("n")).withColumn("mode", F.lit(m)) for m, df in both.items()]
    )


# The rules once more, for the oracle: code, label, limits, whether they belong to the range, Fahrenheit.
_LAB_RULES_SQL = """rules AS (
  SELECT unnest(codes) AS code, label, low::DOUBLE AS low, high::DOUBLE AS high, low IS NOT NULL AS low_in, true AS high_in, false AS fahrenheit
  FROM (VALUES
    ([50868], 'aniongap', NULL, 10000), ([50862], 'albumin', NULL, 10), ([51144], 'bands', 0, 100), ([50882], 'bicarbonate', NULL, 10000),
    ([50885], 'bilirubin', NULL, 150), ([50912], 'creatinine', NULL, 150), ([50806, 50902], 'chloride', NULL, 10000),
    ([50809, 50931], 'glucose', NULL, 10000), ([50810, 51221], 'hematocrit', NULL, 100), ([50811, 51222], 'hemoglobin', NULL, 50),
    ([50813], 'lactate', NULL, 50), ([51265], 'platelet', NULL, 10000), ([50822, 50971], 'potassium', NULL, 30), ([51275], 'ptt', NULL, 150),
    ([51237], 'inr', NULL, 50), ([51274], 'pt', NULL, 150), ([50824, 50983], 'sodium', NULL, 200), ([51006], 'bun', NULL, 300),
    ([51300, 51301], 'wbc', NULL, 1000)) x(codes, label, low, high))"""
_VITAL_RULES_SQL = """rules AS (
  SELECT unnest(codes) AS code, label, low::DOUBLE AS low, high::DOUBLE AS high, false AS low_in, label = 'spo2' AS high_in, fahrenheit
  FROM (VALUES
    ([211, 220045], 'heartrate', 0, 300, false), ([51, 442, 455, 6701, 220179, 220050], 'sysbp', 0, 400, false),
    ([8368, 8440, 8441, 8555, 220180, 220051], 'diasbp', 0, 300, false),
    ([456, 52, 6702, 443, 220052, 220181, 225312], 'meanbp', 0, 300, false), ([615, 618, 220210, 224690], 'resprate', 0, 70, false),
    ([223761, 678], 'tempc', 70, 120, true), ([223762, 676], 'tempc', 10, 50, false), ([646, 220277], 'spo2', 0, 100, false),
    ([807, 811, 1529, 3745, 3744, 225664, 220621, 226537], 'glucose', 0, NULL, false)) x(codes, label, low, high, fahrenheit))"""


_JUDGED = """judged AS (
  SELECT e.*, r.label AS label,
    CASE WHEN (low IS NULL OR valuenum > low OR (low_in AND valuenum >= low))
          AND (high IS NULL OR valuenum < high OR (high_in AND valuenum <= high))
         THEN CASE WHEN fahrenheit THEN (valuenum - 32) / 1.8 ELSE valuenum END END AS v
  FROM coded e JOIN rules r ON e.itemid = r.code)"""


@query(
    "harmonise_codes",
    f"""WITH {coded_sql('coded', LAB_CODES)}, {_LAB_RULES_SQL}
SELECT label, count(*) AS n, count(DISTINCT itemid) AS codes FROM coded JOIN rules ON itemid = code GROUP BY 1""",
)
def harmonise_codes(t):
    known = pivot.harmonise(t.coded(LAB_CODES, stay=True), LAB_RULES)
    return known.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("itemid").alias("codes"))


@query(
    "plausibility_null",
    f"""WITH {coded_sql('coded', VITAL_CODES)}, {_VITAL_RULES_SQL}, {_JUDGED}
SELECT stay_id, charttime, itemid, label, round(v, 6) AS valuenum FROM judged""",
)
def plausibility_null(t):
    judged = pivot.harmonise(t.coded(VITAL_CODES, stay=True), VITAL_RULES)
    return rounded(judged.select("stay_id", "charttime", "itemid", "label", "valuenum"), "valuenum")


@query(
    "unit_convert",
    f"""WITH {coded_sql('coded', VITAL_CODES)}, {SQL['infusions']}
SELECT 'temperature' AS what, stay_id, charttime AS at,
  round(CASE WHEN valuenum > 70 AND valuenum < 120 THEN (valuenum - 32) / 1.8 END, 6) AS a, CAST(NULL AS DOUBLE) AS b
FROM coded WHERE itemid IN (223761, 678)
UNION ALL
SELECT 'swap', stay_id, starttime, round(CASE WHEN itemid = 42273 THEN amount ELSE rate END, 6),
  round(CASE WHEN itemid = 42273 THEN rate ELSE amount END, 6) FROM infusions""",
)
def unit_convert(t):
    """Fahrenheit to Celsius, and the exchange of rate and amount for some codes."""
    fahrenheit = [r for r in VITAL_RULES if r.fahrenheit]
    converted = pivot.harmonise(t.coded(VITAL_CODES, stay=True), fahrenheit)
    rate, amount = swap_if(F.col("itemid").isin(extract.SWAPPED_RATE_CODES), "rate", "amount")
    temperature = converted.select(
        F.lit("temperature").alias("what"), "stay_id", F.col("charttime").alias("at"),
        F.col("valuenum").alias("a"), F.lit(None).cast("double").alias("b"),
    )
    swapped = t.infusions.select(F.lit("swap").alias("what"), "stay_id", F.col("starttime").alias("at"), rate.alias("a"), amount.alias("b"))
    return rounded(temperature.unionByName(swapped), "a", "b")


@query(
    "binarise_stage",
    f"""WITH {SQL['log']}
SELECT event_id, stage, (stage >= 1)::INTEGER AS any_stage, (stage >= 2)::INTEGER AS moderate,
  (stage >= 3)::INTEGER AS severe FROM log WHERE stage IS NOT NULL""",
)
def binarise_stage(t):
    staged = t.log.filter(F.col("stage").isNotNull())
    kinds = {"any_stage": 1, "moderate": 2, "severe": 3}
    return staged.select(
        "event_id", stage_label("stage", None).alias("stage"), *[stage_label("stage", k).alias(n) for n, k in kinds.items()]
    )


def _pivot_sql(labels: list[str], aggregates: dict[str, str]) -> str:
    return ",\n  ".join(
        f"round({f}(v) FILTER (label = '{n}'), 6) AS {n}_{a}" for n in labels for a, f in aggregates.items()
    )


@query(
    "left_join_on_filter",
    f"""WITH {SQL['stays']}, {coded_sql('coded', LAB_CODES)}
SELECT s.stay_id, e.charttime, count(e.itemid) AS n, max(e.valuenum) AS top
FROM stays s LEFT JOIN (SELECT * FROM coded WHERE valuenum > 0) e
  ON e.subject_id = s.subject_id AND e.hadm_id = s.hadm_id
GROUP BY 1, 2""",
)
def left_join_on_filter(t):
    """Every stay survives; events of the admission repeat for each of its stays."""
    groups = (
        t.coded(LAB_CODES, stay=False).filter(F.col("valuenum") > 0)
        .groupBy("subject_id", "hadm_id", "charttime")
        .agg(F.count("itemid").alias("n"), F.max("valuenum").alias("top"))
    )
    joined = pivot.left_join_groups(t.stays, groups, ["subject_id", "hadm_id"])
    return joined.select("stay_id", "charttime", F.coalesce("n", F.lit(0)).alias("n"), "top")


@query(
    "lab_table",
    f"""WITH {SQL['stays']}, {coded_sql('raw', LAB_CODES)}, {_LAB_RULES_SQL},
coded AS (SELECT subject_id, hadm_id, itemid, charttime, valuenum FROM raw WHERE valuenum > 0), {_JUDGED}
SELECT s.subject_id, s.hadm_id, s.stay_id, e.charttime,
  {_pivot_sql(labels_of(LAB_RULES), {'min': 'min', 'max': 'max'})}
FROM stays s LEFT JOIN judged e ON e.subject_id = s.subject_id AND e.hadm_id = s.hadm_id
GROUP BY 1, 2, 3, 4""",
)
def lab_table(t):
    table = extract.lab_table(t.stays, t.coded(LAB_CODES, stay=False))
    return rounded(table, *[c for c in table.columns if c.endswith(("_min", "_max"))])


@query(
    "vital_table",
    f"""WITH {SQL['stays']}, {coded_sql('raw', VITAL_CODES)}, {_VITAL_RULES_SQL},
coded AS (SELECT * FROM raw WHERE warning IS DISTINCT FROM 1), {_JUDGED}
SELECT s.subject_id, s.hadm_id, s.stay_id, e.charttime,
  {_pivot_sql(labels_of(VITAL_RULES), {'min': 'min', 'max': 'max', 'mean': 'avg'})}
FROM stays s JOIN judged e ON e.subject_id = s.subject_id AND e.hadm_id = s.hadm_id AND e.stay_id = s.stay_id
GROUP BY 1, 2, 3, 4""",
)
def vital_table(t):
    table = extract.vital_table(t.stays, t.coded(VITAL_CODES, stay=True))
    return rounded(table, *[c for c in table.columns if c.endswith(("_min", "_max", "_mean"))])


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "pivot_min_max",
    "SELECT user_id AS stay_id, date_trunc('day', ts) AS charttime,\n  "
    + ",\n  ".join(f"round({f}(value) FILTER (event_type = '{n}'), 6) AS {n}_{f}" for n in _TYPES for f in ("min", "max"))
    + "\nFROM events GROUP BY 1, 2",
)
def pivot_min_max(t):
    daily = t.log.withColumn("charttime", F.date_trunc("day", "charttime").cast("timestamp_ntz"))
    return rounded(
        pivot.pivot_labels(daily, ["stay_id", "charttime"], dict(zip(_TYPES, _TYPES)), ["min", "max"], "event_type", "value"),
        *[f"{n}_{a}" for n in _TYPES for a in ("min", "max")],
    )


@query(
    "pivot_min_max_avg",
    "WITH x AS (SELECT user_id AS stay_id, time_bucket(INTERVAL '6 hours', ts) AS charttime, event_type,\n"
    "  CASE WHEN value <= 200 THEN value END AS v FROM events)\nSELECT stay_id, charttime,\n  "
    + ",\n  ".join(
        f"round({f}(v) FILTER (event_type = '{n}'), 6) AS {n}_{a}" for n in _TYPES for a, f in (("min", "min"), ("max", "max"), ("mean", "avg"))
    )
    + "\nFROM x GROUP BY 1, 2",
)
def pivot_min_max_avg(t):
    """Values above 200 are implausible; groups of only such values stay as rows of nulls."""
    events = t.log.select(
        "stay_id", F.window("charttime", "6 hours").start.alias("charttime"), "event_type",
        F.when(F.col("value") <= 200, F.col("value")).alias("value"),
    )
    wide = pivot.pivot_labels(events, ["stay_id", "charttime"], dict(zip(_TYPES, _TYPES)), ["min", "max", "mean"], "event_type", "value")
    return rounded(wide, *[f"{n}_{a}" for n in _TYPES for a in ("min", "max", "mean")])


@query(
    "cohort_semi",
    f"""WITH {SQL['log']}, able AS (SELECT DISTINCT stay_id FROM log WHERE stage IS NOT NULL AND value > 100)
SELECT c_custkey AS stay_id, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey IN (SELECT stay_id FROM able)""",
)
def cohort_semi(t):
    """Static rows of the entities with a labelled measurement."""
    stages = t.log.withColumn("measured", F.when(F.col("value") > 100, F.col("value")))
    named = t.read("customer").join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = named.select(F.col("c_custkey").alias("stay_id"), "c_name", "n_name")
    return cohort.extract_cohort({"detail": rows}, stages, ["measured"], "stage", "stay_id")["detail"]


@query(
    "cohort_anti",
    f"""WITH {SQL['log']}
SELECT c_custkey AS stay_id, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT stay_id FROM log WHERE stage = 3)""",
)
def cohort_anti(t):
    severe = t.log.filter(F.col("stage") == 3)
    return cohort.drop_entities(t.read("customer").select(F.col("c_custkey").alias("stay_id"), "c_mktsegment"), severe, "stay_id")


@query(
    "adults_only",
    f"WITH {SQL['detail']} SELECT stay_id, round(age, 6) AS age, segment FROM detail WHERE age >= 18",
)
def adults_only(t):
    return rounded(cohort.adults(t.detail, 18), "age")


@query(
    "point_in_interval",
    f"""WITH {SQL['shipments']}, {SQL['times']}
SELECT t.stay_id, t.charttime, max(CASE WHEN i.stay_id IS NOT NULL THEN 1 ELSE 0 END)::INTEGER AS inside
FROM times t LEFT JOIN shipments i ON i.stay_id = t.stay_id AND i.starttime <= t.charttime AND i.endtime >= t.charttime
GROUP BY 1, 2""",
)
def point_in_interval(t):
    return intervals.flag_at([t.order_times, t.ship_times], t.shipments, "inside", tasks=t.item_tasks)


_KINDS = {"vent": ("1-URGENT", "2-HIGH"), "vasopressor": ("3-MEDIUM",), "sedative": ("4-NOT SPECIFIED", "5-LOW")}


def _kind_sql(priorities) -> str:
    return "i.o_orderpriority IN (" + ", ".join(f"'{p}'" for p in priorities) + ")"


def _three_flags_sql() -> str:
    cases = ",\n  ".join(
        f"max(CASE WHEN {_kind_sql(p)} THEN 1 ELSE 0 END)::INTEGER AS {n}" for n, p in _KINDS.items()
    )
    return f"""WITH {SQL['shipments']}, {SQL['times']}
SELECT t.stay_id, t.charttime,
  {cases}
FROM times t LEFT JOIN shipments i ON i.stay_id = t.stay_id AND i.starttime <= t.charttime AND i.endtime >= t.charttime
GROUP BY 1, 2"""


@query("flag_at_time", _three_flags_sql())
def flag_at_time(t):
    """Three kinds of intervals against the union of two time sources, in one pass."""
    shipments = sources.cut_lineage(t.shipments)
    kinds = {n: shipments.filter(F.col("o_orderpriority").isin(*p)) for n, p in _KINDS.items()}
    return intervals.flags_at([t.order_times, t.ship_times], kinds, tasks=t.item_tasks)


@query("flags_three_way", _three_flags_sql())
def flags_three_way(t):
    """The same from three separate flag tables, joined on (stay, time)."""
    times, shipments = [t.order_times, t.ship_times], sources.cut_lineage(t.shipments)
    parts = [
        intervals.flag_at(times, shipments.filter(F.col("o_orderpriority").isin(*p)), n) for n, p in _KINDS.items()
    ]
    return intervals.join_flags(parts, ["stay_id", "charttime"])


# Union of closed intervals by sweeping over their bounds: starts count before ends.
_SWEEP = """bounds AS (
  SELECT stay_id, starttime AS moment, 1 AS change FROM {source}
  UNION ALL SELECT stay_id, endtime, -1 FROM {source}),
depth AS (
  SELECT stay_id, moment, change, sum(change) OVER w AS n_open, sum(change) OVER w - change AS n_before
  FROM bounds WINDOW w AS (PARTITION BY stay_id ORDER BY moment, change DESC ROWS UNBOUNDED PRECEDING)),
edges AS (
  SELECT stay_id, moment, change, row_number() OVER (PARTITION BY stay_id, change ORDER BY moment) AS n
  FROM depth WHERE (change = 1 AND n_before = 0) OR (change = -1 AND n_open = 0)),
merged AS (
  SELECT s.stay_id, s.n, s.moment AS starttime, e.moment AS endtime
  FROM edges s JOIN edges e ON e.stay_id = s.stay_id AND e.n = s.n AND s.change = 1 AND e.change = -1)"""


@query(
    "merge_intervals",
    f"WITH {SQL['shipments']}, {_SWEEP.format(source='shipments')}\nSELECT stay_id, starttime, endtime FROM merged",
)
def merge_intervals(t):
    return intervals.merge_intervals(t.shipments.select("stay_id", "starttime", "endtime"), ["stay_id"])


@query(
    "durations",
    f"""WITH {SQL['shipments']}, {_SWEEP.format(source='shipments')}
SELECT stay_id, n::BIGINT AS number, starttime, endtime,
  round((epoch_us(endtime) - epoch_us(starttime)) / 3.6e9, 6) AS duration_hours FROM merged""",
)
def durations(t):
    return rounded(intervals.durations([t.shipments.select("stay_id", "starttime", "endtime")], "stay_id"), "duration_hours")


_CARRIED = """rates AS (
  SELECT stay_id, itemid, starttime, max(rate) AS rate FROM infusions GROUP BY 1, 2, 3),
carried AS (
  SELECT *, last_value(rate IGNORE NULLS) OVER (PARTITION BY stay_id, itemid ORDER BY starttime
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried_rate,
    last_value(rate IGNORE NULLS) OVER (PARTITION BY stay_id, itemid ORDER BY starttime
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_rate
  FROM rates)"""


@query(
    "carry_rate",
    f"""WITH {SQL['infusions']}, {_CARRIED}
SELECT stay_id, itemid, starttime, rate, carried_rate, previous_rate FROM carried""",
)
def carry_rate(t):
    return intervals.carry_rate(t.infusions, ["stay_id", "itemid"])


# Delivery from each start until the first zero rate or, without one, the last record.
_EPISODES = """starts AS (
  SELECT stay_id, itemid, starttime,
    lead(starttime) OVER (PARTITION BY stay_id, itemid ORDER BY starttime) AS next_start
  FROM carried WHERE (previous_rate IS NULL AND rate > 0) OR (previous_rate = 0 AND rate <> 0)),
ended AS (
  SELECT s.stay_id, s.itemid, s.starttime,
    coalesce(min(r.starttime) FILTER (r.rate = 0), max(r.starttime)) AS endtime, max(r.rate) AS peak
  FROM starts s JOIN rates r ON r.stay_id = s.stay_id AND r.itemid = s.itemid AND r.starttime >= s.starttime
    AND (s.next_start IS NULL OR r.starttime < s.next_start)
  GROUP BY 1, 2, 3),
episodes AS (SELECT stay_id, itemid, starttime, endtime FROM ended WHERE endtime <> starttime AND peak > 0)"""


@query(
    "episodes",
    f"WITH {SQL['infusions']}, {_CARRIED}, {_EPISODES}\nSELECT stay_id, itemid, starttime, endtime FROM episodes",
)
def episodes(t):
    return intervals.episodes(t.infusions, ["stay_id", "itemid"])


@query(
    "episodes_sliced",
    f"""WITH {SQL['infusions'].replace('user_id AS stay_id', 'user_id % 3 AS stay_id')}, {_CARRIED}, {_EPISODES}
SELECT stay_id, itemid, starttime, endtime FROM episodes""",
)
def episodes_sliced(t):
    """Episodes of large groups, cut into slices."""
    few = t.infusions.withColumn("stay_id", F.pmod("stay_id", F.lit(3)))
    return intervals.episodes(few, ["stay_id", "itemid"], max_rows=300)


@query(
    "merge_sliced",
    f"""WITH {SQL['shipments'].replace('o_custkey AS stay_id', 'o_custkey % 5 AS stay_id')}, {_SWEEP.format(source='shipments')}
SELECT stay_id, starttime, endtime FROM merged""",
)
def merge_sliced(t):
    """The union of intervals of large groups, cut into slices."""
    few = t.shipments.withColumn("stay_id", F.pmod("stay_id", F.lit(5)))
    return intervals.merge_intervals(few, ["stay_id"], max_rows=400)


def _numbered(prefix: str, source: str) -> str:
    sweep = _SWEEP.format(source=source)
    for name in ("bounds", "depth", "edges", "merged"):
        sweep = sweep.replace(f"{name} AS (", f"{prefix}_{name} AS (").replace(f"FROM {name}", f"FROM {prefix}_{name}").replace(f"JOIN {name}", f"JOIN {prefix}_{name}")
    return sweep


@query(
    "sedative_durations",
    f"""WITH {SQL['infusions'].replace('infusions AS', 'all_infusions AS')},
infusions AS (SELECT * FROM all_infusions WHERE itemid IN ({', '.join(map(str, SEDATIVE_RATE_CODES))})), {_CARRIED}, {_EPISODES},
ordered AS (
  SELECT stay_id, linkorderid, min(starttime) AS starttime, max(endtime) AS endtime FROM all_infusions
  WHERE itemid IN ({', '.join(map(str, SEDATIVE_ORDER_CODES))}) AND statusdescription <> 'Rewritten' GROUP BY 1, 2),
{_numbered('r', 'episodes')},
{_numbered('o', 'ordered')}
SELECT stay_id, n::BIGINT AS sedativenum, starttime, endtime, round((epoch_us(endtime) - epoch_us(starttime)) / 3.6e9, 6) AS duration_hours
FROM (SELECT * FROM r_merged UNION SELECT * FROM o_merged)""",
)
def sedative_durations(t):
    return rounded(extract.sedative_durations(t.infusions), "duration_hours")


@query(
    "elapsed",
    f"""WITH {SQL['infusions']}
SELECT stay_id, itemid, starttime, round((epoch_us(endtime) - epoch_us(starttime)) / 3.6e9, 6) AS hours FROM infusions""",
)
def elapsed(t):
    return rounded(t.infusions.select("stay_id", "itemid", "starttime", hours_between("starttime", "endtime").alias("hours")), "hours")


_SOURCES = """a AS (SELECT stay_id, charttime, value AS creat FROM log WHERE event_type IN ('click', 'error')),
b AS (SELECT stay_id, charttime, value AS creatinine FROM log WHERE event_type IN ('error', 'view')),
c AS (SELECT stay_id, charttime, event_id AS glucose FROM log WHERE event_type IN ('view', 'purchase'))"""


def _three_sources(t):
    pick = lambda kinds, column, name: t.log.filter(F.col("event_type").isin(kinds)).select("stay_id", "charttime", F.col(column).alias(name))
    return pick(["click", "error"], "value", "creat"), pick(["error", "view"], "value", "creatinine"), pick(["view", "purchase"], "event_id", "glucose")


_ALIGNED = f"""WITH {SQL['log']}, {_SOURCES}
SELECT stay_id, charttime, round(creat, 6) AS creat, round(creatinine, 6) AS creatinine, glucose
FROM a FULL JOIN b USING (stay_id, charttime) FULL JOIN c USING (stay_id, charttime)"""


@query("full_outer_align", _ALIGNED)
def full_outer_align(t):
    return rounded(align.align(list(_three_sources(t)), ["stay_id", "charttime"]), "creat", "creatinine")


@query("union_align", _ALIGNED)
def union_align(t):
    """One shuffle instead of two full joins; the sources have unique (stay, time)."""
    return rounded(align.align(list(_three_sources(t)), ["stay_id", "charttime"], mode="union"), "creat", "creatinine")


@query(
    "merge_measure",
    f"""WITH {SQL['log']}, {_SOURCES},
v AS (SELECT stay_id, charttime, creat AS creat_all FROM a UNION SELECT stay_id, charttime, creatinine + 1 FROM b),
base AS (SELECT stay_id, charttime FROM a)
SELECT stay_id, charttime, round(creat_all, 6) AS creat_all FROM base FULL JOIN v USING (stay_id, charttime)""",
)
def merge_measure(t):
    """Two sources of one measure; where they disagree both values stay."""
    a, b, _ = _three_sources(t)
    shifted = b.withColumn("creatinine", F.col("creatinine") + 1)
    merged = align.merge_measure(a, "creat", shifted, "creatinine", ["stay_id", "charttime"], "creat_all")
    return rounded(merged, "creat_all")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "static_left_join",
    f"""WITH {SQL['log']}, {SQL['detail']}
SELECT log.stay_id, event_id, round(age, 6) AS age, {', '.join(f"coalesce((segment = '{s}')::INTEGER, 0) AS {s}" for s in _SEGMENTS)}
FROM log LEFT JOIN detail ON detail.stay_id = log.stay_id""",
)
def static_left_join(t):
    rows = t.log.select("stay_id", "event_id")
    return rounded(features.static_features(rows, t.detail, "stay_id", ["age"], {"segment": _SEGMENTS}), "age")


@query(
    "span_filter",
    """WITH s AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY 1),
k AS (SELECT * FROM s WHERE round((epoch_us(hi) - epoch_us(lo)) / 86400e6, 4) >= 27),
r AS (SELECT e.user_id, e.event_id, e.ts FROM events e JOIN k USING (user_id)
  WHERE round((epoch_us(hi) - epoch_us(lo)) / 86400e6, 4) <= 28 OR epoch_us(hi) - epoch_us(ts) <= 28 * 86400000000),
again AS (SELECT user_id FROM r GROUP BY 1 HAVING round((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400e6, 4) >= 27)
SELECT user_id AS stay_id, event_id, ts AS charttime FROM r WHERE user_id IN (SELECT user_id FROM again)""",
)
def span_filter(t):
    rows = t.log.select("stay_id", "event_id", "charttime")
    return cohort.span_filter(rows, "stay_id", "charttime", min_days=27, max_days=28)


@query(
    "span_days",
    """SELECT user_id AS stay_id, min(ts) AS first_time, max(ts) AS last_time,
  round((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400e6, 4) AS span_days FROM events GROUP BY 1""",
)
def span_days(t):
    return cohort.spans(t.log, "stay_id", "charttime")


@query(
    "trim_last_days",
    """SELECT user_id AS stay_id, event_id FROM (SELECT *, max(ts) OVER (PARTITION BY user_id) AS hi FROM events)
WHERE epoch_us(hi) - epoch_us(ts) <= 14 * 86400000000""",
)
def trim_last_days(t):
    return cohort.trim_last_days(t.log.select("stay_id", "event_id", "charttime"), "stay_id", "charttime", 14).select("stay_id", "event_id")


_RANKED = """ids AS (SELECT DISTINCT user_id AS stay_id FROM events),
ranked AS (SELECT stay_id, row_number() OVER (ORDER BY md5(stay_id || '|42'), stay_id) AS position, count(*) OVER () AS total FROM ids)"""


@query(
    "entity_split",
    f"""WITH {_RANKED}
SELECT stay_id, CASE WHEN position <= total - ceil(0.2 * total) THEN 'train'
  WHEN position <= total - ceil(0.5 * ceil(0.2 * total)) THEN 'valid' ELSE 'test' END AS split FROM ranked""",
)
def entity_split(t):
    return cohort.split_entities(t.log, "stay_id")


@query(
    "entity_sample",
    f"""WITH {_RANKED}
SELECT user_id AS stay_id, event_id FROM events
WHERE user_id IN (SELECT stay_id FROM ranked WHERE position > total - ceil(0.05 * total))""",
)
def entity_sample(t):
    return cohort.sample_entities(t.log.select("stay_id", "event_id"), "stay_id", 0.05)


@query(
    "one_hot",
    f"""WITH {SQL['detail']}
SELECT stay_id, {', '.join(f"(segment = '{s}')::INTEGER AS {s}" for s in _SEGMENTS)} FROM detail""",
)
def one_hot_segments(t):
    return t.detail.select("stay_id", *one_hot("segment", _SEGMENTS))


@query("materialise_roundtrip", f"WITH {SQL['shipments']} SELECT stay_id, starttime, endtime FROM shipments")
def materialise_roundtrip(t):
    """A derived table written once and scanned again."""
    return sources.materialise(t.shipments.select("stay_id", "starttime", "endtime"), sources.shared_folder(t.spark), sort=["stay_id"])


@query(
    "prediction_roundtrip",
    f"WITH {SQL['pred']} SELECT stay_id, step, model, label, round(prob, 6) AS prob FROM pred WHERE model = 'm1'",
)
def prediction_roundtrip(t):
    """Predictions stored per model; one model is read back by partition pruning."""
    path = sources.shared_folder(t.spark)
    sources.write_predictions(t.predictions.select("stay_id", "step", "model", "label", "prob"), path)
    read = sources.read_predictions(t.spark, path, ["m1"])
    return rounded(read, "prob")


@query(
    "metrics_append",
    f"""WITH {SQL['pred']}
SELECT substr(model, 2)::INTEGER AS run, 'brier' AS metric, round(avg((prob - label) * (prob - label)), 6) AS value FROM pred GROUP BY model""",
)
def metrics_append(t):
    """One metrics row per run, appended in three writes."""
    path = sources.shared_folder(t.spark)
    for run in range(3):
        one = t.predictions.filter(F.col("model") == f"m{run}")
        rows = one.agg(F.avg(F.pow(F.col("prob") - F.col("label"), F.lit(2.0))).alias("value")).select(
            F.lit(run).alias("run"), F.create_map(F.lit("model"), F.lit(f"m{run}")).alias("params"), F.lit("brier").alias("metric"), "value"
        )
        sources.append_metrics(rows, path)
    stored = sources.read_table(t.spark, path, METRICS)
    return rounded(stored.select("run", "metric", "value"), "value")


_MEASURED = """CASE WHEN value > 150 THEN value END AS creat, CASE WHEN event_id % 4 = 0 AND value < 10 THEN value END AS uo_rt_6hr,
    CASE WHEN event_id % 5 = 0 AND value BETWEEN 20 AND 25 THEN value END AS uo_rt_12hr, CASE WHEN event_id % 97 = 0 THEN value END AS uo_rt_24hr"""


def study_sources(t):
    """The inputs of the study in the roles of the driver tables."""
    v, n = F.col("value"), F.col("event_id")
    measures = {
        "creat": F.when(v > 150, v),
        "uo_rt_6hr": F.when((n % 4 == 0) & (v < 10), v),
        "uo_rt_12hr": F.when((n % 5 == 0) & v.between(20, 25), v),
        "uo_rt_24hr": F.when(n % 97 == 0, v),
    }
    shipments = sources.cut_lineage(t.shipments)
    kinds = {k: shipments.filter(F.col("o_orderpriority").isin(*p)).select("stay_id", "starttime", "endtime") for k, p in _KINDS.items()}
    return {
        "stays": t.stays,
        "detail": t.detail,
        "stages": t.log.select("stay_id", "charttime", *[c.alias(k) for k, c in measures.items()], F.col("stage").alias("aki_stage")),
        "lab_events": t.coded(LAB_CODES, stay=False),
        "chart_events": t.coded(VITAL_CODES, stay=True),
        "input_events": t.infusions,
        "ventilation": kinds["vent"],
        "vasopressor": kinds["vasopressor"],
    }


def _inside_sql(name: str, source: str) -> str:
    return f"""(SELECT max(1) FROM {source} i WHERE i.stay_id = m.stay_id AND i.starttime <= m.charttime AND i.endtime >= m.charttime) AS {name}"""


_STUDY = f"""WITH {SQL['log']}, {SQL['stays']}, {SQL['detail']}, {SQL['shipments']}, {SQL['infusions'].replace('infusions AS', 'all_infusions AS')},
{coded_sql('lab_log', LAB_CODES)}, {coded_sql('vital_log', VITAL_CODES)},
stages AS (SELECT stay_id, charttime, stage, {_MEASURED} FROM log),
chosen AS (SELECT DISTINCT stay_id FROM stages WHERE stage IS NOT NULL AND coalesce(creat, uo_rt_6hr, uo_rt_12hr, uo_rt_24hr) IS NOT NULL),
kept AS (SELECT * FROM stays WHERE stay_id IN (SELECT stay_id FROM chosen)),
labs AS (
  SELECT s.stay_id, e.charttime, max(valuenum) FILTER (itemid = 50868 AND valuenum <= 10000) AS top
  FROM kept s LEFT JOIN (SELECT * FROM lab_log WHERE valuenum > 0) e ON e.subject_id = s.subject_id AND e.hadm_id = s.hadm_id GROUP BY 1, 2),
vitals AS (
  SELECT s.stay_id, e.charttime, avg(valuenum) FILTER (itemid IN (615, 618, 220210, 224690) AND valuenum > 0 AND valuenum < 70) AS top
  FROM kept s JOIN vital_log e ON e.stay_id = s.stay_id AND e.subject_id = s.subject_id AND e.hadm_id = s.hadm_id
  WHERE warning IS DISTINCT FROM 1 GROUP BY 1, 2),
infusions AS (SELECT * FROM all_infusions WHERE itemid IN (30124, 30150, 30308, 30118, 30149, 30131)), {_CARRIED}, {_EPISODES},
sedation AS (
  SELECT stay_id, starttime, endtime FROM episodes
  UNION ALL SELECT stay_id, min(starttime), max(endtime) FROM all_infusions
  WHERE itemid IN (221668, 221744, 225972, 225942, 222168) AND statusdescription <> 'Rewritten' GROUP BY stay_id, linkorderid),
vent AS (SELECT * FROM shipments WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
vaso AS (SELECT * FROM shipments WHERE o_orderpriority = '3-MEDIUM'),
moments AS (
  SELECT stay_id, charttime FROM stages WHERE stay_id IN (SELECT stay_id FROM chosen)
  UNION SELECT stay_id, charttime FROM labs UNION SELECT stay_id, charttime FROM vitals),
flags AS (
  SELECT stay_id, charttime, {_inside_sql('vent', 'vent')}, {_inside_sql('vasopressor', 'vaso')}, {_inside_sql('sedative', 'sedation')}
  FROM moments m),"""


@query(
    "study_extract",
    f"""{_STUDY}
rows AS (
  SELECT 'stages' AS source, stay_id, coalesce(creat, 0) + coalesce(uo_rt_6hr, 0) + coalesce(uo_rt_12hr, 0) + coalesce(uo_rt_24hr, 0) AS v
    FROM stages WHERE stay_id IN (SELECT stay_id FROM chosen)
  UNION ALL SELECT 'detail', stay_id, age FROM detail WHERE stay_id IN (SELECT stay_id FROM chosen)
  UNION ALL SELECT 'labs', stay_id, coalesce(top, 0) FROM labs
  UNION ALL SELECT 'vitals', stay_id, coalesce(top, 0) FROM vitals
  UNION ALL SELECT 'flags', stay_id, coalesce(vent, 0) + 10 * coalesce(vasopressor, 0) + 100 * coalesce(sedative, 0) FROM flags)
SELECT source, stay_id, count(*) AS n, round(sum(v), 4) AS total FROM rows GROUP BY 1, 2""",
)
def study_extract(t):
    """All five tables of the study: rows per stay and a sum over one or more columns."""
    tables = extract.study_tables(**study_sources(t))
    nothing = F.lit(0.0)
    values = {
        "stages": sum((F.coalesce(c, nothing) for c in extract.MEASURES), nothing),
        "detail": F.col("age"),
        "labs": F.coalesce("aniongap_max", nothing),
        "vitals": F.coalesce("resprate_mean", nothing),
        "flags": F.col("vent") + 10 * F.col("vasopressor") + 100 * F.col("sedative"),
    }
    parts = [df.select(F.lit(k).alias("source"), "stay_id", values[k].cast("double").alias("v")) for k, df in tables.items()]
    rows = cohort.union_all(parts).groupBy("source", "stay_id").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
    return rounded(rows, "total", digits=4)


@query(
    "prepare_study",
    f"""{_STUDY}
adults AS (SELECT stay_id FROM detail WHERE age >= 18),
staged AS (SELECT stay_id, charttime, max(stage) AS stage FROM stages GROUP BY 1, 2),
observed AS (
  SELECT f.stay_id, f.charttime, stage, coalesce(vent, 0) AS vent, coalesce(vasopressor, 0) AS vasopressor, coalesce(sedative, 0) AS sedative
  FROM flags f LEFT JOIN staged s ON s.stay_id = f.stay_id AND s.charttime = f.charttime
  WHERE f.charttime IS NOT NULL AND f.stay_id IN (SELECT stay_id FROM adults)),
long AS (
  SELECT stay_id FROM observed GROUP BY 1 HAVING round((epoch_us(max(charttime)) - epoch_us(min(charttime))) / 86400e6, 4) >= 2),
buckets AS (
  SELECT stay_id, time_bucket(INTERVAL '6 hours', charttime) AS charttime, max(stage) AS stage, max(vent) AS vent,
    max(vasopressor) AS vasopressor, max(sedative) AS sedative FROM observed WHERE stay_id IN (SELECT stay_id FROM long) GROUP BY 1, 2),
slots AS (SELECT stay_id, unnest(generate_series(min(charttime), max(charttime), INTERVAL '6 hours')) AS charttime FROM buckets GROUP BY 1),
filled AS (
  SELECT s.stay_id, s.charttime, coalesce(vent, 0) AS vent, coalesce(vasopressor, 0) AS vasopressor, coalesce(sedative, 0) AS sedative,
    CASE WHEN coalesce(last_value(stage IGNORE NULLS) OVER (PARTITION BY s.stay_id ORDER BY s.charttime
      ROWS BETWEEN 16 PRECEDING AND CURRENT ROW), 0) >= 1 THEN 1 ELSE 0 END AS now
  FROM slots s LEFT JOIN buckets b ON b.stay_id = s.stay_id AND b.charttime = s.charttime),
ahead AS (SELECT *, lead(now, 8) OVER (PARTITION BY stay_id ORDER BY charttime) AS later FROM filled),
cuts AS (
  SELECT stay_id, coalesce(min(charttime) FILTER (later = 1), max(charttime)) AS cut, max(later) AS label
  FROM ahead WHERE later IS NOT NULL GROUP BY 1),
ranked AS (SELECT stay_id, label, cut, row_number() OVER (ORDER BY md5(stay_id || '|42'), stay_id) AS position, count(*) OVER () AS total FROM cuts)
SELECT r.stay_id, label, CASE WHEN position <= total - ceil(0.2 * total) THEN 'train'
    WHEN position <= total - ceil(0.5 * ceil(0.2 * total)) THEN 'valid' ELSE 'test' END AS split,
  count(*) AS n, min(a.charttime) AS first_time, max(a.charttime) AS last_time,
  sum(vent)::BIGINT AS vent, sum(vasopressor)::BIGINT AS vasopressor, sum(sedative)::BIGINT AS sedative, true AS scaled
FROM ranked r JOIN ahead a ON a.stay_id = r.stay_id AND a.later IS NOT NULL AND a.charttime <= r.cut
GROUP BY r.stay_id, label, position, total""",
)
def prepare_study(t):
    """The preparation of the extracted study: per stay its label, split, rows and flags; all other features within [0, 1]."""
    key = F.col("stay_id")
    levels = {
        "gender": F.when(key % 2 == 0, "F").otherwise("M"),
        "ethnicity_grouped": F.when(key % 3 == 0, "asian").otherwise("white"),
        "admission_type": F.when(key % 5 == 0, "ELECTIVE").otherwise("URGENT"),
    }
    given = study_sources(t)
    made = preparation.prepare(extract.study_tables(**given | {"detail": given["detail"].withColumns(levels)}))
    inside = [F.min(F.coalesce(F.col(c), F.lit(0.0)).between(0, 1)) for c in made.scaled]
    return made.rows.groupBy("stay_id", F.col("stage").alias("label"), "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("charttime").alias("first_time"), F.max("charttime").alias("last_time"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("vent", "vasopressor", "sedative")], F.least(*inside).alias("scaled"),
    )
