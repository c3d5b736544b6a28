"""Registry of the driver queries: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from wardline.operators.scans import deal, tasks_for
from wardline.session import own_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The driver tables and the roles they play for this library."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        """Scan of a driver table; its schema is looked up in the file once."""
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @property
    def log(self) -> DataFrame:
        """Event log of the stays; ``stage`` is known on error events only."""
        v = F.col("value")
        stage = F.when(v < 40, 0).when(v < 80, 1).when(v < 160, 2).otherwise(3)
        return self.read("events").select(
            F.col("user_id").alias("stay_id"),
            F.col("ts").alias("charttime"),
            "event_id",
            "event_type",
            "value",
            F.when(F.col("event_type") == "error", stage).alias("stage"),
        )

    @property
    def stays(self) -> DataFrame:
        """Two stays per admission."""
        pair = F.floor(F.col("c_custkey") / 2)
        return self.read("customer").select(
            pair.alias("subject_id"), pair.alias("hadm_id"), F.col("c_custkey").alias("stay_id")
        )

    def coded(self, codes: list[int], stay: bool) -> DataFrame:
        """The event log with one of the given codes per event."""
        pair = F.floor(F.col("stay_id") / 2)
        itemid = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.pmod("event_id", F.lit(len(codes))) + 1).cast("int"))
        valuenum = F.when(F.pmod("event_id", F.lit(13)) != 0, F.col("value"))
        warning = F.when(F.pmod("event_id", F.lit(11)) == 0, 1).when(F.pmod("event_id", F.lit(3)) == 0, 0)
        kept = ["stay_id"] if stay else []
        return self.log.select(
            pair.alias("subject_id"), pair.alias("hadm_id"), *kept, itemid.alias("itemid"), "charttime",
            valuenum.alias("valuenum"), warning.cast("int").alias("warning"),
        )

    @property
    def infusions(self) -> DataFrame:
        """Infusion log: rates with gaps, orders of one day, order status."""
        code = (
            F.when(F.col("event_type") == "click", 30124)
            .when(F.col("event_type") == "view", 30150)
            .when(F.col("event_type") == "purchase", 221668)
            .when(F.col("event_type") == "signup", 221744)
            .otherwise(42273)
        )
        status = F.when(F.pmod("event_id", F.lit(5)) == 0, "Rewritten").when(F.pmod("event_id", F.lit(5)) < 4, "Stopped")
        return self.log.select(
            "stay_id",
            code.alias("itemid"),
            F.col("charttime").alias("starttime"),
            F.timestamp_add("SECOND", F.floor(F.col("value") * 60).cast("bigint"), F.col("charttime")).alias("endtime"),
            F.when(F.pmod("event_id", F.lit(7)) != 0, F.floor(F.col("value") / 25).cast("double")).alias("rate"),
            F.col("value").alias("amount"),
            F.dayofmonth("charttime").cast("bigint").alias("linkorderid"),
            status.alias("statusdescription"),
        )

    @property
    def item_tasks(self) -> int | None:
        """Tasks that the items, one line per shipped part, are dealt out to; the files know how many there are."""
        return tasks_for(self.spark, self.read("lineitem").count())

    @property
    def shipments(self) -> DataFrame:
        """About ten overlapping intervals per customer: first to last shipment of an order."""
        items = deal(self.read("lineitem").select("l_orderkey", "l_shipdate"), self.item_tasks, "l_orderkey")
        bounds = items.groupBy("l_orderkey").agg(
            F.min("l_shipdate").alias("starttime"), F.max("l_shipdate").alias("endtime")
        )
        orders = self.read("orders").select("o_orderkey", F.col("o_custkey").alias("stay_id"), "o_orderpriority")
        orders = deal(orders, self.item_tasks, "o_orderkey")
        return bounds.join(orders, bounds["l_orderkey"] == orders["o_orderkey"]).select(
            "stay_id", "starttime", "endtime", "o_orderpriority"
        )

    @property
    def order_times(self) -> DataFrame:
        return self.read("orders").select(F.col("o_custkey").alias("stay_id"), F.col("o_orderdate").alias("charttime"))

    @property
    def ship_times(self) -> DataFrame:
        items = self.read("lineitem").select("l_orderkey", F.col("l_shipdate").alias("charttime"))
        orders = self.read("orders").select("o_orderkey", F.col("o_custkey").alias("stay_id"))
        items, orders = deal(items, self.item_tasks, "l_orderkey"), deal(orders, self.item_tasks, "o_orderkey")
        return items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).select("stay_id", "charttime")

    @property
    def detail(self) -> DataFrame:
        """Static attributes of every customer."""
        return self.read("customer").select(
            F.col("c_custkey").alias("stay_id"), F.col("c_acctbal").alias("age"), F.col("c_mktsegment").alias("segment")
        )

    @property
    def predictions(self) -> DataFrame:
        """A probability per event, three models, one step per day."""
        return self.log.select(
            "stay_id",
            "charttime",
            F.dayofmonth("charttime").cast("int").alias("step"),
            F.concat(F.lit("m"), F.pmod("event_id", F.lit(3)).cast("string")).alias("model"),
            F.col("event_type").isin("error", "purchase").cast("int").alias("label"),
            (F.col("value") / (F.col("value") + 1)).alias("prob"),
        )


# The same roles for the oracle.
SQL = {
    "log": """log AS (
  SELECT user_id AS stay_id, ts AS charttime, event_id, event_type, value,
    CASE WHEN event_type = 'error' THEN CASE WHEN value < 40 THEN 0 WHEN value < 80 THEN 1 WHEN value < 160 THEN 2 ELSE 3 END END AS stage
  FROM events)""",
    "stays": "stays AS (SELECT c_custkey // 2 AS subject_id, c_custkey // 2 AS hadm_id, c_custkey AS stay_id FROM customer)",
    "infusions": """infusions AS (
  SELECT user_id AS stay_id,
    CASE event_type WHEN 'click' THEN 30124 WHEN 'view' THEN 30150 WHEN 'purchase' THEN 221668 WHEN 'signup' THEN 221744 ELSE 42273 END AS itemid,
    ts AS starttime, ts + to_seconds(floor(value * 60)::BIGINT) AS endtime,
    CASE WHEN event_id % 7 <> 0 THEN floor(value / 25) END AS rate, value AS amount,
    day(ts) AS linkorderid,
    CASE WHEN event_id % 5 = 0 THEN 'Rewritten' WHEN event_id % 5 < 4 THEN 'Stopped' END AS statusdescription
  FROM events)""",
    "shipments": """shipments AS (
  SELECT o_custkey AS stay_id, starttime, endtime, o_orderpriority
  FROM (SELECT l_orderkey, min(l_shipdate) AS starttime, max(l_shipdate) AS endtime FROM lineitem GROUP BY 1) b
  JOIN orders ON l_orderkey = o_orderkey)""",
    "times": """times AS (
  SELECT o_custkey AS stay_id, o_orderdate AS charttime FROM orders
  UNION SELECT o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "detail": "detail AS (SELECT c_custkey AS stay_id, c_acctbal AS age, c_mktsegment AS segment FROM customer)",
    "pred": """pred AS (
  SELECT user_id AS stay_id, ts AS charttime, day(ts)::INTEGER AS step, 'm' || (event_id % 3) AS model,
    (event_type IN ('error', 'purchase'))::INTEGER AS label, value / (value + 1) AS prob
  FROM events)""",
}


def coded_sql(name: str, codes: list[int]) -> str:
    listed = ", ".join(map(str, codes))
    return f"""{name} AS (
  SELECT user_id // 2 AS subject_id, user_id // 2 AS hadm_id, user_id AS stay_id,
    [{listed}][event_id % {len(codes)} + 1] AS itemid, ts AS charttime,
    CASE WHEN event_id % 13 <> 0 THEN value END AS valuenum,
    CASE WHEN event_id % 11 = 0 THEN 1 WHEN event_id % 3 = 0 THEN 0 END AS warning
  FROM events)"""


def grid_sql() -> str:
    """Six-hour grid of the event log: mean and highest value, highest stage."""
    return (
        SQL["log"]
        + """,
buckets AS (
  SELECT stay_id, time_bucket(INTERVAL '6 hours', charttime) AS charttime,
    avg(value) AS value_mean, max(value) AS value_max, max(stage) AS stage
  FROM log GROUP BY 1, 2),
slots AS (
  SELECT stay_id, unnest(generate_series(min(charttime), max(charttime), INTERVAL '6 hours')) AS charttime
  FROM buckets GROUP BY 1),
grid AS (
  SELECT s.stay_id, s.charttime, value_mean, value_max, stage
  FROM slots s LEFT JOIN buckets b ON b.stay_id = s.stay_id AND b.charttime = s.charttime)"""
    )


def labelled_sql(threshold: int = 1) -> str:
    """Grid with the label of 48 hours later: is the stage at least ``threshold``."""
    return (
        grid_sql()
        + f""",
filled AS (
  SELECT stay_id, charttime, value_mean, value_max,
    CASE WHEN coalesce(last_value(stage IGNORE NULLS) OVER (PARTITION BY stay_id ORDER BY charttime
      ROWS BETWEEN 16 PRECEDING AND CURRENT ROW), 0) >= {threshold} THEN 1 ELSE 0 END AS now
  FROM grid),
labelled AS (
  SELECT stay_id, charttime, value_mean, value_max, label FROM (
    SELECT *, lead(now, 8) OVER (PARTITION BY stay_id ORDER BY charttime) AS label FROM filled)
  WHERE label IS NOT NULL)"""
    )


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name."""

    def register(f):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            own_folder(spark)
            return f(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
