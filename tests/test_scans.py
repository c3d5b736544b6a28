import collections

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from wardline.operators import intervals, scans
from wardline.operators.scans import SLICE, Running, attach, number_rows, rank_rows, running, split_large


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to key 0; some keys are null or unknown to the lookup."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 17)
    return spark.range(600).select(key.cast("bigint").alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_attach_equals_a_plain_join(spark, skewed, how):
    lookup = spark.range(0, 12).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    found = attach(skewed, lookup, ["k"], how)
    expected = skewed.join(lookup, "k", how)
    assert found.columns == expected.columns and rows(found) == rows(expected)


@pytest.mark.parametrize("columns", [["k", "v"], ["k"]])
def test_large_key_is_split(spark, columns):
    """Spark splits the rows of a hot key, also where rows have nothing but the key and the lookup is grouped."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        hot = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
        lookup = hot.groupBy("k").agg(F.count("*").alias("n"))
        joined = attach(hot.select(*columns), lookup, ["k"])
        assert len(joined.collect()) == 60_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_slices_have_like_sizes_whatever_the_moments(spark):
    """One moment far from all others, and a group of a third of all rows: no slice is over twice the limit."""
    moment = F.when(F.col("id") == 0, F.lit("1970-01-01").cast("timestamp_ntz")).otherwise(
        F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz"))
    )
    df = spark.range(10_000).select(F.lit(7).alias("k"), moment.alias("t")).union(spark.range(20_000).select(F.col("id") + 100, moment))
    sliced, cut = split_large(df, ["k"], "t", 1000)
    assert cut and sliced.count() == 30_000
    sizes = [r["n"] for r in sliced.filter("k = 7").groupBy(SLICE).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2000 and len(sizes) >= 5
    ends = sliced.filter("k = 7").groupBy(SLICE).agg(F.min("t").alias("a"), F.max("t").alias("b")).orderBy(SLICE).collect()
    assert all(x["b"] < y["a"] for x, y in zip(ends, ends[1:]))


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_number_rows(spark, kind):
    """Ids at both ends of their type, and as text."""
    ids = [-(2**63), 2**63 - 1, 0, *range(5, 50)]
    df = spark.createDataFrame([(i,) for i in ids], "k bigint").select(F.col("k").cast(kind).alias("k"))
    found = {r["k"]: r["n"] for r in number_rows(df, [F.col("k").asc()], "n").collect()}
    assert found == {k: i + 1 for i, k in enumerate(sorted(map(str, ids) if kind == "string" else ids))}


def test_rank_rows(spark, skewed):
    known = skewed.filter("k is not null")
    ranked = rank_rows(known, ["k"], F.floor(F.col("v") / 50), [F.col("v")], "r", total="n")
    from pyspark.sql import Window

    w = Window.partitionBy("k")
    expected = known.withColumn("r", F.row_number().over(w.orderBy("v"))).withColumn("n", F.count("*").over(w))
    assert rows(ranked, "k", "v", "r", "n") == rows(expected, "k", "v", "r", "n")


def test_a_small_limit_gives_a_bounded_number_of_slices(spark, monkeypatch):
    """Tasks must not grow with rows over a small limit; running values are the same as without slices."""
    monkeypatch.setattr(scans, "MAX_SLICES", 6)
    df = spark.range(2_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"), F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"))
    sliced, cut = split_large(df, ["k"], "t", 10)
    assert cut and 3 <= sliced.select(SLICE).distinct().count() <= 6
    last = {"w": Running("last", F.col("v"))}
    plain = running(split_large(df, ["k"], "t", None)[0], ["k"], "t", last, sliced=False)
    assert rows(running(sliced, ["k"], "t", last), "k", "t", "w") == rows(plain, "k", "t", "w")


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(scans, "TASK_ROWS", 50)
    assert scans.tasks_for(spark, 1000) == 20 and scans.tasks_for(spark, 100) is None
    times = spark.range(1000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 40).alias("stay_id"), F.timestamp_seconds(F.col("id") * 3600).alias("charttime"))
    starts = F.timestamp_seconds(F.col("id") * 10_000)
    spans = spark.range(300).select((F.col("id") % 40).alias("stay_id"), starts.alias("starttime"), (starts + F.expr("INTERVAL 9 HOURS")).alias("endtime"))
    dealt = intervals.flag_at([times, times], spans, "inside", tasks=20)
    prepared, sliced = scans.split_large(times, ["stay_id"], "charttime")
    assert prepared.rdd.getNumPartitions() == 20 and not sliced
    held = dealt.collect()
    monkeypatch.setattr(scans, "TASK_ROWS", 1 << 20)
    assert collections.Counter(held) == collections.Counter(intervals.flag_at([times], spans, "inside").collect())
    asked = {(r["stay_id"], r["charttime"]): 0 for r in times.collect()}
    for s in spans.collect():
        for k, at in asked:
            if k == s["stay_id"] and s["starttime"] <= at <= s["endtime"]:
                asked[k, at] = 1
    assert {(r["stay_id"], r["charttime"]): r["inside"] for r in held} == asked and len(held) == len(asked)
