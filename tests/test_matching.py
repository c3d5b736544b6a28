"""Null keys in slices, interval matches, stacked alignment, densities, decayed history, counted slices, published versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import at, frame, hour, rows
from wardline.operators import align, evaluate, features, grid, intervals
from wardline.operators.scans import SLICE, Running, affine, number_rows, rank_rows, running, split_large
from wardline.sources import tables

STARTED = "stay_id long, starttime timestamp_ntz, rate double"


def infusions(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, None, 1, 2]), at(h / 4), rng.choice([None, 0.0, 0.0, 1.0, 2.0])) for h in range(200)]
    return frame(spark, STARTED, data)


@pytest.mark.parametrize("limit", [3, 20])
def test_slices_carry_over_null_keys(spark, limit):
    events = infusions(spark)
    plain = intervals.carry_rate(events, ["stay_id"], max_rows=None)
    assert rows(intervals.carry_rate(events, ["stay_id"], max_rows=limit)) == rows(plain)
    assert rows(intervals.episodes(events, ["stay_id"], max_rows=limit)) == rows(intervals.episodes(events, ["stay_id"], max_rows=None))


def test_curves_and_ranks_of_a_null_group(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, "m"]), i, rng.randint(0, 1), rng.random()) for i in range(400)]
    pred = frame(spark, "model string, stay_id long, label int, prob double", data)
    sliced, plain = evaluate.curve(pred, cell_scores=30), evaluate.curve(pred, cell_scores=10**6)
    assert rows(sliced.drop("__group")) == rows(plain.drop("__group"))
    assert rows(evaluate.curve_area(sliced, ["model"])) == rows(evaluate.curve_area(plain, ["model"]))
    ranked = rank_rows(pred, ["model"], F.floor(F.col("prob") * 10), [F.col("prob")], "r", total="n").collect()
    for model in (None, "m"):
        mine = sorted((x for x in ranked if x.model == model), key=lambda x: x.prob)
        assert [x.r for x in mine] == list(range(1, len(mine) + 1)) and {x.n for x in mine} == {len(mine)}


@pytest.mark.parametrize("limit", [None, 4])
def test_flags_and_union_in_slices(spark, limit):
    spans = frame(spark, "stay_id long, starttime timestamp_ntz, endtime timestamp_ntz", [(1, at(i * 3), at(i * 3 + i % 5)) for i in range(30)] + [(None, at(0), at(9))])
    times = frame(spark, "stay_id long, charttime timestamp_ntz", [(1, at(i)) for i in range(100)] + [(None, at(1))])
    found = rows(intervals.flag_at([times], spans, "inside", max_rows=limit))
    inside = lambda h: int(any(i * 3 <= h <= i * 3 + i % 5 for i in range(30)))
    assert found == sorted([(1, at(i), inside(i)) for i in range(100)] + [(None, at(1), 0)], key=lambda r: tuple((x is None, x) for x in r))


def brute_matches(moments, spans):
    return sorted((k, t, a, b, c) for k, t in set(moments) for k2, a, b, c in spans if None not in (k, t, k2, a, b) and k == k2 and a <= t <= b)


def test_intervals_at_against_brute_force(spark):
    """Lengths from nothing to years, repeats, reversed intervals, null bounds, two rows at one moment."""
    rng = random.Random(11)
    spans = []
    for i in range(300):
        a, length = rng.uniform(-5000, 5000), rng.choice([0, 0.2, 1, 4, 5, 70, 900, 20000, -3])
        spans.append((rng.choice([1, 1, 2, None]), at(a), at(a + length) if i % 17 else None, f"c{i % 9}"))
    spans += spans[:5] + [(1, at(0), at(1), "edge"), (1, at(1), at(4), "edge")]
    moments = [(rng.choice([1, 2, 3, None]), at(rng.uniform(-6000, 8000))) for _ in range(200)] + [(1, at(1)), (1, at(1)), (1, None)]
    times = frame(spark, "stay_id long, charttime timestamp_ntz", moments)
    table = frame(spark, "stay_id long, starttime timestamp_ntz, endtime timestamp_ntz, kind string", spans)
    expected = brute_matches(moments, spans)
    found = intervals.intervals_at(times, table, ["stay_id"])
    assert rows(found, "stay_id", "charttime", "starttime", "endtime", "kind") == expected and expected
    first = intervals.first_interval_at(times, table, ["stay_id"], columns=["kind"]).collect()
    assert len(first) == len(set(moments))
    for r in first:
        mine = [m[2:] for m in expected if m[:2] == (r.stay_id, r.charttime)]
        assert r.n_intervals == len(mine) and (r.starttime, r.endtime, r.kind) == (min(mine) if mine else (None, None, None))


@pytest.mark.parametrize("plain, per_bin", [(0, 1), (20, 4), (1000, 4)])
def test_keys_and_bins_of_many_intervals(spark, monkeypatch, plain, per_bin):
    """Keys with few intervals are not binned, full bins are dealt out in parts: the matches are the same, each found once."""
    monkeypatch.setattr(intervals, "PLAIN_INTERVALS", plain)
    monkeypatch.setattr(intervals, "BIN_INTERVALS", per_bin)
    rng = random.Random(12)
    spans = [(rng.choice([1, 1, 1, 2, None]), at(a := rng.uniform(0, 300)), at(a + rng.choice([0, 1, 30, 400])), i % 3) for i in range(120)]
    spans += [(2, at(10), at(20), 7)] * 9 + [(4, at(0), at(1), 0)]
    moments = [(rng.choice([1, 2, 3, 4, None]), at(rng.uniform(-10, 500))) for _ in range(60)] + [(2, at(10)), (2, at(20)), (4, at(1))]
    times = frame(spark, "stay_id long, charttime timestamp_ntz", moments + moments[:9])
    table = frame(spark, "stay_id long, starttime timestamp_ntz, endtime timestamp_ntz, kind int", spans)
    expected = brute_matches(moments, spans)
    assert rows(intervals.intervals_at(times, table, ["stay_id"]), "stay_id", "charttime", "starttime", "endtime", "kind") == expected
    first = intervals.first_interval_at(times, table, ["stay_id"], columns=["kind"]).collect()
    assert len(first) == len(set(moments)) and sum(r.n_intervals for r in first) == len(expected)


def test_intervals_at_of_empty_tables(spark):
    times = frame(spark, "k long, charttime timestamp_ntz", [(1, at(0))])
    none = frame(spark, "k long, starttime timestamp_ntz, endtime timestamp_ntz", [])
    assert intervals.intervals_at(times, none, ["k"]).collect() == []
    assert intervals.intervals_at(times.limit(0), none, ["k"]).collect() == []
    assert rows(intervals.first_interval_at(times, none, ["k"]), "k", "n_intervals") == [(1, 0)]


def test_long_and_short_intervals_touch_two_bins(spark):
    spans = [(1, at(0), at(h), str(h)) for h in (0.1, 1, 3, 100, 30_000, 200_000)]
    table = frame(spark, "k long, starttime timestamp_ntz, endtime timestamp_ntz, kind string", spans)
    times = frame(spark, "k long, charttime timestamp_ntz", [(1, at(0.05)), (1, at(99_000))])
    assert sorted(rows(intervals.intervals_at(times, table, ["k"]), "kind")) == sorted([(k,) for k in ("0.1", "1", "3", "100", "30000", "200000")] + [("200000",)])


def sources_with_repeats(spark):
    schema = "k long, t long, {} long"
    a = frame(spark, schema.format("a"), [(1, 1, 10), (1, 1, 11), (1, 2, 12), (None, 1, 13), (2, None, 14), (None, 1, 13)])
    b = frame(spark, schema.format("b"), [(1, 1, 20), (1, 1, 20), (1, 1, None), (3, 1, 21), (None, 1, 22)])
    c = frame(spark, "k long, t long", [(1, 1), (1, 1), (4, 4), (None, None)])
    d = frame(spark, "k long, t long, d string, e int", [(1, 1, "x", 1), (3, 1, "y", None), (4, 4, None, None), (4, 4, None, None)])
    return [a, b, c, d]


@pytest.mark.parametrize("count", [1, 2, 3, 4])
def test_stacked_alignment_equals_the_joins(spark, count):
    parts = sources_with_repeats(spark)[:count]
    stacked = align.align(parts, ["k", "t"], mode="stacked")
    joined = align.align(parts, ["k", "t"])
    assert stacked.columns == joined.columns and rows(stacked) == rows(joined)


def test_stacked_alignment_shuffles_once(spark):
    plan = align.align(sources_with_repeats(spark), ["k", "t"], mode="stacked")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_density_is_near_the_direct_sum(spark):
    rng = np.random.default_rng(2)
    data = [("a", 0, float(p)) for p in rng.beta(2, 9, 700)] + [("a", 1, float(p)) for p in rng.beta(7, 2, 300)]
    data += [("b", 0, 0.25), ("c", 1, 0.5), ("c", 1, 0.5), ("c", None, 0.1), ("a", 0, None), ("a", 0, 1.5), ("d", 0, 0.0), ("d", 0, 1.0)]
    pred = frame(spark, "model string, label int, prob double", data)
    found = evaluate.class_density(pred).collect()
    for model, label in (("a", 0), ("a", 1), ("d", 0)):
        values = np.array([p for m, y, p in data if (m, y) == (model, label) and p is not None and p <= 1])
        h = values.std(ddof=1) * len(values) ** -0.2
        mine = sorted((r for r in found if (r.model, r.label) == (model, label)), key=lambda r: r.point)
        assert len(mine) == evaluate.DENSITY_POINTS
        for r in mine:
            direct = np.exp(-0.5 * ((r.x - values) / h) ** 2).sum() / (len(values) * h * math.sqrt(2 * math.pi))
            assert abs(r.density - direct) < 1e-3
    assert all(r.density is None for r in found if r.model in "bc") and {r.label for r in found if r.model == "c"} == {1}


def recursive_state(data, factor):
    out, state, last = [], None, None
    for t, v in data:
        state = v if state is None else state * factor(t - last) + v
        last = t
        out.append(state)
    return out


@pytest.mark.parametrize("limit", [None, 7])
def test_affine_states_equal_the_recursion(spark, limit):
    """Steps from minutes to years: levels fall by far more than one segment."""
    rng = random.Random(8)
    series, t = [], 0.0
    for i in range(120):
        t += rng.choice([0.01, 1, 30, 400, 30_000]) if i else 0
        series.append((t, rng.choice([None, 1.0, -2.5, 1e6])))
    data = [(k, at(t), v) for k in (1, None) for t, v in series]
    made, sliced = split_large(frame(spark, "k long, t timestamp_ntz, v double", data), ["k"], "t", limit)
    hours = F.timestamp_diff("MICROSECOND", F.lit(at(0)), F.col("t")) / F.lit(3.6e9)
    found = affine(made, ["k"], "t", -hours / F.lit(24.0), {"s": F.col("v")}, sliced=sliced).collect()
    expected = recursive_state([(hour(at(t)), v or 0.0) for t, v in series], lambda d: math.exp(-d / 24))
    for key in (1, None):
        mine = sorted((r for r in found if r.k == key), key=lambda r: r.t)
        assert [r.s for r in mine] == pytest.approx(expected, rel=1e-9, abs=1e-9)


def test_decayed_history(spark):
    data = [(1, at(0), None, 1.0), (1, at(6), 2.0, None), (1, at(12), None, None), (1, at(18), 8.0, 3.0), (2, at(0), 5.0, None)]
    table = frame(spark, "k long, t timestamp_ntz, x double, y double", data)
    plain = grid.decayed_history(table, "k", "t", ["x", "y"], 6, 12)
    last = next(r for r in plain.collect() if r.k == 1 and r.t == at(18))
    assert last.x_fast == pytest.approx((2 / 4 + 8) / (1 / 4 + 1)) and last.x_slow == pytest.approx((2 / 2 + 8) / (1 / 2 + 1))
    assert last.x_trend == pytest.approx(last.x_fast - last.x_slow) and last.x_since == 0
    assert rows(plain, "k", "t", "x_fast", "x_since")[0] == (1, at(0), None, None)
    assert rows(plain, "k", "t", "x_since")[2] == (1, at(12), 6.0)
    sliced = grid.decayed_history(table, "k", "t", ["x", "y"], 6, 12, max_rows=2)
    for a, b in zip(rows(sliced), rows(plain), strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:])


def test_dense_values_are_cut_by_counts(spark):
    """A million values within 1e-12 and an outlier in one cell: no slice is over twice the bound."""
    bound = 100_000
    dense = spark.range(0, 1_000_000, 1, 8).select((F.lit(1.0) + F.floor(F.col("id") / 250) * F.lit(2.3e-16)).alias("v"))
    table = dense.union(spark.range(1).select(F.lit(1.0001).alias("v")))
    (q,) = features.exact_quantiles(table, ["v"], [0.0, 0.5, 1.0], max_values=500).collect()
    values = np.append(np.array([1.0 + math.floor(i / 250) * 2.3e-16 for i in range(0, 1_000_000)]), 1.0001)
    assert (q.q0, q.q1, q.q2) == (1.0, np.quantile(values, 0.5), 1.0001)
    distinct = spark.range(0, 1_000_000, 1, 8).select(F.lit("v").alias("column"), F.lit(0).alias("cell"), (F.col("id") * F.lit(1e-18)).alias("value"))
    outlier = spark.range(1).select(F.lit("v").alias("column"), F.lit(0).alias("cell"), F.lit(1.0).alias("value"))
    sliced, cut = split_large(distinct.union(outlier), ["column", "cell"], "value", bound)
    assert cut and max(r["n"] for r in sliced.groupBy(SLICE).agg(F.count("*").alias("n")).collect()) <= 2 * bound


def test_published_versions(spark):
    path = tables.shared_folder(spark)
    with pytest.raises(ValueError):
        tables.read_published(spark, path)
    first = tables.publish(frame(spark, "k long", [(1,), (2,)]), path)
    pinned = tables.read_published(spark, path)
    # a writer that is lost on the way: rows are there, the last step is not
    frame(spark, "k long", [(9,)]).write.parquet(f"{path}/0000000002-lost")
    assert rows(tables.read_published(spark, path)) == [(1,), (2,)]
    failing = frame(spark, "k long", [(1,), (2,)]).select(F.raise_error(F.lit("lost")).cast("long").alias("k"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(failing, path)
    assert tables.published_versions(spark, path) == [first]
    second = tables.publish(tables.read_published(spark, path).select((F.col("k") * 10).alias("k")), path)
    assert rows(tables.read_published(spark, path)) == [(10,), (20,)]
    assert rows(pinned) == rows(tables.read_published(spark, path, first)) == [(1,), (2,)]
    tables.drop_versions(spark, path)
    assert tables.published_versions(spark, path) == [second]
    assert rows(tables.read_published(spark, path)) == [(10,), (20,)]
    with pytest.raises(ValueError):
        tables.read_published(spark, path, first)


def test_running_totals_over_slices(spark):
    table = spark.range(20).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"), F.floor(F.col("id") / 6).alias(SLICE))
    total = {"n": Running("sum", F.lit(1))}
    found = running(table, ["k"], "t", total, only_split=False, totals=True)
    assert {r.n_total for r in found.collect()} == {10}
    assert number_rows(table, [F.col("t")], "p").filter("p <> t + 1").count() == 0
