import random

import pytest

from tests.helpers import at, frame, hour, rows
from wardline.operators import intervals
from wardline.plans.extract import sedative_durations

RATES = "stay_id long, itemid int, starttime timestamp_ntz, rate double"
SPANS = "stay_id long, starttime timestamp_ntz, endtime timestamp_ntz"


def rate_log(spark, values, stay=1, item=7):
    return frame(spark, RATES, [(stay, item, at(i + 1), v) for i, v in enumerate(values)])


@pytest.mark.parametrize("max_rows", [None, 2])
@pytest.mark.parametrize(
    "values, expected",
    [
        ([5.0, None, 0.0, 0.0, 7.0, None], [(1, 3), (5, 6)]),
        ([0.0, 0.0, None], []),
        ([5.0], []),
        ([0.0, 5.0, 6.0], [(2, 3)]),
        ([None, 5.0, 5.0, 0.0], [(2, 4)]),
        ([5.0, 0.0, 5.0, 0.0, None, 3.0, 3.0], [(1, 2), (3, 4), (6, 7)]),
        ([-1.0, 4.0, 0.0, 4.0, 4.0], [(4, 5)]),
        ([None, None], []),
        ([2.0, None, None, None], [(1, 4)]),
        ([2.0, 0.0, None, None], [(1, 2)]),
    ],
)
def test_episodes(spark, values, expected, max_rows):
    found = intervals.episodes(rate_log(spark, values), ["stay_id", "itemid"], max_rows=max_rows)
    assert [(hour(s), hour(e)) for _, _, s, e in rows(found)] == expected


def brute_episodes(records):
    """Straight reading of the rules over one time-ordered list of (time, rate)."""
    found, start, peak, previous = [], None, None, None
    for i, (t, rate) in enumerate(records):
        begins = rate is not None and (rate > 0 if previous is None else previous == 0 and rate != 0)
        if begins:
            if start is not None:
                found.append((start, stop, peak))
            start, stop, peak = t, None, None
        if start is not None:
            if rate is not None:
                peak = rate if peak is None else max(peak, rate)
            if stop is None and rate == 0:
                stop = t
        if rate is not None:
            previous = rate
    if start is not None:
        found.append((start, stop if stop is not None else records[-1][0], peak))
    return [(s, e if e is not None else records[-1][0]) for s, e, p in found if s != e and p is not None and p > 0]


def test_episodes_random_and_sliced(spark):
    draw = random.Random(3)
    records, expected = [], []
    for stay in range(60):
        times = sorted(draw.sample(range(500), draw.randint(1, 60)))
        log = [(t, draw.choice([None, None, 0.0, 0.0, 1.0, 2.0, 3.0])) for t in times]
        records += [(stay, 1, at(t), r) for t, r in log]
        expected += [(stay, float(s), float(e)) for s, e in brute_episodes(log)]
    log = frame(spark, RATES, records)
    for max_rows in (None, 4, 17):
        found = intervals.episodes(log, ["stay_id", "itemid"], max_rows=max_rows)
        assert sorted((r[0], hour(r[2]), hour(r[3])) for r in found.collect()) == sorted(expected)


def test_merge_touching_contained_and_empty(spark):
    spans = [(0, 5), (3, 8), (8, 9), (10, 12), (10, 11), (20, 20)]
    df = frame(spark, SPANS, [(1, at(s), at(e)) for s, e in spans])
    for max_rows in (None, 2):
        merged = intervals.merge_intervals(df, ["stay_id"], max_rows=max_rows)
        assert [(hour(s), hour(e)) for _, s, e in rows(merged)] == [(0, 9), (10, 12), (20, 20)]


def brute_merge(spans):
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def random_spans(seed, stays=40, size=30):
    draw = random.Random(seed)
    return {
        stay: [(s, s + draw.choice([0, 1, 2, 5, 20])) for s in (draw.randrange(200) for _ in range(draw.randint(1, size)))]
        for stay in range(stays)
    }


@pytest.mark.parametrize("max_rows", [None, 3, 10])
def test_merge_random(spark, max_rows):
    spans = random_spans(1)
    df = frame(spark, SPANS, [(k, at(s), at(e)) for k, v in spans.items() for s, e in v])
    expected = sorted((k, float(s), float(e)) for k, v in spans.items() for s, e in brute_merge(v))
    merged = intervals.merge_intervals(df, ["stay_id"], max_rows=max_rows)
    assert sorted((r[0], hour(r[1]), hour(r[2])) for r in merged.collect()) == expected


@pytest.mark.parametrize("max_rows", [None, 4])
def test_durations_number_each_source(spark, max_rows):
    spans = random_spans(2, stays=10)
    df = frame(spark, SPANS, [(k, at(s), at(e)) for k, v in spans.items() for s, e in v])
    other = frame(spark, SPANS, [(0, at(1000), at(1003)), (0, at(1001), at(1002))])
    found = intervals.durations([df, other], "stay_id", max_rows=max_rows).collect()
    expected = {(k, i + 1, s, e) for k, v in spans.items() for i, (s, e) in enumerate(brute_merge(v))} | {(0, 1, 1000, 1003)}
    assert {(r[0], r[1], hour(r[2]), hour(r[3])) for r in found} == expected
    assert all(r["duration_hours"] == pytest.approx(hour(r["endtime"]) - hour(r["starttime"])) for r in found)


def test_equal_rows_of_two_sources_unite(spark):
    df = frame(spark, SPANS, [(1, at(0), at(2))])
    assert intervals.durations([df, df], "stay_id").count() == 1


@pytest.mark.parametrize("max_rows", [None, 3, 11])
def test_flags_random(spark, max_rows):
    spans, other, draw = random_spans(5), random_spans(6), random.Random(9)
    points = {(k, draw.randrange(-5, 260)) for k in range(45) for _ in range(30)}
    times = frame(spark, "stay_id long, charttime timestamp_ntz", [(k, at(t)) for k, t in points])
    make = lambda d: frame(spark, SPANS, [(k, at(s), at(e)) for k, v in d.items() for s, e in v])
    found = intervals.flags_at([times, times], {"a": make(spans), "b": make(other)}, max_rows=max_rows)
    inside = lambda d, k, t: int(any(s <= t <= e for s, e in d.get(k, [])))
    expected = sorted((k, float(t), inside(spans, k, t), inside(other, k, t)) for k, t in points)
    assert sorted((r[0], hour(r[1]), r[2], r[3]) for r in found.collect()) == expected


def test_flags_null_time_and_null_entity(spark):
    times = frame(spark, "stay_id long, charttime timestamp_ntz", [(1, None), (1, at(1)), (None, at(1))])
    spans = frame(spark, SPANS, [(1, at(0), at(2)), (None, at(0), at(2)), (1, at(0), None)])
    found = {(r[0], r[1]): r[2] for r in intervals.flag_at([times], spans, "inside").collect()}
    assert found == {(1, None): 0, (1, at(1)): 1, (None, at(1)): 0}


def test_flag_bounds_are_closed(spark):
    times = frame(spark, "stay_id long, charttime timestamp_ntz", [(1, at(t)) for t in (0, 2, 3, 5)])
    spans = frame(spark, SPANS, [(1, at(0), at(2)), (1, at(5), at(5))])
    assert [r[2] for r in rows(intervals.flag_at([times], spans, "inside"))] == [1, 1, 0, 1]


def test_sedative_durations_joins_two_systems(spark):
    schema = "stay_id long, itemid int, starttime timestamp_ntz, endtime timestamp_ntz, rate double, amount double, linkorderid long, statusdescription string"
    df = frame(
        spark,
        schema,
        [
            (1, 30124, at(1), None, 5.0, None, None, None),
            (1, 30124, at(3), None, 0.0, None, None, None),
            (1, 30150, at(2), None, 1.0, None, None, None),
            (1, 30150, at(6), None, None, None, None, None),
            (1, 42273, at(10), None, None, 5.0, None, None),
            (1, 42273, at(11), None, None, 0.0, None, None),
            (1, 221668, at(5), at(7), 1.0, None, 9, "Stopped"),
            (1, 221668, at(7), at(9), 1.0, None, 9, "FinishedRunning"),
            (1, 221668, at(20), at(21), 1.0, None, 10, "Rewritten"),
            (1, 221668, at(30), at(31), 1.0, None, 11, None),
            (1, 999, at(40), at(41), 1.0, None, 12, "Stopped"),
        ],
    )
    found = sorted((r[0], r[1], hour(r[2]), hour(r[3]), r[4]) for r in sedative_durations(df).collect())
    assert found == [(1, 1, 1, 6, 5.0), (1, 1, 5, 9, 4.0)]
