import math
import random

import pytest

from tests.helpers import at, frame, hour, rows
from wardline.operators import align, cohort, features, grid, labels, sequences

LOG = "stay_id long, charttime timestamp_ntz, v double"


def log(spark, items, stay=1):
    return frame(spark, LOG, [(stay, at(h), v) for h, v in items])


def test_gaps_are_filled_between_first_and_last(spark):
    found = grid.resample(log(spark, [(5.5, 1.0), (19, 3.0)]), "stay_id", "charttime", 6, {"v": "mean"})
    assert [(hour(t), v) for _, t, v in rows(found)] == [(0, 1.0), (6, None), (12, None), (18, 3.0)]


def test_resample_equals_pandas(spark):
    import pandas as pd

    draw = random.Random(4)
    items = [(s, at(draw.uniform(0, 300)), draw.choice([None, 1.0, 2.5, 7.0])) for s in range(8) for _ in range(15)]
    pdf = pd.DataFrame(items, columns=["stay_id", "charttime", "v"]).set_index("charttime")
    pdf["v"] = pdf["v"].astype(float)
    expected = pdf.groupby("stay_id").resample("6h")["v"].mean().reset_index()
    found = grid.resample(frame(spark, LOG, items), "stay_id", "charttime", 6, {"v": "mean"})
    want = sorted((int(s), t.to_pydatetime(), None if math.isnan(v) else round(v, 9)) for s, t, v in expected.itertuples(index=False))
    got = sorted((s, t, None if v is None else round(v, 9)) for s, t, v in rows(found))
    assert got == want


def test_fill_stops_after_the_limit(spark):
    items = [(0, 1.0)] + [(6 * i, None) for i in range(1, 21)]
    found = grid.forward_fill(log(spark, items), "stay_id", "charttime", ["v"], 16, 6)
    assert [v for *_, v in rows(found)] == [1.0] * 17 + [None] * 4


def test_fill_does_not_cross_entities(spark):
    df = log(spark, [(0, 1.0)], 1).union(log(spark, [(0, None), (6, None)], 2))
    found = grid.forward_fill(df, "stay_id", "charttime", ["v"], 16, 6)
    assert rows(found, "stay_id", "v") == [(1, 1.0), (2, None), (2, None)]


def test_lead_drops_the_tail(spark):
    df = log(spark, [(6 * i, float(i)) for i in range(9)])
    assert rows(grid.lead_label(df, "stay_id", "charttime", "v", 8), "charttime", "v") == [(at(0), 8.0)]


@pytest.mark.parametrize("values, expected", [([0, 0, 1, 0], [1, 1, 1]), ([0, 0, 0], [0, 0, 0]), ([1, 0], [1])])
def test_first_onset(spark, values, expected):
    df = log(spark, [(6 * i, float(v)) for i, v in enumerate(values)])
    assert [v for *_, v in rows(labels.first_onset(df, "stay_id", "charttime", "v"))] == expected
    cut = labels.onset_cutoffs(df, "stay_id", "charttime", "v")
    assert labels.cut_at(df, cut, "stay_id", "charttime").count() == len(expected)


def test_stage_thresholds(spark):
    df = frame(spark, "s int", [(i,) for i in (0, 1, 2, 3, None)])
    for threshold, expected in ((None, [0, 1, 2, 3, None]), (1, [0, 1, 1, 1, None]), (2, [0, 0, 1, 1, None]), (3, [0, 0, 0, 1, None])):
        assert [r[0] for r in labels.binarise(df, "s", threshold).collect()] == expected


def test_span_limits(spark):
    seconds = {1: 48 * 3600, 2: 48 * 3600 - 4, 3: 48 * 3600 - 5}
    df = frame(spark, LOG, [(k, at(h), 0.0) for k, s in seconds.items() for h in (0, s / 3600)])
    assert {r[0] for r in cohort.span_filter(df, "stay_id", "charttime", 2).collect()} == {1, 2}


def test_span_filter_trims_and_checks_again(spark):
    # stay 1 keeps its last 35 days; stay 2 has only its last moment in that period
    df = frame(spark, LOG, [(1, at(24 * d), 0.0) for d in (0, 10, 40)] + [(2, at(24 * d), 0.0) for d in (0, 40)])
    kept = cohort.span_filter(df, "stay_id", "charttime", 2, 35)
    assert rows(kept, "stay_id", "charttime") == [(1, at(240)), (1, at(960))]


def test_group_mode_ties_and_nulls(spark):
    df = frame(spark, "k int, a double, b double", [(1, 1.0, None), (1, 1.0, 3.0), (1, 2.0, 3.0), (1, 2.0, 1.0), (1, None, 1.0), (2, None, 5.0)])
    assert rows(grid.group_mode(df, ["k"], ["a", "b"])) == [(1, 1.0, 1.0), (2, None, 5.0)]
    filled = features.impute_entity_mode(df, "k", ["a", "b"])
    assert rows(filled, "k", "a", "b").count((1, 1.0, 1.0)) == 2 and (2, None, 5.0) in rows(filled, "k", "a", "b")
    assert (2, 1.0, 5.0) in rows(features.impute_column_mode(df, ["a", "b"]))


def test_midpoint_needs_both(spark):
    df = frame(spark, "x_min double, x_max double", [(1.0, 3.0), (1.0, None), (None, None)])
    assert [r[0] for r in features.midpoints(df, ["x"]).collect()] == [2.0, None, None]


def test_constant_column_scales_to_zero(spark):
    df = frame(spark, "x double, y double", [(5.0, 1.0), (5.0, 3.0), (None, 2.0)])
    scaled = features.scale(df, features.value_bounds(df, ["x", "y"]), ["x", "y"])
    assert rows(scaled) == [(0.0, 0.0), (0.0, 1.0), (None, 0.5)]


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_random(spark, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    data = {
        "wide": np.concatenate([rng.normal(0, 1e6, 400), [1e12, -1e12]]),
        "tight": 100 + rng.uniform(0, 1e-4, 402),
        "tied": rng.integers(-3, 3, 402).astype(float),
        "tiny": rng.exponential(1e-5, 402),
    }
    df = spark.createDataFrame(list(zip(*[map(float, v) for v in data.values()])), ", ".join(f"{n} double" for n in data))
    probabilities = [0.0, 0.01, 0.37, 0.5, 0.99, 1.0]
    found = {r["column"]: [r[f"q{i}"] for i in range(6)] for r in features.exact_quantiles(df, list(data), probabilities).collect()}
    for name, values in data.items():
        assert found[name] == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12, abs=1e-15)


def test_scaler_matches_numpy(spark):
    import numpy as np

    x = np.random.default_rng(0).normal(10, 3, 500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    found = sorted(r[0] for r in features.apply_scaler(df, features.fit_scaler(df, ["x"], ["x"]), ["x"], ["x"]).collect())
    capped = np.sort(np.clip(x, np.quantile(x, 0.01), np.quantile(x, 0.99)))
    assert found == pytest.approx(list((capped - capped[0]) / (capped[-1] - capped[0])))


def test_approximate_bounds_are_close(spark):
    df = spark.range(10000).selectExpr("cast(id as double) as x")
    low, high, smallest, largest = features.quantile_bounds(df, ["x"], 0.01, 0.99, approx=True).first()["x"]
    assert abs(low - 100) < 2 and abs(high - 9900) < 2 and (smallest, largest) == (0.0, 9999.0)


def test_split_is_exact_and_reproducible(spark):
    df = spark.range(0, 501).selectExpr("id % 101 as stay_id")
    first = cohort.split_entities(df, "stay_id")
    counts = {r["split"]: r["count"] for r in first.groupBy("split").count().collect()}
    assert counts == {"train": 80, "valid": 10, "test": 11}
    assert rows(first) == rows(cohort.split_entities(df.repartition(7), "stay_id"))
    assert rows(first) != rows(cohort.split_entities(df, "stay_id", seed=7))
    assert cohort.sample_entities(df, "stay_id", 0.05).select("stay_id").distinct().count() == 6


def test_align_join_and_union(spark):
    schema = "stay_id long, charttime timestamp_ntz, {} double"
    a = frame(spark, schema.format("a"), [(1, at(0), 1.0), (1, at(1), 2.0)])
    b = frame(spark, schema.format("b"), [(1, at(1), 3.0), (2, at(0), 4.0)])
    key = ["stay_id", "charttime"]
    expected = [(1, at(0), 1.0, None), (1, at(1), 2.0, 3.0), (2, at(0), None, 4.0)]
    assert rows(align.align([a, b], key), *key, "a", "b") == expected
    assert rows(align.align([a, b], key, mode="union"), *key, "a", "b") == expected
    # two values at one moment: the join repeats the other source, the union form does not
    twice = a.union(frame(spark, schema.format("a"), [(1, at(1), 9.0)]))
    assert rows(align.align([twice, b], key), *key, "a", "b")[1:3] == [(1, at(1), 2.0, 3.0), (1, at(1), 9.0, 3.0)]
    assert align.align([twice, b], key, mode="union").count() == 3


def test_merge_measure_keeps_both_values(spark):
    base = frame(spark, "k int, t int, creat double, other double", [(1, 0, 1.0, 7.0), (1, 1, None, 8.0)])
    lab = frame(spark, "k int, t int, creatinine double", [(1, 0, 1.0), (1, 0, 2.0), (1, 2, 3.0), (1, 3, None)])
    found = align.merge_measure(base, "creat", lab, "creatinine", ["k", "t"], "creat")
    assert rows(found, "k", "t", "other", "creat") == [(1, 0, 7.0, 1.0), (1, 0, 7.0, 2.0), (1, 1, 8.0, None), (1, 2, None, 3.0)]


def test_sequences_are_padded_and_never_cut(spark):
    df = frame(spark, "stay_id long, charttime timestamp_ntz, a double, b double", [(s, at(6 * i), float(i), None) for s, n in ((1, 2), (2, 3)) for i in range(n)])
    made = sequences.to_sequences(df, "stay_id", "charttime", ["a", "b"])
    assert sequences.longest(made) == 3
    flat = {r["stay_id"]: r["flat"] for r in sequences.flatten_padded(made, 3, 2, fill=-1.0).collect()}
    assert flat == {1: [0.0, 0.0, 1.0, 0.0, -1.0, -1.0], 2: [0.0, 0.0, 1.0, 0.0, 2.0, 0.0]}
    assert tuple(sequences.sequence_shape(made).first()) == (2, 3, 2)
    vector = {r["stay_id"]: r["features"] for r in sequences.to_vectors(df, "stay_id", "charttime", ["a", "b"]).collect()}
    assert list(vector[1].toArray()) == [0, 0, 1, 0, 0, 0] and type(vector[1]).__name__ == "SparseVector"
    with pytest.raises(Exception, match="more steps than 2"):
        sequences.flatten_padded(made, 2, 2).collect()


def test_hourly_grid_keeps_every_row(spark):
    rows_ = [(1, at(h), 1.0) for h in range(0, 200)] + [(2, at(0), 2.0)]
    df = grid.resample(frame(spark, "stay_id long, charttime timestamp_ntz, a double", rows_), "stay_id", "charttime", 1, {"a": "mean"})
    assert {r["stay_id"]: len(r["seq"]) for r in sequences.to_sequences(df, "stay_id", "charttime", ["a"]).collect()} == {1: 200, 2: 1}
    assert sequences.to_vectors(df, "stay_id", "charttime", ["a"]).first()["features"].size == 200


def test_length_batches(spark):
    lengths = {i: (i * 7) % 5 + 1 for i in range(12)}
    df = frame(spark, "stay_id long, charttime timestamp_ntz, a double", [(s, at(6 * i), 1.0) for s, n in lengths.items() for i in range(n)])
    made = sequences.length_batches(sequences.to_sequences(df, "stay_id", "charttime", ["a"]), "stay_id", 5, 1)
    order = sorted(lengths, key=lambda s: (-lengths[s], s))
    found = {r["stay_id"]: (r["batch"], len(r["seq"])) for r in made.collect()}
    expected = {s: (i // 5, lengths[order[i // 5 * 5]]) for i, s in enumerate(order)}
    assert found == expected
