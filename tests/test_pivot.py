from tests.helpers import at, frame, rows
from wardline.functions.codes import LAB_RULES, VITAL_RULES, labels_of
from wardline.operators import pivot
from wardline.plans.extract import lab_table, study_tables, vital_table

CHART = "subject_id long, hadm_id long, stay_id long, itemid int, charttime timestamp_ntz, valuenum double, warning int"
STAYS = "subject_id long, hadm_id long, stay_id long"


def vitals(spark, readings):
    stays = frame(spark, STAYS, [(1, 1, 1)])
    return vital_table(stays, frame(spark, CHART, [(1, 1, 1, c, at(i), v, w) for i, (c, v, w) in enumerate(readings)]))


def test_rule_lists():
    assert len(LAB_RULES) == 26 and len(labels_of(LAB_RULES)) == 19
    assert len(VITAL_RULES) == 39 and len(labels_of(VITAL_RULES)) == 8


def test_temperature_limits_apply_before_conversion(spark):
    found = vitals(spark, [(223761, v, None) for v in (98.6, 70.0, 120.0, 121.0)]).orderBy("charttime").collect()
    assert [None if r["tempc_mean"] is None else round(r["tempc_mean"], 6) for r in found] == [37.0, None, None, None]


def test_saturation_upper_limit_is_inclusive(spark):
    found = vitals(spark, [(646, 100.0, None), (646, 100.1, None), (211, 300.0, None)]).orderBy("charttime").collect()
    assert [r["spo2_max"] for r in found] == [100.0, None, None]
    assert len(found) == 3  # groups of implausible values stay


def test_warning_null_and_zero_pass(spark):
    found = vitals(spark, [(211, 80.0, None), (211, 81.0, 0), (211, 82.0, 1)])
    assert sorted(r["heartrate_mean"] for r in found.collect()) == [80.0, 81.0]


def test_unknown_codes_and_foreign_stays_drop(spark):
    stays = frame(spark, STAYS, [(1, 1, 1)])
    events = frame(spark, CHART, [(1, 1, 1, 999999, at(0), 5.0, None), (1, 1, 2, 211, at(0), 80.0, None)])
    assert vital_table(stays, events).count() == 0


def test_labs_repeat_per_stay_and_keep_empty_stays(spark):
    stays = frame(spark, STAYS, [(1, 10, 100), (1, 10, 101), (2, 20, 200)])
    events = frame(
        spark,
        "subject_id long, hadm_id long, itemid int, charttime timestamp_ntz, valuenum double",
        [
            (1, 10, 50806, at(0), 100.0),
            (1, 10, 50902, at(0), 104.0),
            (1, 10, 50862, at(0), 11.0),
            (1, 10, 51221, at(1), 0.0),
            (1, 10, 51221, at(2), None),
        ],
    )
    table = lab_table(stays, events)
    assert rows(table, "stay_id", "charttime", "chloride_min", "chloride_max", "albumin_max") == [
        (100, at(0), 100.0, 104.0, None),
        (101, at(0), 100.0, 104.0, None),
        (200, None, None, None, None),
    ]
    assert table.columns[:4] == ["subject_id", "hadm_id", "stay_id", "charttime"] and len(table.columns) == 42


def test_codes_reach_the_scan(spark, small, capsys):
    events = spark.read.parquet(f"{small}/events.parquet").selectExpr("user_id", "cast(event_id as int) as itemid", "value as valuenum", "ts")
    pivot.pivot_events(events, VITAL_RULES, ["user_id"], ["max"]).explain("formatted")
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "props" not in plan


def test_study_tables_share_one_cohort(spark):
    stays = frame(spark, STAYS, [(1, 1, 1), (2, 2, 2)])
    detail = frame(spark, "stay_id long, age double", [(1, 50.0), (2, 60.0)])
    stages = frame(
        spark,
        "stay_id long, charttime timestamp_ntz, creat double, uo_rt_6hr double, uo_rt_12hr double, uo_rt_24hr double, aki_stage int",
        [(1, at(0), 1.0, None, None, None, 0), (2, at(0), None, None, None, None, 1), (2, at(1), 1.0, None, None, None, None)],
    )
    labs = frame(spark, "subject_id long, hadm_id long, itemid int, charttime timestamp_ntz, valuenum double", [(1, 1, 50912, at(3), 1.0), (2, 2, 50912, at(3), 1.0)])
    chart = frame(spark, CHART, [(1, 1, 1, 211, at(4), 80.0, None), (2, 2, 2, 211, at(4), 80.0, None)])
    infusions = frame(
        spark,
        "stay_id long, itemid int, starttime timestamp_ntz, endtime timestamp_ntz, rate double, amount double, linkorderid long, statusdescription string",
        [(1, 221668, at(3), at(4), 1.0, None, 1, "Stopped")],
    )
    spans = frame(spark, "stay_id long, starttime timestamp_ntz, endtime timestamp_ntz", [(1, at(0), at(3))])
    tables = study_tables(stays, detail, stages, labs, chart, infusions, spans, spans.limit(0))
    assert {n: {r["stay_id"] for r in t.collect()} for n, t in tables.items()} == {n: {1} for n in tables}
    assert rows(tables["flags"], "charttime", "vent", "vasopressor", "sedative") == [(at(0), 1, 0, 0), (at(3), 1, 0, 1), (at(4), 0, 0, 1)]
