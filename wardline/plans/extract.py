"""From event logs to the five study tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardline.functions.codes import (
    LAB_RULES,
    REWRITTEN,
    SEDATIVE_ORDER_CODES,
    SEDATIVE_RATE_CODES,
    SWAPPED_RATE_CODES,
    VITAL_RULES,
)
from wardline.functions.columns import is_distinct_from, swap_if
from wardline.operators.cohort import eligible_entities, keep_entities
from wardline.operators.intervals import durations, episodes, flags_at, order_intervals
from wardline.operators.pivot import left_join_groups, pivot_events
from wardline.operators.scans import MAX_GROUP_ROWS, attach
from wardline.sources.tables import cut_lineage

STAY_KEYS = ["subject_id", "hadm_id", "stay_id"]
ADMISSION_KEYS = ["subject_id", "hadm_id"]
MEASURES = ["creat", "uo_rt_6hr", "uo_rt_12hr", "uo_rt_24hr"]


def lab_table(stays: DataFrame, lab_events: DataFrame) -> DataFrame:
    """Laboratory values per stay and time, min and max per label.

    Events belong to admissions: they are pivoted per admission first and only then repeated for
    its stays. A stay without events keeps one row without a time. The pivot is stored, as both the
    stays with and those without events are taken from it.
    """
    positive = lab_events.filter(F.col("valuenum") > 0)
    pivoted = cut_lineage(pivot_events(positive, LAB_RULES, [*ADMISSION_KEYS, "charttime"], ["min", "max"]))
    joined = left_join_groups(stays.select(*STAY_KEYS), pivoted, ADMISSION_KEYS)
    values = [c for c in pivoted.columns if c not in (*ADMISSION_KEYS, "charttime")]
    return joined.select(*STAY_KEYS, "charttime", *values)


def vital_table(stays: DataFrame, chart_events: DataFrame) -> DataFrame:
    """Vital signs per stay and time: min, max and mean; rows marked as errors do not count."""
    valid = chart_events.filter(is_distinct_from("warning", 1))
    pivoted = pivot_events(valid, VITAL_RULES, [*STAY_KEYS, "charttime"], ["min", "max", "mean"])
    return attach(pivoted, stays.select(*STAY_KEYS).distinct(), STAY_KEYS, "left_semi")


def sedative_durations(input_events: DataFrame, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Sedation intervals of two infusion systems: rate records and linked orders.

    Both reduce the log to few intervals, which are stored before they are merged.
    """
    key = "stay_id"
    swapped = F.col("itemid").isin(SWAPPED_RATE_CODES)
    rate, amount = swap_if(swapped, "rate", "amount")
    records = input_events.filter(F.col("itemid").isin(SEDATIVE_RATE_CODES)).withColumns({"rate": rate, "amount": amount})
    delivered = episodes(records, [key, "itemid"], max_rows=max_rows).select(key, "starttime", "endtime")
    orders = input_events.filter(
        F.col("itemid").isin(SEDATIVE_ORDER_CODES) & (F.col("statusdescription") != REWRITTEN)
    )
    ordered = order_intervals(orders, [key, "linkorderid"]).select(key, "starttime", "endtime")
    return durations([cut_lineage(delivered), cut_lineage(ordered)], key, "sedativenum", max_rows=max_rows)


def flag_table(
    stages: DataFrame,
    labs: DataFrame,
    vitals: DataFrame,
    ventilation: DataFrame,
    vasopressor: DataFrame,
    sedation: DataFrame,
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Ventilation, vasopressor and sedation at every observed moment."""
    intervals = {"vent": ventilation, "vasopressor": vasopressor, "sedative": sedation}
    return flags_at([stages, labs, vitals], intervals, max_rows=max_rows)


def study_tables(
    stays: DataFrame,
    detail: DataFrame,
    stages: DataFrame,
    lab_events: DataFrame,
    chart_events: DataFrame,
    input_events: DataFrame,
    ventilation: DataFrame,
    vasopressor: DataFrame,
    label: str = "aki_stage",
) -> dict[str, DataFrame]:
    """All tables of the study, restricted to stays with a measurement and a label.

    The stays are chosen first, and every log is reduced to them before it is pivoted or scanned.
    Each log is read once: laboratory values, vital signs and flags are stored.
    """
    key = "stay_id"
    chosen = cut_lineage(eligible_entities(stages, MEASURES, label, key))
    stays, stages, detail = (keep_entities(df, chosen, key) for df in (stays, stages, detail))
    admissions = stays.select(*ADMISSION_KEYS).distinct()
    labs = cut_lineage(lab_table(stays, attach(lab_events, admissions, ADMISSION_KEYS, "left_semi")))
    charted, infused, ventilated, pressed = (
        keep_entities(df, chosen, key) for df in (chart_events, input_events, ventilation, vasopressor)
    )
    vitals = cut_lineage(vital_table(stays, charted))
    flags = cut_lineage(flag_table(stages, labs, vitals, ventilated, pressed, sedative_durations(infused)))
    return {"stages": stages, "detail": detail, "vitals": vitals, "labs": labs, "flags": flags}
