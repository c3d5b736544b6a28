"""From the study tables to labelled feature rows, ready for a sequence or a flat model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from wardline.config import Settings
from wardline.functions.codes import ADMISSION_TYPES, ETHNICITIES, FEATURES, FLAGS, GENDERS, MINIMAL_FEATURES
from wardline.operators.align import align, merge_measure
from wardline.operators.cohort import adults, assign_split, drop_all_null, drop_any_null, keep_entities, span_filter
from wardline.operators.features import apply_scaler, fill_constant, fit_scaler, impute_column_mode, impute_entity_mode, midpoints, static_features
from wardline.operators.grid import forward_fill, resample
from wardline.operators.labels import first_onset, shift_label
from wardline.sources.tables import cut_lineage

# The laboratory values and vital signs in use.
LABS_USED = ["aniongap", "bicarbonate", "creatinine", "chloride", "glucose", "hematocrit", "hemoglobin", "potassium", "sodium", "bun", "wbc"]
VITALS_USED = ["heartrate", "sysbp", "diasbp", "resprate", "spo2", "glucose"]
URINE = ["uo_rt_6hr", "uo_rt_12hr", "uo_rt_24hr"]
_STAY = ["subject_id", "hadm_id", "stay_id", "charttime"]
CATEGORIES = {"gender": GENDERS, "ethnicity_grouped": ETHNICITIES, "admission_type": ADMISSION_TYPES}


@dataclass(frozen=True)
class Prepared:
    """Labelled rows with a ``split`` column, the feature columns and the scaled ones among them."""

    rows: DataFrame
    features: list[str]
    scaled: list[str]


def clean_stages(stages: DataFrame, settings: Settings) -> DataFrame:
    kept = stages.select("stay_id", "charttime", "creat", *URINE, F.col("aki_stage").alias(settings.label))
    return drop_all_null(kept, ["creat", *URINE, settings.label])


def clean_labs(labs: DataFrame) -> DataFrame:
    used = [f"{n}_{a}" for n in LABS_USED for a in ("min", "max")]
    observed = drop_all_null(drop_any_null(labs.select(*_STAY, *used), ["charttime"]), used)
    return midpoints(observed, LABS_USED)


def clean_vitals(vitals: DataFrame) -> DataFrame:
    used = [f"{n}_mean" for n in VITALS_USED]
    return drop_all_null(vitals.select(*_STAY, *used), used)


def merge_sources(stages: DataFrame, labs: DataFrame, vitals: DataFrame, flags: DataFrame) -> DataFrame:
    """One wide table per (stay, time); creatinine and glucose come from two sources each."""
    key = ["stay_id", "charttime"]
    measured = merge_measure(stages, "creat", labs, "creatinine_avg", key, "creat")
    labs = labs.drop("creatinine_avg")
    labs = drop_all_null(labs, [c for c in labs.columns if c not in _STAY])
    labs = merge_measure(labs, "glucose_avg", vitals, "glucose_mean", _STAY, "glucose_avg")
    vitals = vitals.drop("glucose_mean")
    vitals = drop_all_null(vitals, [c for c in vitals.columns if c not in _STAY])
    return align([measured, labs, vitals, flags], [key, _STAY, key]).drop("subject_id")


def grid_rows(merged: DataFrame, settings: Settings) -> DataFrame:
    """Resample to the grid and carry the label forward; other gaps stay null."""
    s = settings
    discrete = [c for c in (*FLAGS, "hadm_id") if c in merged.columns]
    numeric = [c for c in merged.columns if c not in (s.entity, s.time, s.label, *discrete)]
    if s.most_common:
        aggregates = {c: "mode" for c in (*numeric, *discrete, s.label)}
        merged = merged.withColumns({c: F.col(c).cast("double") for c in aggregates})
    else:
        aggregates = {c: "mean" for c in numeric} | {c: "max" for c in (*discrete, s.label)}
    grid = resample(merged, s.entity, s.time, s.step_hours, aggregates)
    grid = forward_fill(grid, s.entity, s.time, [s.label], s.fill_limit, s.step_hours)
    return fill_constant(grid, 0, [*discrete, s.label])


def label_rows(grid: DataFrame, settings: Settings) -> DataFrame:
    s = settings
    labelled = shift_label(grid, s.entity, s.time, s.label, s.horizon_hours, s.step_hours, s.stage_threshold)
    if s.target == "first_onset":
        return first_onset(labelled, s.entity, s.time, s.label)
    if s.target != "continuous":
        raise ValueError(f"unknown target: {s.target}")
    return labelled


def impute(grid: DataFrame, settings: Settings, columns: list[str]) -> DataFrame:
    if settings.impute == "entity":
        grid = impute_entity_mode(grid, settings.entity, columns)
    elif settings.impute == "column":
        grid = impute_column_mode(grid, columns)
    elif settings.impute is not None:
        raise ValueError(f"unknown imputation: {settings.impute}")
    return fill_constant(grid, settings.fill_value, columns)


def select_features(df: DataFrame, full: list[str], minimal: list[str]) -> list[str]:
    """The full feature list if the table has it, otherwise the minimal one."""
    return full if set(full) <= set(df.columns) else minimal


def prepare(tables: dict[str, DataFrame], settings: Settings = Settings(), store=cut_lineage) -> Prepared:
    """The whole preparation.

    ``tables`` holds stages, labs and detail and, for the full feature set, vitals and flags; they
    are read several times and should be stored tables. Entities that are too young leave every
    source before the sources are joined. ``store`` materialises the intermediate results that more
    than one later step reads: the aligned rows (spans, trimming), the labelled rows with their split
    (scaler), and the bounds of the scaler.
    """
    s = settings
    detail = adults(tables["detail"], s.min_age)
    kept = {n: keep_entities(df, detail, s.entity) for n, df in tables.items() if n != "detail"}
    stages = clean_stages(kept["stages"], s)
    if "vitals" in tables:
        merged = merge_sources(stages, clean_labs(kept["labs"]), clean_vitals(kept["vitals"]), kept["flags"])
    else:
        merged = merge_measure(stages, "creat", clean_labs(kept["labs"]), "creatinine_avg", ["stay_id", "charttime"], "creat")
    merged = store(merged)
    merged = span_filter(merged, s.entity, s.time, s.horizon_hours / 24, s.max_days)
    grid = grid_rows(merged, s)
    dynamic = [c for c in grid.columns if c not in (s.entity, s.time, s.label, "hadm_id")]
    rows = label_rows(impute(grid, s, dynamic), s)
    full = [name for name, _ in FEATURES]
    if "vitals" in tables:
        rows = static_features(rows, detail, s.entity, ["age"], CATEGORIES)
    features = select_features(rows, full, MINIMAL_FEATURES)
    scaled = [c for c in features if c not in FLAGS and c not in _levels()]
    rows = assign_split(rows.select(s.entity, s.time, s.label, *features), s.entity, s.holdout, s.test_share, s.seed)
    rows = store(rows)
    fitting = rows if s.fit_on == "all" else rows.filter(F.col("split") == "train")
    capped = features if s.fit_on == "all" else scaled
    bounds = store(fit_scaler(fitting, capped, scaled, s.cap_lower, s.cap_upper))
    return Prepared(apply_scaler(rows, bounds, capped, scaled), features, scaled)


def _levels() -> list[str]:
    return [level for levels in CATEGORIES.values() for level in levels]
