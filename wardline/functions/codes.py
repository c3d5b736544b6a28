"""Code dimensions: which label a code means and which values are plausible for it.

The lists are fixed values: codes, labels and limits are part of the result contract.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class CodeRule:
    code: int
    label: str
    low: float | None = None
    high: float | None = None
    low_inclusive: bool = False
    high_inclusive: bool = True
    fahrenheit: bool = False  # limits apply to the raw value, the result is in Celsius


def _rules(label: str, codes: list[int], low=None, high=None, low_inclusive=False, high_inclusive=True, fahrenheit=False):
    return [CodeRule(c, label, low, high, low_inclusive, high_inclusive, fahrenheit) for c in codes]


# Laboratory codes, upper plausibility limits.
LAB_RULES: list[CodeRule] = [
    *_rules("aniongap", [50868], high=10000),
    *_rules("albumin", [50862], high=10),
    *_rules("bands", [51144], low=0, high=100, low_inclusive=True),
    *_rules("bicarbonate", [50882], high=10000),
    *_rules("bilirubin", [50885], high=150),
    *_rules("creatinine", [50912], high=150),
    *_rules("chloride", [50806, 50902], high=10000),
    *_rules("glucose", [50809, 50931], high=10000),
    *_rules("hematocrit", [50810, 51221], high=100),
    *_rules("hemoglobin", [50811, 51222], high=50),
    *_rules("lactate", [50813], high=50),
    *_rules("platelet", [51265], high=10000),
    *_rules("potassium", [50822, 50971], high=30),
    *_rules("ptt", [51275], high=150),
    *_rules("inr", [51237], high=50),
    *_rules("pt", [51274], high=150),
    *_rules("sodium", [50824, 50983], high=200),
    *_rules("bun", [51006], high=300),
    *_rules("wbc", [51300, 51301], high=1000),
]

# Charted vital sign codes, exclusive limits unless stated.
VITAL_RULES: list[CodeRule] = [
    *_rules("heartrate", [211, 220045], 0, 300, high_inclusive=False),
    *_rules("sysbp", [51, 442, 455, 6701, 220179, 220050], 0, 400, high_inclusive=False),
    *_rules("diasbp", [8368, 8440, 8441, 8555, 220180, 220051], 0, 300, high_inclusive=False),
    *_rules("meanbp", [456, 52, 6702, 443, 220052, 220181, 225312], 0, 300, high_inclusive=False),
    *_rules("resprate", [615, 618, 220210, 224690], 0, 70, high_inclusive=False),
    *_rules("tempc", [223761, 678], 70, 120, high_inclusive=False, fahrenheit=True),
    *_rules("tempc", [223762, 676], 10, 50, high_inclusive=False),
    *_rules("spo2", [646, 220277], 0, 100),
    *_rules("glucose", [807, 811, 1529, 3745, 3744, 225664, 220621, 226537], 0),
]

# Sedative codes of the two infusion systems, and codes storing the rate as amount.
SEDATIVE_RATE_CODES = [30124, 30150, 30308, 30118, 30149, 30131]
SEDATIVE_ORDER_CODES = [221668, 221744, 225972, 225942, 222168]
SWAPPED_RATE_CODES = [42273, 42802]
REWRITTEN = "Rewritten"

# Category levels of the static attributes.
GENDERS = ["F", "M"]
ETHNICITIES = ["asian", "black", "hispanic", "native", "other", "unknown", "white"]
ADMISSION_TYPES = ["ELECTIVE", "EMERGENCY", "URGENT"]

# Feature columns in vector order with their display names.
FEATURES: list[tuple[str, str]] = [
    ("aniongap_avg", "Anion gap"),
    ("bicarbonate_avg", "Bicarbonate"),
    ("bun_avg", "Blood Urea Nitrogen"),
    ("chloride_avg", "Chloride"),
    ("creat", "Creatinine"),
    ("diasbp_mean", "Diastolic BP"),
    ("glucose_avg", "Glucose"),
    ("heartrate_mean", "Heart rate"),
    ("hematocrit_avg", "Hematocrit"),
    ("hemoglobin_avg", "Hemoglobin"),
    ("potassium_avg", "Potassium"),
    ("resprate_mean", "Respiratory rate"),
    ("sodium_avg", "Sodium"),
    ("spo2_mean", "Oxygen saturation"),
    ("sysbp_mean", "Systolic BP"),
    ("uo_rt_12hr", "Urine output 12h"),
    ("uo_rt_24hr", "Urine output 24h"),
    ("uo_rt_6hr", "Urine output 6h"),
    ("wbc_avg", "White cell count"),
    ("sedative", "Sedative"),
    ("vasopressor", "Vasopressor"),
    ("vent", "Ventilation"),
    ("age", "Age"),
    ("F", "Female gender"),
    ("M", "Male gender"),
    ("asian", "Asian ethnicity"),
    ("black", "Black ethnicity"),
    ("hispanic", "Hispanic ethnicity"),
    ("native", "Native american"),
    ("other", "Other ethnicity"),
    ("unknown", "Ethnicity unknown"),
    ("white", "White ethnicity"),
    ("ELECTIVE", "Elective admission"),
    ("EMERGENCY", "Emergency admission"),
    ("URGENT", "Urgent admission"),
]
FLAGS = ["vent", "vasopressor", "sedative"]
MINIMAL_FEATURES = ["creat", "uo_rt_12hr", "uo_rt_24hr", "uo_rt_6hr"]


def _literal(value) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"{float(value)}D"


def rules_frame(spark: SparkSession, rules: list[CodeRule]) -> DataFrame:
    """The dimension as a local relation (one row per code)."""
    numbers = {label: i for i, label in enumerate(labels_of(rules))}
    rows = ", ".join(
        f"({r.code}, {_literal(r.label)}, {numbers[r.label]}, {_literal(r.low)}, {_literal(r.high)}, "
        f"{_literal(r.low_inclusive)}, {_literal(r.high_inclusive)}, {_literal(r.fahrenheit)})"
        for r in rules
    )
    names = "code, rule_label, label_number, low, high, low_inclusive, high_inclusive, fahrenheit"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules({names})")


def labels_of(rules: list[CodeRule]) -> list[str]:
    return list(dict.fromkeys(r.label for r in rules))
