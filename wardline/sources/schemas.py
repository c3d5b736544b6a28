"""Explicit schemas of the input tables; nothing is inferred from text files."""

from __future__ import annotations

from pyspark.sql import types as T

from wardline.functions.codes import LAB_RULES, VITAL_RULES, labels_of

_BIGINT, _DOUBLE, _INT, _STRING, _TIME = T.LongType(), T.DoubleType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


STAYS = _schema(subject_id=_BIGINT, hadm_id=_BIGINT, stay_id=_BIGINT)
LAB_EVENTS = _schema(subject_id=_BIGINT, hadm_id=_BIGINT, itemid=_INT, charttime=_TIME, valuenum=_DOUBLE)
CHART_EVENTS = _schema(
    subject_id=_BIGINT, hadm_id=_BIGINT, stay_id=_BIGINT, itemid=_INT, charttime=_TIME, valuenum=_DOUBLE, warning=_INT
)
INPUT_EVENTS = _schema(
    stay_id=_BIGINT,
    itemid=_INT,
    starttime=_TIME,
    endtime=_TIME,
    rate=_DOUBLE,
    amount=_DOUBLE,
    linkorderid=_BIGINT,
    statusdescription=_STRING,
)
INTERVALS = _schema(stay_id=_BIGINT, starttime=_TIME, endtime=_TIME)
STAGES = _schema(
    stay_id=_BIGINT,
    charttime=_TIME,
    creat=_DOUBLE,
    uo_rt_6hr=_DOUBLE,
    uo_rt_12hr=_DOUBLE,
    uo_rt_24hr=_DOUBLE,
    aki_stage_creat=_INT,
    aki_stage_uo=_INT,
    aki_stage=_INT,
)
_KEYS = {"subject_id": _BIGINT, "hadm_id": _BIGINT, "stay_id": _BIGINT, "charttime": _TIME}
LABS = _schema(**_KEYS, **{f"{n}_{a}": _DOUBLE for n in labels_of(LAB_RULES) for a in ("min", "max")})
VITALS = _schema(**_KEYS, **{f"{n}_{a}": _DOUBLE for n in labels_of(VITAL_RULES) for a in ("min", "max", "mean")})
FLAGS = _schema(stay_id=_BIGINT, charttime=_TIME, vent=_INT, vasopressor=_INT, sedative=_INT)
DETAIL = _schema(
    stay_id=_BIGINT,
    subject_id=_BIGINT,
    hadm_id=_BIGINT,
    age=_DOUBLE,
    gender=_STRING,
    ethnicity_grouped=_STRING,
    admission_type=_STRING,
)
PREDICTIONS = _schema(stay_id=_BIGINT, step=_INT, model=_STRING, label=_INT, prob=_DOUBLE)
METRICS = T.StructType(
    [
        T.StructField("run", _INT),
        T.StructField("params", T.MapType(_STRING, _STRING)),
        T.StructField("metric", _STRING),
        T.StructField("value", _DOUBLE),
    ]
)
