"""All logistic regressions of a search, fitted in the same passes over the rows.

A fit is a Newton method on the objective of Spark's ``LogisticRegression``; where the penalty is L1, its quadratic is solved
by coordinate descent and active sets. A pass is one job for all fits that have not ended: tasks add up loss, slopes and curvature of their rows, a
group per fit sums these up and takes the step, and the driver gets the new coefficients. So a search takes as many
jobs as its slowest fit has steps, about twenty, not one per step of every fit.
"""

from __future__ import annotations

import json
import math
import time
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, MatrixUDT, Vectors, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from wardline.sources.tables import cut_lineage, shared_folder

# Numbers of the curvature that a task holds at once, over all fits of a job; wider vectors are not fitted here.
PASS_CELLS = 8_000_000
# Numbers that the group of one fit gets from all tasks, and tasks of a pass.
GROUP_CELLS = 64_000_000
MAX_TASKS = 96
# Rows for which a task is worth while: a row costs every fit the square of its width.
TASK_ROWS = 1000
# Changes of the set of coefficients that are not zero, within one step.
_ROUNDS = 100
# A fit ends with a step that promises less than this share of the tolerance.
_END = 1e-3
_STATE = "fit int, base array<double>, trial array<double>, step array<double>, value double, part_of_step double, done boolean"


def is_plain(estimator) -> bool:
    """Whether these passes fit what the estimator would: two classes, unscaled penalties, no bounds or thresholds."""
    return (
        isinstance(estimator, LogisticRegression)
        and estimator.getFamily() in ("auto", "binomial")
        and not estimator.getStandardization()
        and estimator.getThreshold() == 0.5
        and not any(p.name.startswith(("lowerBounds", "upperBounds")) and estimator.isSet(p) for p in estimator.params)
    )


def store_parts(parts: list[DataFrame], estimator, weight: str | None) -> DataFrame:
    """Rows (part, y, weight, x) of all parts, stored once."""
    label, vector = estimator.getLabelCol(), estimator.getFeaturesCol()
    rows = [
        df.select(F.lit(i).alias("part"), F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"), _array(df, vector).alias("x"))
        for i, df in enumerate(parts)
    ]
    whole = reduce(lambda a, b: a.unionByName(b), rows)
    return cut_lineage(whole.repartition(max(1, min(MAX_TASKS, math.ceil(whole.count() / TASK_ROWS)))))


def _array(df: DataFrame, vector: str) -> Column:
    return vector_to_array(vector) if dict(df.dtypes)[vector] == "vector" else F.col(vector)


def fit_parts(stored: DataFrame, estimator, choices: dict[int, list[dict]], total: dict[int, float]) -> dict[tuple[int, int], list[float]]:
    """Coefficients, the intercept last, per (part, run); parts that only Spark's own fit can judge are left out.

    ``choices`` has the parameter maps of every part, ``total`` its sum of weights. Left out are parts with one
    class or others than 0 and 1, without rows, with unusable weights or values, and vectors too wide for ``PASS_CELLS``.
    """
    x = F.col("x")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    bad = F.col("weight").isNull() | F.isnan("weight") | (F.col("weight") < 0) | x.isNull() | odd | F.coalesce(~F.col("y").isin(0.0, 1.0), F.lit(True))
    facts = stored.groupBy("part").agg(
        F.count_if(bad).alias("bad"), F.count_if(F.expr("y = 0 AND weight > 0")).alias("n0"), F.count_if(F.expr("y = 1 AND weight > 0")).alias("n1"),
        F.min(F.size("x")).alias("narrow"), F.max(F.size("x")).alias("wide"),
    ).collect()
    usable = [r["part"] for r in facts if not r["bad"] and r["n0"] and r["n1"] and r["narrow"] == r["wide"] > 0 and (r["wide"] + 1) ** 2 <= PASS_CELLS]
    width = {r["part"]: r["wide"] for r in facts}
    if not usable or len({width[p] for p in usable}) > 1:
        return {}
    size = width[usable[0]] + 1
    told = stored.filter(F.col("part").isin(usable))
    # as in Spark, a column without variance has no coefficient
    spread = told.select("part", array_to_vector("x").alias("v")).groupBy("part").agg(Summarizer.min(F.col("v")).alias("low"), Summarizer.max(F.col("v")).alias("high"))
    varies = {r["part"]: (r["low"].toArray() < r["high"].toArray()).tolist() for r in spread.collect()}
    fits = []
    for p in usable:
        for run, params in enumerate(choices[p]):
            get = lambda param: params.get(param, estimator.getOrDefault(param))  # noqa: B023, E731
            one = {
                "part": p, "run": run, "total": total[p], "l": get(estimator.regParam), "alpha": get(estimator.elasticNetParam),
                "free": [*varies[p], get(estimator.fitIntercept)], "tol": get(estimator.tol) * _END, "max": get(estimator.maxIter),
            }
            fits.append(one)
    state = [{"base": [0.0] * size, "trial": [0.0] * size, "step": [0.0] * size, "value": None, "part_of_step": 1.0, "done": False} for _ in fits]
    tasks = max(8, min(MAX_TASKS, GROUP_CELLS // size**2))
    at_once = max(1, PASS_CELLS // size**2)
    passes = 0
    while True:
        open_ = [i for i, s in enumerate(state) if not s["done"] and passes <= fits[i]["max"]]
        if not open_:
            break
        for begin in range(0, len(open_), at_once):
            now = {i: (fits[i], state[i]) for i in open_[begin : begin + at_once]}
            rows = told.filter(F.col("part").isin(sorted({f["part"] for f, _ in now.values()}))).coalesce(tasks)
            sums = rows.mapInArrow(_adder(now, size), "fit int, loss double, sums binary")
            moved = sums.repartition(min(len(now), MAX_TASKS), "fit").groupBy("fit").applyInPandas(_stepper(now, size), _STATE)
            for r in moved.collect():  # a row per fit
                state[r["fit"]] = r.asDict()
        passes += 1
    return {(f["part"], f["run"]): list(s["base"]) for f, s in zip(fits, state, strict=True)}


def fit_model(train: DataFrame, estimator, weight: str | None) -> LogisticRegressionModel | None:
    """The model of one regression fitted by these passes; None if only Spark's own fit can judge the rows."""
    if not is_plain(estimator):
        return None
    stored = store_parts([train], estimator, weight)
    total = {r["part"]: r["w"] for r in stored.groupBy("part").agg(F.sum("weight").alias("w")).collect()}
    fitted = fit_parts(stored, estimator, {0: [{}]}, total) if total.get(0) else {}
    if not fitted:
        return None
    *coefficients, intercept = fitted[0, 0]
    spark, path, size = train.sparkSession, shared_folder(train.sparkSession), len(coefficients)
    plain = lambda params: {p.name: v for p, v in params.items()}
    told = {
        "class": "org.apache.spark.ml.classification.LogisticRegressionModel", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
        "uid": estimator.uid, "paramMap": plain(estimator._paramMap), "defaultParamMap": plain(estimator._defaultParamMap),
    }
    spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    schema = StructType().add("numClasses", "integer").add("numFeatures", "integer").add("interceptVector", VectorUDT()).add("coefficientMatrix", MatrixUDT()).add("isMultinomial", "boolean")
    row = (2, size, Vectors.dense([intercept]), DenseMatrix(1, size, coefficients, True), False)
    spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{path}/data")
    return LogisticRegressionModel.load(path)


def _adder(now: dict, size: int):
    """Sums of a task per fit: loss, slopes and curvature at the trial coefficients."""
    by_part: dict[int, list] = {}
    for i, (fit, state) in now.items():
        by_part.setdefault(fit["part"], []).append((i, list(state["trial"])))

    def add(batches):
        import numpy as np
        import pyarrow as pa

        trial = {i: np.array(b) for fits in by_part.values() for i, b in fits}
        held: dict[int, list] = {}
        for batch in batches:
            part, y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "y", "weight"))
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), size - 1)
            for p in np.unique(part):
                at = part == p
                x, yp, wp = np.column_stack([values[at], np.ones(at.sum())]), y[at], w[at]
                for i, _ in by_part[int(p)]:
                    if i not in held:
                        held[i] = [0.0, np.zeros(size), np.zeros((size, size))]
                    m = x @ trial[i]
                    q = 1 / (1 + np.exp(-np.clip(m, -700, 700)))
                    h = held[i]
                    h[0] += float(wp @ (np.logaddexp(0, m) - yp * m))
                    h[1] += x.T @ (wp * (q - yp))
                    h[2] += x.T @ (x * (wp * q * (1 - q))[:, None])
        for i, (loss, slope, curve) in held.items():
            data = np.concatenate([slope, curve.ravel()]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([loss], pa.float64()), pa.array([data], pa.binary())], ["fit", "loss", "sums"])

    return add


def _stepper(now: dict, size: int):
    """The next trial of a fit from the sums of all tasks: a full step, or half of one that has raised the objective."""

    rounds = _ROUNDS

    def step(pdf):
        import numpy as np
        import pandas as pd

        i = int(pdf["fit"].iloc[0])
        fit, old = now[i]
        base, trial, moved, value, share = np.array(old["base"]), np.array(old["trial"]), np.array(old["step"]), old["value"], old["part_of_step"]
        total, l1, l2 = fit["total"], fit["l"] * fit["alpha"], fit["l"] * (1 - fit["alpha"])
        penalty = lambda b: l1 * np.abs(b[:-1]).sum() + l2 / 2 * (b[:-1] ** 2).sum()
        reached = pdf["loss"].sum() / total + penalty(trial)

        def told(base, trial, moved, value, share, done):
            return pd.DataFrame([(i, base.tolist(), trial.tolist(), moved.tolist(), float(value), float(share), bool(done))], columns=["fit", "base", "trial", "step", "value", "part_of_step", "done"])

        if value is not None and not reached <= value + 1e-12 * abs(value):
            share /= 2
            return told(base, base + share * moved, moved, value, share, share < 1e-6)
        sums = np.zeros(size + size * size)
        for data in pdf["sums"]:
            sums += np.frombuffer(data)
        sums /= total
        free = np.flatnonzero(fit["free"])
        full, curve = sums[:size], sums[size:].reshape(size, size)
        ridge = np.full(size, l2)
        ridge[-1] = 0.0
        slope = (full + ridge * trial)[free]
        curve = (curve + np.diag(ridge))[np.ix_(free, free)]
        curve[np.diag_indices_from(curve)] += 1e-10 * max(np.trace(curve) / max(1, len(free)), 1e-12)
        bound = np.where(free < size - 1, l1, 0.0)
        b = trial[free]
        if l1:
            z, left, diagonal = b.copy(), slope.copy(), np.diag(curve).copy()  # ``left``: slope of the quadratic at z

            def sweep(places) -> float:
                largest = 0.0
                for j in places:
                    want = z[j] * diagonal[j] - left[j]
                    to = np.sign(want) * max(abs(want) - bound[j], 0.0) / diagonal[j]
                    change = to - z[j]
                    if change:
                        z[j] = to
                        left[:] += curve[j] * change
                        largest = max(largest, change * change * diagonal[j])
                return largest

            # coordinate descent finds which coefficients are not zero; with their signs kept, these have an exact solution
            for _ in range(rounds):
                if sweep(range(len(z))) < 1e-16:
                    break
                for _ in range(len(z)):
                    active = np.flatnonzero((z != 0) | (bound == 0))
                    go = -np.linalg.solve(curve[np.ix_(active, active)], left[active] + bound[active] * np.sign(z[active]))
                    crosses = (z[active] * (z[active] + go) < 0) & (bound[active] > 0)
                    part = np.min(-z[active][crosses] / go[crosses]) if crosses.any() else 1.0
                    ends = active[crosses][-z[active][crosses] / go[crosses] <= part]
                    z[active] += part * go
                    z[ends] = 0.0
                    left[:] = slope + curve @ (z - b)
                    if not crosses.any():
                        break
        else:
            z = b - np.linalg.solve(curve, slope)
        go = z - b
        promised = -(slope @ go + go @ curve @ go / 2 + (bound * (np.abs(z) - np.abs(b))).sum())
        moved = np.zeros(size)
        moved[free] = go
        return told(trial, trial + moved, moved, reached, 1.0, promised <= fit["tol"] * max(reached, 1e-6))

    return step


def margins(held: list[DataFrame], estimator, fitted: dict[tuple[int, int], list[float]]) -> DataFrame:
    """Rows (part, label, m) of all held-out parts, stored: the margin of every run of the part, in the order of runs."""
    label, vector = estimator.getLabelCol(), estimator.getFeaturesCol()
    parts = sorted({p for p, _ in fitted})
    rows = [held[p].select(F.lit(p).alias("part"), F.col(label).alias(label), _array(held[p], vector).alias("x")) for p in parts]
    told = reduce(lambda a, b: a.unionByName(b), rows)
    by_part = {p: [fitted[p, r] for r in range(sum(1 for q, _ in fitted if q == p))] for p in parts}

    def score(batches):
        import numpy as np
        import pyarrow as pa

        weights = {p: np.array(c) for p, c in by_part.items()}
        for batch in batches:
            part = batch.column("part").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
            out: list = [None] * len(part)
            for p in np.unique(part):
                at = np.flatnonzero(part == p)
                found = x[at] @ weights[int(p)][:, :-1].T + weights[int(p)][:, -1]
                for k, row in zip(at, found, strict=True):
                    out[k] = row.tolist()
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column(label), pa.array(out, pa.list_(pa.float64()))], ["part", label, "m"])

    schema = f"part int, {label} {dict(told.dtypes)[label]}, m array<double>"
    return cut_lineage(told.mapInArrow(score, schema))
