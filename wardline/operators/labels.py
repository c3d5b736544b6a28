"""Prediction targets: binarised stage, horizon shift, first onset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wardline.functions.columns import stage_label
from wardline.operators.grid import lead_label
from wardline.operators.scans import attach


def binarise(df: DataFrame, stage: str, threshold: int | None) -> DataFrame:
    return df.withColumn(stage, stage_label(stage, threshold))


def shift_label(
    grid: DataFrame, key: str, ts: str, stage: str, hours: int, step_hours: int, threshold: int | None = 1
) -> DataFrame:
    """Binarise, then let every row carry the label of ``hours`` later."""
    return lead_label(binarise(grid, stage, threshold), key, ts, stage, hours // step_hours)


def first_onset(grid: DataFrame, key: str, ts: str, label: str) -> DataFrame:
    """Keep each entity's rows up to its first positive one; ``label`` says whether there is one.

    Works on grid rows (bounded per entity), on the partitioning the grid operators left behind.
    """
    whole = Window.partitionBy(key)
    onset = F.min(F.when(F.col(label) == 1, F.col(ts))).over(whole)
    return (
        grid.withColumn("__onset", onset)
        .filter(F.col("__onset").isNull() | (F.col(ts) <= F.col("__onset")))
        .withColumn(label, F.col("__onset").isNotNull().cast("int"))
        .drop("__onset")
    )


def onset_cutoffs(df: DataFrame, key: str, ts: str, label: str) -> DataFrame:
    """(key, cutoff, label): the first positive moment, otherwise the last one. Any row count."""
    positive = F.when(F.col(label) == 1, F.col(ts))
    return df.groupBy(key).agg(
        F.coalesce(F.min(positive), F.max(ts)).alias("cutoff"), F.min(positive).isNotNull().cast("int").alias(label)
    )


def cut_at(df: DataFrame, cutoffs: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows not after their entity's cutoff."""
    dated = attach(df, cutoffs.select(key, "cutoff"), [key], "inner")
    return dated.filter(F.col(ts) <= F.col("cutoff")).drop("cutoff")


def last_label(df: DataFrame, key: str, ts: str, label: str) -> DataFrame:
    """Label of each entity's last row, the highest if there are several at that moment."""
    last = F.max(F.struct(F.col(ts), F.col(label)))
    return df.groupBy(key).agg(last.alias("__last")).select(key, F.col("__last")[ts].alias(ts), F.col("__last")[label].alias(label))
