"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

# Edges of ten equal bins on [0, 1], as numpy.linspace spells them.
UNIT_EDGES = [k * 0.1 for k in range(1, 10)]
# The calibration bins are stretched by 1e-8 so that 1.0 falls into the last one.
CALIBRATION_EDGES = [k * ((1.0 + 1e-8) / 10) for k in range(1, 10)]


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def hours_between(start: Column | str, end: Column | str) -> Column:
    return micros_between(start, end) / F.lit(3.6e9)


def epoch_micros(moment: Column | str) -> Column:
    """Microseconds since 1970, UTC."""
    return micros_between(F.timestamp_micros(F.lit(0)), moment)


def days_between(start: Column | str, end: Column | str, digits: int = 4) -> Column:
    return F.round(micros_between(start, end) / F.lit(86400e6), digits)


def bucket_start(ts: Column | str, hours: int) -> Column:
    """Start of the fixed window holding ``ts``; aligned to midnight UTC if ``hours`` divides a day."""
    return F.window(ts, f"{hours} hours").start


def shift_hours(ts: Column, hours: int | Column) -> Column:
    return F.timestamp_add("HOUR", F.lit(hours) if isinstance(hours, int) else hours, ts)


def midpoint(low: str, high: str) -> Column:
    """Mean of two columns; null as soon as one of them is null."""
    return (F.col(low) + F.col(high)) / F.lit(2.0)


def no_nan(column: str) -> Column:
    return F.when(~F.isnan(column), F.col(column))


def clip(value: Column, low: Column, high: Column) -> Column:
    """Bound ``value``; null stays null, a null bound does not bind."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def rescale(value: Column, low: Column, high: Column) -> Column:
    """Min-max scaling to [0, 1]; a constant column becomes 0."""
    return F.when(
        value.isNotNull(),
        F.coalesce(F.try_divide(value - low, high - low), F.lit(0.0)),
    )


def stage_label(stage: str, threshold: int | None) -> Column:
    """0/1 label for ``stage >= threshold``; all stages if no threshold is given."""
    if threshold is None:
        return F.col(stage).cast("int")
    return (F.col(stage) >= threshold).cast("int")


def one_hot(column: str, levels: list[str]) -> list[Column]:
    """One 0/1 column per listed level, named after the level."""
    return [F.coalesce((F.col(column) == level).cast("int"), F.lit(0)).alias(level) for level in levels]


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def decide(prob: Column, cut: Column) -> Column:
    """Positive decision strictly above the cut-off."""
    return (prob > cut).cast("int")


def bin_index(prob: Column, edges: list[float]) -> Column:
    """Zero-based bin, left-closed; values at or above the last edge share the last bin."""
    return reduce(add, [(prob >= F.lit(edge)).cast("int") for edge in edges])


def swap_if(condition: Column, first: str, second: str) -> tuple[Column, Column]:
    """The pair (first, second), exchanged where the condition holds."""
    a, b = F.col(first), F.col(second)
    return F.when(condition, b).otherwise(a), F.when(condition, a).otherwise(b)


def is_distinct_from(column: str, value) -> Column:
    """Inequality for which null counts as different."""
    return ~F.col(column).eqNullSafe(F.lit(value))


def any_present(*columns: str) -> Column:
    return F.coalesce(*[F.col(c).cast("double") for c in columns]).isNotNull()
