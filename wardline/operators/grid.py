"""Regular time grid per entity.

After ``bucket_aggregate`` an entity has at most one row per grid step, so its size is bounded by
its observed span divided by the step, however many events it had. The windows below rely on that
bound; they share one hash partitioning on the entity.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from wardline.functions.columns import bucket_start, epoch_micros, hours_between, micros_between, shift_hours
from wardline.operators.scans import MAX_GROUP_ROWS, Running, affine, drop_slices, running, split_large
from wardline.sources.tables import cut_lineage

_AGGREGATES = {"mean": F.avg, "max": F.max, "min": F.min}
_HOUR_MICROS = 3_600_000_000


def entity_window(key: str, ts: str) -> WindowSpec:
    """For grid rows only, of which an entity has one per step; raw rows go through ``scans`` instead."""
    return Window.partitionBy(key).orderBy(ts)


def bucket_aggregate(df: DataFrame, key: str, ts: str, hours: int, aggregates: dict[str, str]) -> DataFrame:
    """One row per entity and non-empty window; ``aggregates`` maps columns to mean, max, min or mode."""
    bucketed = df.filter(F.col(ts).isNotNull()).withColumn("__bucket", bucket_start(ts, hours))
    plain = {c: a for c, a in aggregates.items() if a != "mode"}
    modal = [c for c, a in aggregates.items() if a == "mode"]
    out = bucketed.groupBy(key, F.col("__bucket").alias(ts)).agg(
        F.count(F.lit(1)).alias("__rows"), *[_AGGREGATES[a](c).alias(c) for c, a in plain.items()]
    ).drop("__rows")
    if modal:
        modes = group_mode(bucketed.drop(ts).withColumnRenamed("__bucket", ts), [key, ts], modal)
        out = out.join(modes, [key, ts], "left")
    return out.select(key, ts, *aggregates)


def fill_gaps(buckets: DataFrame, key: str, ts: str, hours: int) -> DataFrame:
    """Insert the empty windows between an entity's first and last one as rows of nulls.

    Every bucket brings forth itself and the empty windows up to the next one, so neither a join
    nor a second scan is needed.
    """
    values = [c for c in buckets.columns if c not in (key, ts)]
    following = F.lead(ts).over(entity_window(key, ts))
    step = F.expr(f"INTERVAL {hours} HOURS")
    ahead = buckets.withColumn("__until", F.coalesce(shift_hours(following, -hours), F.col(ts)))
    return ahead.select(
        key, *values, F.posexplode(F.sequence(F.col(ts), F.col("__until"), step)).alias("__pos", "__slot")
    ).select(key, F.col("__slot").alias(ts), *[F.when(F.col("__pos") == 0, F.col(c)).alias(c) for c in values])


def resample(df: DataFrame, key: str, ts: str, hours: int, aggregates: dict[str, str]) -> DataFrame:
    return fill_gaps(bucket_aggregate(df, key, ts, hours, aggregates), key, ts, hours)


def forward_fill(grid: DataFrame, key: str, ts: str, columns: list[str], limit: int, hours: int) -> DataFrame:
    """Carry the last value forward over at most ``limit`` grid steps, within the entity."""
    upto = entity_window(key, ts).rowsBetween(Window.unboundedPreceding, 0)
    reach = limit * hours * _HOUR_MICROS

    def filled(column: str) -> Column:
        seen = F.last(F.when(F.col(column).isNotNull(), F.col(ts)), ignorenulls=True).over(upto)
        value = F.last(column, ignorenulls=True).over(upto)
        return F.when(micros_between(seen, ts) <= F.lit(reach), value)

    return grid.withColumns({c: filled(c) for c in columns})


def lead_label(grid: DataFrame, key: str, ts: str, label: str, steps: int) -> DataFrame:
    """Replace the label by the one ``steps`` grid steps ahead; rows without one are dropped."""
    ahead = F.lead(label, steps).over(entity_window(key, ts))
    return grid.withColumn(label, ahead).filter(F.col(label).isNotNull())


def step_index(grid: DataFrame, key: str, ts: str, name: str = "step") -> DataFrame:
    """1-based position of each grid row in its entity."""
    return grid.withColumn(name, F.row_number().over(entity_window(key, ts)))


def history_features(
    grid: DataFrame, key: str, ts: str, columns: list[str], lags: list[int], windows: list[int]
) -> DataFrame:
    """Features of every grid row from the entity's history: lagged values and trailing means."""
    order = entity_window(key, ts)
    made = {f"{c}_lag{n}": F.lag(c, n).over(order) for c in columns for n in lags}
    made |= {f"{c}_mean{n}": F.avg(c).over(order.rowsBetween(-(n - 1), 0)) for c in columns for n in windows}
    return grid.withColumns(made)


def decayed_history(
    grid: DataFrame, key: str, ts: str, columns: list[str], fast: float, slow: float, max_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """Features of every grid row from the entity's whole history, weighted by how long ago it was.

    Per column: ``_fast`` and ``_slow``, the means of its values so far with weights that fall to a half in so
    many hours; ``_trend``, the first less the second; ``_since``, the hours since its last value. All
    are null before the first value. Grid rows are unique per (key, time).
    """
    prepared, sliced = split_large(grid, [key], ts, max_rows)
    hours = epoch_micros(ts) / F.lit(_HOUR_MICROS)
    out = prepared
    for name, half in (("fast", fast), ("slow", slow)):
        inputs = {f"__{c}_{name}": F.col(c).cast("double") for c in columns}
        inputs |= {f"__n_{c}_{name}": F.col(c).isNotNull().cast("double") for c in columns}
        out = affine(out, [key], ts, -hours * F.lit(math.log(2) / half), inputs, sliced=sliced)
        out = cut_lineage(out) if sliced else out
    seen = {f"__t_{c}": Running("last", F.when(F.col(c).isNotNull(), F.col(ts))) for c in columns}
    out = running(out, [key], ts, seen, sliced=sliced)
    known = {c: F.col(f"__t_{c}").isNotNull() for c in columns}
    made = {}
    for c in columns:
        means = {n: F.when(known[c], F.col(f"__{c}_{n}") / F.col(f"__n_{c}_{n}")) for n in ("fast", "slow")}
        made |= {f"{c}_{n}": v for n, v in means.items()}
        made |= {f"{c}_trend": means["fast"] - means["slow"], f"{c}_since": hours_between(f"__t_{c}", ts)}
    return drop_slices(out.select(*prepared.columns, *[v.alias(n) for n, v in made.items()]))


def group_mode(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Most frequent non-null value per key and column, the lowest on ties.

    Counts are built by partial aggregation on (key, column, value), so neither a large group nor
    one with many distinct values is held in memory. The columns need a common type.
    """
    counted = (
        df.unpivot(keys, columns, "__column", "__value")
        .filter(F.col("__value").isNotNull())
        .groupBy(*keys, "__column", "__value")
        .agg(F.count(F.lit(1)).alias("__n"))
    )

    def mode_of(column: str) -> Column:
        candidate = F.when(F.col("__column") == column, F.struct((-F.col("__n")).alias("n"), F.col("__value").alias("v")))
        return F.min(candidate)["v"].alias(column)

    return counted.groupBy(*keys).agg(*[mode_of(c) for c in columns])
