"""Feature columns: imputation, static attributes, winsorising and scaling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from wardline.functions.columns import clip, midpoint, one_hot, rescale
from wardline.operators.grid import group_mode
from wardline.operators.scans import SLICE, Running, attach, running, split_large

# Resolution of the value cells: about 1/2048 relative width, 1/1024 absolute near zero.
_CELLS_PER_E = 2048
# Distinct values of a cell that are ordered by one task.
MAX_CELL_VALUES = 1_000_000


def midpoints(df: DataFrame, names: list[str], low: str = "{}_min", high: str = "{}_max", out: str = "{}_avg") -> DataFrame:
    """Replace each min/max pair by its mean."""
    made = df.withColumns({out.format(n): midpoint(low.format(n), high.format(n)) for n in names})
    return made.drop(*[p.format(n) for n in names for p in (low, high)])


def fill_constant(df: DataFrame, value: float, columns: list[str]) -> DataFrame:
    return df.fillna(value, subset=columns)


def impute_entity_mode(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fill nulls by the entity's most frequent value of the column."""
    modes = group_mode(df, [key], columns).withColumnsRenamed({c: f"__m_{c}" for c in columns})
    return (
        attach(df, modes, [key], "left")
        .withColumns({c: F.coalesce(F.col(c), F.col(f"__m_{c}").cast(dict(df.dtypes)[c])) for c in columns})
        .drop(*[f"__m_{c}" for c in columns])
    )


def impute_column_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill nulls by the column's most frequent value."""
    modes = group_mode(df, [], columns).select(F.struct(*columns).alias("m"))
    types = dict(df.dtypes)
    return (
        df.withColumn("__m", modes.scalar())
        .withColumns({c: F.coalesce(F.col(c), F.col("__m")[c].cast(types[c])) for c in columns})
        .drop("__m")
    )


def static_features(
    df: DataFrame,
    detail: DataFrame,
    key: str,
    numeric: list[str],
    categorical: dict[str, list[str]],
) -> DataFrame:
    """Join one row of static attributes per entity, categories as one 0/1 column per level."""
    encoded = [e for column, levels in categorical.items() for e in one_hot(column, levels)]
    return attach(df, detail.select(key, *numeric, *encoded), [key], "left")


def _value_cell(value: Column) -> Column:
    """Bounded number of order-preserving cells over all doubles."""
    magnitude = F.floor(F.log1p(F.abs(value) * F.lit(1024.0)) * F.lit(float(_CELLS_PER_E)))
    return F.when(value < 0, -magnitude - F.lit(1)).otherwise(magnitude)


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], max_values: int = MAX_CELL_VALUES) -> DataFrame:
    """(column, q0, q1, ...): exact quantiles with linear interpolation, without a global sort.

    A histogram over value cells finds the cells that hold the wanted ranks; only the distinct
    values of those cells are then ordered. A cell with more than ``max_values`` of them is cut into
    slices of like counts, however close its values are.
    """
    cells = (
        df.select([F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
        .withColumn("cell", _value_cell(F.col("value")))
    )
    histogram = cells.groupBy("column", "cell").agg(F.count(F.lit(1)).alias("n"))
    totals = histogram.groupBy("column").agg(F.sum("n").alias("total"))
    upto = running(
        histogram.withColumn(SLICE, F.lit(0)), ["column"], "cell", {"upto": Running("sum", F.col("n"))}, sliced=False
    ).drop(SLICE)
    ranks = [F.lit(float(p)) * (F.col("total") - F.lit(1)) for p in probabilities]
    below = F.col("upto") - F.col("n")

    def holds(rank: Column) -> Column:
        return (below <= rank) & (rank < F.col("upto"))

    wanted = F.lit(False)
    for rank in ranks:
        wanted = wanted | holds(F.floor(rank)) | holds(F.ceil(rank))
    chosen = upto.join(totals, "column").filter(wanted).withColumn("before", below).drop("n", "upto")
    # at most two cells per column and probability
    values = (
        cells.join(F.broadcast(chosen), ["column", "cell"])
        .groupBy("column", "cell", "before", "total", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # values that lie dense within a cell are dealt out by their counts
    prepared, sliced = split_large(values, ["column", "cell"], "value", max_values)
    counted = running(prepared, ["column", "cell"], "value", {"__upto": Running("sum", F.col("n"))}, sliced=sliced)
    position = F.col("before") + F.col("__upto")

    def pick(rank: Column, name: str) -> list[Column]:
        return [
            F.min(F.when(position > F.floor(rank), F.col("value"))).alias(f"__lo_{name}"),
            F.min(F.when(position > F.ceil(rank), F.col("value"))).alias(f"__hi_{name}"),
        ]

    names = [f"q{i}" for i in range(len(probabilities))]
    picked = counted.groupBy("column", "total").agg(*[c for r, n in zip(ranks, names) for c in pick(r, n)])

    def interpolate(rank: Column, name: str) -> Column:
        share = rank - F.floor(rank)
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        return (low + (high - low) * share).alias(name)

    return picked.select("column", *[interpolate(r, n) for r, n in zip(ranks, names)])


def quantile_bounds(df: DataFrame, columns: list[str], lower: float, upper: float, approx: bool = False) -> DataFrame:
    """One row with a struct (low, high, min, max) per column: two quantiles and the extremes."""
    if approx:
        both = F.array(F.lit(lower), F.lit(upper))
        found = df.agg(
            *[F.percentile_approx(F.col(c).cast("double"), both, 100_000).alias(f"__q_{c}") for c in columns],
            *[side(c).cast("double").alias(f"__{n}_{c}") for c in columns for n, side in (("min", F.min), ("max", F.max))],
        )
        return found.select(
            *[
                F.struct(
                    F.col(f"__q_{c}")[0].alias("low"),
                    F.col(f"__q_{c}")[1].alias("high"),
                    F.col(f"__min_{c}").alias("min"),
                    F.col(f"__max_{c}").alias("max"),
                ).alias(c)
                for c in columns
            ]
        )
    long = exact_quantiles(df, columns, [0.0, lower, upper, 1.0])
    four = F.struct(F.col("q1").alias("low"), F.col("q2").alias("high"), F.col("q0").alias("min"), F.col("q3").alias("max"))
    return long.agg(*[F.max(F.when(F.col("column") == c, four)).alias(c) for c in columns])


def value_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with a struct (min, max) per column."""
    return df.agg(
        *[F.struct(F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c) for c in columns]
    )


def _with_bounds(df: DataFrame, bounds: DataFrame, changes: dict[str, Callable[[Column, Column], Column]]) -> DataFrame:
    """Apply ``change(value, bounds)``; the one row of bounds is a scalar subquery, not a join."""
    row = bounds.select(F.struct(*changes).alias("b")).scalar()
    changed = {c: change(F.col(c).cast("double"), F.col("__b")[c]) for c, change in changes.items()}
    return df.withColumn("__b", row).withColumns(changed).drop("__b")


def _clipped(value: Column, b: Column) -> Column:
    return clip(value, b["low"], b["high"])


def _scaled(value: Column, b: Column) -> Column:
    return rescale(value, b["min"], b["max"])


def _clipped_and_scaled(value: Column, b: Column) -> Column:
    # clipping is monotone: the extremes of the clipped column are the clipped extremes
    return rescale(_clipped(value, b), _clipped(b["min"], b), _clipped(b["max"], b))


def cap(df: DataFrame, bounds: DataFrame, columns: list[str]) -> DataFrame:
    return _with_bounds(df, bounds, {c: _clipped for c in columns})


def scale(df: DataFrame, bounds: DataFrame, columns: list[str]) -> DataFrame:
    return _with_bounds(df, bounds, {c: _scaled for c in columns})


def fit_scaler(
    df: DataFrame, capped: list[str], scaled: list[str], lower: float = 0.01, upper: float = 0.99, approx: bool = False
) -> DataFrame:
    return quantile_bounds(df, list(dict.fromkeys([*capped, *scaled])), lower, upper, approx)


def apply_scaler(df: DataFrame, bounds: DataFrame, capped: list[str], scaled: list[str]) -> DataFrame:
    """Winsorise the capped columns and bring the scaled ones to [0, 1], in one projection."""
    changes = {c: _scaled for c in scaled} | {c: _clipped_and_scaled if c in scaled else _clipped for c in capped}
    return _with_bounds(df, bounds, changes)
