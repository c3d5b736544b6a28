"""Ordered scans that do not depend on how large a single group is.

A plain window ``partitionBy(keys).orderBy(ts)`` runs each group in one task. That is right as long
as groups are small, so the sizes are counted first. If there are larger ones, the rows are sorted
over all tasks, and what a task holds of a group is a slice; every slice is scanned on its own and
gets the summary of the slices before it (one row per slice).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardline.sources.tables import cut_lineage

SLICE = "__slice"
_SPLIT = "__split"
_KEY = "__key"
# Units of a logarithm within which factors are multiplied out; exp(300) and its square are doubles.
_SEGMENT = 300.0

# Rows of one group above which the group is cut into slices.
MAX_GROUP_ROWS = 4_000_000
# Slices, and with them tasks and files, above which slices get longer instead of more, until they have MAX_GROUP_ROWS rows.
MAX_SLICES = 96
# Rows that a task should get of a shuffle whose rows are known beforehand.
TASK_ROWS = 1 << 20


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks for so many rows, if they are more than the session gives a shuffle."""
    wanted = math.ceil(rows / TASK_ROWS)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def deal(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Rows dealt out by keys to a number of tasks; as they are without one, which leaves that to Spark."""
    return df.repartition(tasks, *keys) if tasks else df


@dataclass(frozen=True)
class Running:
    """A running value: ``kind`` is max, sum or last (last non-null)."""

    kind: str
    value: Column
    include_current: bool = True


def split_large(df: DataFrame, keys: list[str], ts: str, max_rows: int | None = MAX_GROUP_ROWS) -> tuple[DataFrame, bool]:
    """Add the slice number to ``df``: 0 for ordinary groups, rising with time for large ones.

    ``df`` should be reduced as far as it can be: it is stored and its groups are counted, which runs
    at once. With a group of more than ``max_rows`` rows the rows are dealt out by ranges of (keys,
    ts) that Spark samples, so slices have like numbers of rows however the moments are spread. A
    ``max_rows`` that would give more than ``MAX_SLICES`` slices gives longer ones. The second result
    tells whether that happened; then the sliced rows are stored, because the scans read them more
    than once.
    """
    plain = {SLICE: F.lit(0), _SPLIT: F.lit(False)}
    if max_rows is None:
        return df.withColumns(plain), False
    stored = cut_lineage(df)
    counts = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    rows, largest = counts.agg(F.sum("__n"), F.max("__n")).first()
    if not rows or largest <= max_rows:
        # the windows need the rows by their keys anyway
        return deal(stored, tasks_for(df.sparkSession, rows or 0), *keys).withColumns(plain), False
    wanted, needed = (math.ceil(1.5 * rows / n) for n in (max_rows, MAX_GROUP_ROWS))
    parts = max(2, min(wanted, max(MAX_SLICES, needed)))
    dealt = stored.repartitionByRange(parts, *keys, ts).withColumn(SLICE, F.spark_partition_id())
    sliced = cut_lineage(dealt)
    # a struct compares equal to another one with nulls at the same places
    key = F.struct(*keys).alias(_KEY)
    cut = sliced.groupBy(key).agg(F.min(SLICE).alias("__low"), F.max(SLICE).alias("__high")).filter("__low < __high")
    # fewer than ``parts`` groups lie in more than one slice
    marked = sliced.withColumn(_KEY, key).join(F.broadcast(cut.select(_KEY, F.lit(True).alias(_SPLIT))), _KEY, "left")
    return marked.drop(_KEY).withColumn(_SPLIT, F.coalesce(_SPLIT, F.lit(False))), True


def slice_number() -> Column:
    """Slice of a row of ``split_large``; groups that are not cut have one slice, 0."""
    return F.when(F.col(_SPLIT), F.col(SLICE)).otherwise(F.lit(0))


def drop_slices(df: DataFrame) -> DataFrame:
    return df.drop(SLICE, _SPLIT)


def _local(measure: Running, window) -> Column:
    frame = window.rowsBetween(Window.unboundedPreceding, 0 if measure.include_current else -1)
    if measure.kind == "max":
        return F.max(measure.value).over(frame)
    if measure.kind == "sum":
        return F.sum(measure.value).over(frame)
    if measure.kind == "last":
        return F.last(measure.value, ignorenulls=True).over(frame)
    raise ValueError(f"unknown running value: {measure.kind}")


def _summary(measure: Running, order: str) -> Column:
    if measure.kind == "max":
        return F.max(measure.value)
    if measure.kind == "sum":
        return F.sum(measure.value)
    return F.max_by(measure.value, F.when(measure.value.isNotNull(), F.col(order)))


def _combine(kind: str, local: Column, carried: Column) -> Column:
    if kind == "max":
        return F.greatest(local, carried)
    if kind == "sum":
        zero = F.lit(0)
        return F.coalesce(local, zero) + F.coalesce(carried, zero)
    return F.coalesce(local, carried)


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    measures: dict[str, Running],
    *,
    descending: bool = False,
    sliced: bool = True,
    only_split: bool = True,
    totals: bool = False,
) -> DataFrame:
    """Running values per group in the order of one column, over already sliced rows.

    ``df`` carries the column ``SLICE``, which must not decrease along the order (not increase if
    ``descending``). With ``only_split`` just the groups cut by ``split_large`` are carried over;
    otherwise ``totals`` can add the value over the whole group as ``<name>_total``.
    """
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    window = Window.partitionBy(*keys, SLICE).orderBy(direction(order))
    out = df.withColumns({name: _local(m, window) for name, m in measures.items()})
    if not sliced:
        return out
    source = df.filter(_SPLIT) if only_split else df
    before = Window.partitionBy(*keys).orderBy(direction(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    over_slices = {"max": F.max, "sum": F.sum, "last": lambda c: F.last(c, ignorenulls=True)}
    carried = (
        source.groupBy(*keys, SLICE)
        .agg(*[_summary(m, order).alias(f"__c_{name}") for name, m in measures.items()])
        .select(
            *keys,
            SLICE,
            *[over_slices[m.kind](f"__c_{n}").over(before).alias(f"__c_{n}") for n, m in measures.items()],
            *[F.sum(f"__c_{n}").over(Window.partitionBy(*keys)).alias(f"{n}_total") for n in measures if totals],
        )
    )
    # a struct compares equal to another one with nulls at the same places: groups with null keys are carried over too
    key = F.struct(*keys, SLICE).alias(_KEY)
    joined = out.withColumn(_KEY, key).join(
        carried.select(key, *[c for c in carried.columns if c not in (*keys, SLICE)]), _KEY, "left" if only_split else "inner"
    )
    return joined.withColumns({n: _combine(m.kind, F.col(n), F.col(f"__c_{n}")) for n, m in measures.items()}).drop(
        _KEY, *[f"__c_{n}" for n in measures]
    )


def affine(
    df: DataFrame, keys: list[str], order: str, level: Column, inputs: dict[str, Column], *, sliced: bool = True
) -> DataFrame:
    """Running affine values per group: a row's state is ``exp(level - level before) * state before + input``.

    ``level`` must not rise along ``order``; it is the running sum of the logarithms of the factors, or, for
    a decay by elapsed time, minus the time over its constant. Null inputs count as 0. Two steps
    compose to one (factors multiply, the earlier input is scaled by the later factor), so the state
    is a running sum of inputs lifted to a common level, times what they have lost since. Levels are
    cut into segments of ``_SEGMENT``, so that no factor overflows: a segment's sums start anew and get
    the end of the segment before; what lies further back has decayed by more than exp(-``_SEGMENT``)
    and counts as 0. ``sliced`` rows come from ``split_large``.
    """
    segment = F.floor(-F.col("__level") / F.lit(_SEGMENT))
    leveled = df.withColumn("__level", level).withColumn("__segment", segment)
    anchor = -F.col("__segment") * F.lit(_SEGMENT)
    lifted = {n: F.coalesce(v, F.lit(0.0)) * F.exp(anchor - F.col("__level")) for n, v in inputs.items()}
    parts = [*keys, "__segment"]
    summed = running(leveled, parts, order, {n: Running("sum", v) for n, v in lifted.items()}, sliced=sliced)
    before = Window.partitionBy(*keys).orderBy("__segment")
    ends = leveled.groupBy(*parts).agg(F.min("__level").alias("__end"), *[F.sum(v).alias(f"__e_{n}") for n, v in lifted.items()])
    ends = ends.withColumns({f"__e_{n}": F.col(f"__e_{n}") * F.exp(F.col("__end") - anchor) for n in inputs})
    key = F.struct(*parts).alias(_KEY)
    carried = ends.select(
        key, F.lag("__end").over(before).alias("__end"), *[F.lag(f"__e_{n}").over(before).alias(f"__e_{n}") for n in inputs]
    )
    joined = summed.withColumn(_KEY, key).join(carried, _KEY)
    here, since = F.exp(F.col("__level") - anchor), F.exp(F.col("__level") - F.col("__end"))
    states = {n: F.col(n) * here + F.coalesce(F.col(f"__e_{n}") * since, F.lit(0.0)) for n in inputs}
    return joined.withColumns(states).drop(_KEY, "__level", "__segment", "__end", *[f"__e_{n}" for n in inputs])


def rank_rows(
    df: DataFrame, keys: list[str], cell: Column, order: list[Column], name: str, total: str | None = None
) -> DataFrame:
    """1-based rank per group by (cell, order) without sorting a whole group in one task.

    With ``total`` the size of the group is added under that name.

    ``cell`` must be non-decreasing along ``order`` and take a bounded number of values.
    """
    cells = df.withColumn("__cell", cell)
    within = Window.partitionBy(*keys, "__cell").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        cells.groupBy(*keys, "__cell")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            *keys,
            "__cell",
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"),
            *([F.sum("__n").over(Window.partitionBy(*keys)).alias(total)] if total else []),
        )
    )
    ranked = cells.withColumn("__rank", F.row_number().over(within))
    key = F.struct(*keys, "__cell").alias(_KEY)
    return (
        ranked.withColumn(_KEY, key)
        .join(base.select(key, "__base", *([total] if total else [])), _KEY)
        .withColumn(name, F.col("__base") + F.col("__rank"))
        .drop(_KEY, "__cell", "__rank", "__base")
    )


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1-based rank of every row by ``order``, which should leave no ties, for columns of any type.

    The rows are sorted over all tasks and stored; a task's rows are numbered by the task, and only
    one count per task is summed up in order.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    stored = cut_lineage(dealt).withColumn("__task", F.shiftright("__id", 33))
    tasks = stored.groupBy("__task").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    until = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    base = tasks.select("__task", (F.coalesce(F.sum("__n").over(until), F.lit(0)) - F.col("__first") + F.lit(1)).alias("__base"))
    return stored.join(base, "__task").withColumn(name, F.col("__id") + F.col("__base")).drop("__id", "__task", "__base")


def attach(rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows with a lookup of one or a few rows per key (inner, left, left_semi or left_anti).

    One plan for all sizes: Spark broadcasts the lookup if it turns out small, and splits the rows of
    a key that has too many. For that both sides have to come from a shuffle of the join itself; so
    they are joined on a struct of the keys, by which a grouped lookup is not partitioned yet. Null
    keys match nothing.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    key = F.when(known, F.struct(*keys))
    values = [c for c in lookup.columns if c not in keys]
    keyed = lookup.filter(known).select(key.alias(_KEY), *values)
    others = [c for c in rows.columns if c not in keys]
    joined = rows.withColumn(_KEY, key).join(keyed, _KEY, how)
    return joined.select(*keys, *others, *(values if how in ("inner", "left") else []))
