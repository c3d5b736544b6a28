"""Treatment episodes, interval union, and flags for moments inside intervals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wardline.functions.columns import epoch_micros, hours_between
from wardline.operators.scans import MAX_GROUP_ROWS, Running, attach, deal, drop_slices, running, split_large
from wardline.sources.tables import cut_lineage


def rate_log(events: DataFrame, keys: list[str], ts: str = "starttime", rate: str = "rate") -> DataFrame:
    """One row per (keys, time): the highest rate recorded, null if none was."""
    return events.groupBy(*keys, ts).agg(F.max(rate).alias(rate))


def carry_rate(
    events: DataFrame, keys: list[str], ts: str = "starttime", rate: str = "rate", max_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """Add the rate in force at each row and the one in force before it."""
    log, sliced = split_large(rate_log(events, keys, ts, rate), keys, ts, max_rows)
    value = F.col(rate)
    measures = {"carried_rate": Running("last", value), "previous_rate": Running("last", value, include_current=False)}
    return drop_slices(running(log, keys, ts, measures, sliced=sliced))


def episodes(
    events: DataFrame, keys: list[str], ts: str = "starttime", rate: str = "rate", max_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """Periods of delivery from rate records: (keys, starttime, endtime).

    Delivery begins with a recorded rate that is positive if nothing was recorded before, or not
    zero after a rate of zero. It ends with the first rate of zero, or with the last record. Rows
    without a rate continue what was in force. Periods of no length or without a positive rate
    are no delivery.
    """
    events = events.dropna(subset=keys)
    log, sliced = split_large(rate_log(events, keys, ts, rate), keys, ts, max_rows)
    value, previous = F.col(rate), F.col("__previous")
    known = running(log, keys, ts, {"__previous": Running("last", value, include_current=False)}, sliced=sliced)
    known = cut_lineage(known) if sliced else known
    begins = F.when(previous.isNull(), value > 0).otherwise((previous == 0) & (value != 0))
    dated = running(known, keys, ts, {"__begin": Running("max", F.when(begins, F.col(ts)))}, sliced=sliced)
    return (
        dated.filter(F.col("__begin").isNotNull())
        .groupBy(*keys, F.col("__begin").alias("starttime"))
        .agg(
            F.min(F.when(value == 0, F.col(ts))).alias("__stop"),
            F.max(ts).alias("__last"),
            F.max(rate).alias("__peak"),
        )
        .withColumn("endtime", F.coalesce("__stop", "__last"))
        .filter((F.col("endtime") != F.col("starttime")) & (F.col("__peak") > 0))
        .select(*keys, "starttime", "endtime")
    )


def merge_intervals(
    intervals: DataFrame,
    keys: list[str],
    start: str = "starttime",
    end: str = "endtime",
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Union of closed intervals per key; overlapping and touching ones become one."""
    return _merge(intervals, keys, start, end, max_rows)[0]


def _merge(intervals: DataFrame, keys: list[str], start: str, end: str, max_rows: int | None) -> tuple[DataFrame, bool]:
    valid = intervals.dropna(subset=[*keys, start, end])
    longest = valid.groupBy(*keys, start).agg(F.max(end).alias(end))
    prepared, sliced = split_large(longest, keys, start, max_rows)
    covered = running(
        prepared, keys, start, {"__covered": Running("max", F.col(end), include_current=False)}, sliced=sliced
    )
    covered = cut_lineage(covered) if sliced else covered
    opens = F.col("__covered").isNull() | (F.col(start) > F.col("__covered"))
    islands = running(covered, keys, start, {"__island": Running("max", F.when(opens, F.col(start)))}, sliced=sliced)
    return islands.groupBy(*keys, F.col("__island").alias(start)).agg(F.max(end).alias(end)), sliced


def order_intervals(events: DataFrame, keys: list[str], start: str = "starttime", end: str = "endtime") -> DataFrame:
    """Bounding interval of all events of one order."""
    return events.groupBy(*keys).agg(F.min(start).alias(start), F.max(end).alias(end))


def number_intervals(
    merged: DataFrame,
    key: str,
    name: str = "number",
    start: str = "starttime",
    end: str = "endtime",
    max_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Consecutive number per key and length in hours of disjoint intervals."""
    prepared, sliced = split_large(merged, [key], start, max_rows)
    numbered = running(prepared, [key], start, {name: Running("sum", F.lit(1))}, sliced=sliced)
    return numbered.select(
        key, F.col(name).cast("bigint").alias(name), start, end, hours_between(start, end).alias("duration_hours")
    )


def durations(
    sources: list[DataFrame], key: str, name: str = "number", max_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """Merged, numbered intervals of each source; numbering restarts per source, equal rows unite."""
    parts = []
    for source in sources:
        merged, sliced = _merge(source, [key], "starttime", "endtime", max_rows)
        # merging only shrinks groups: without large ones before there are none now
        parts.append(number_intervals(merged, key, name, max_rows=max_rows if sliced else None))
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def flags_at(
    times: list[DataFrame],
    intervals: dict[str, DataFrame],
    key: str = "stay_id",
    ts: str = "charttime",
    start: str = "starttime",
    end: str = "endtime",
    max_rows: int | None = MAX_GROUP_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """For every distinct (key, time) of the sources: is it inside an interval, per interval kind.

    Both interval ends belong to it. A moment lies inside some interval exactly if the latest end
    among the intervals begun so far has not passed. So moments and interval starts are laid on one
    time line and a single running maximum per kind answers it: no range join, all kinds at once,
    and intervals may overlap. ``tasks`` says how many tasks the time line is dealt out to, else the session does.
    """
    names = list(intervals)
    null_end = {n: F.lit(None).cast(dict(intervals[n].dtypes)[end]).alias(n) for n in names}
    points = [
        t.select(F.col(key), F.col(ts), F.lit(True).alias("__asked"), *[null_end[n] for n in names]) for t in times
    ]
    starts = [
        df.dropna(subset=[key, start, end]).select(
            F.col(key),
            F.col(start).alias(ts),
            F.lit(False).alias("__asked"),
            *[F.col(end).alias(n) if n == name else null_end[n] for n in names],
        )
        for name, df in intervals.items()
    ]
    line = reduce(lambda a, b: a.unionByName(b), [*points, *starts])
    moments = deal(line, tasks, key, ts).groupBy(key, ts).agg(F.max("__asked").alias("__asked"), *[F.max(n).alias(n) for n in names])
    prepared, sliced = split_large(moments, [key], ts, max_rows)
    covered = running(prepared, [key], ts, {f"__{n}": Running("max", F.col(n)) for n in names}, sliced=sliced)
    return covered.filter("__asked").select(
        key, ts, *[F.coalesce((F.col(f"__{n}") >= F.col(ts)).cast("int"), F.lit(0)).alias(n) for n in names]
    )


def flag_at(times: list[DataFrame], intervals: DataFrame, name: str, **options) -> DataFrame:
    return flags_at(times, {name: intervals}, **options)


def join_flags(flags: list[DataFrame], keys: list[str]) -> DataFrame:
    """Inner join of separately computed flag tables."""
    out = flags[0]
    for other in flags[1:]:
        out = out.join(other, keys)
    return out


# Hours that the shortest bins of intervals are wide; each level is twice as wide.
_BIN_HOURS = 1.0
_BIN_FACTOR = 2.0
# Intervals of a key up to which a moment is held against all of them, and of a bin up to which it is not dealt out.
PLAIN_INTERVALS = 256
BIN_INTERVALS = 8192


def intervals_at(
    times: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    ts: str = "charttime",
    start: str = "starttime",
    end: str = "endtime",
) -> DataFrame:
    """Every distinct (keys, time) with every interval it lies in: one row per match, all columns of the intervals.

    Both ends belong to an interval. The intervals are stored and counted, which runs at once. A key with few
    intervals is joined as it is. For the others it is a range join by bins: an interval goes to the level whose
    bins are just as wide as it is long, where it touches two bins at most, and a moment has one bin on each
    level its key has. So long and short intervals cost the same, the rows of one key spread over its bins, and
    a match is found once. A bin of many intervals is dealt out in parts, and its moments go to each of them.
    Moments and intervals with a null key or bound match nothing.
    """
    return _matches(times.select(*keys, ts).dropna().distinct(), intervals, keys, ts, start, end)


def _matches(moments: DataFrame, intervals: DataFrame, keys: list[str], ts: str, start: str, end: str) -> DataFrame:
    length = hours_between(start, end)
    level = F.when(length <= _BIN_HOURS, 0).otherwise(F.ceil(F.log(_BIN_FACTOR, length / F.lit(_BIN_HOURS)))).cast("int")
    known = intervals.dropna(subset=[*keys, start, end]).filter(F.col(start) <= F.col(end))
    valid = cut_lineage(known.withColumns({"__own": level, "__id": F.monotonically_increasing_id()}))
    many = valid.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.collect_set("__own").alias("__levels"))
    large = cut_lineage(many.filter(F.col("__n") > PLAIN_INTERVALS).drop("__n"))

    def bin_of(moment: str):
        wide = F.pow(F.lit(_BIN_FACTOR), "__level") * F.lit(_BIN_HOURS * 3.6e9)
        return F.when(F.col("__level") < 0, F.lit(0).cast("bigint")).otherwise(F.floor(epoch_micros(moment) / wide))

    leveled = attach(valid, large, keys, "left").withColumn("__level", F.when(F.col("__levels").isNull(), -1).otherwise(F.col("__own")))
    binned = leveled.withColumn("__bin", F.explode(F.sequence(bin_of(start), bin_of(end)))).drop("__levels", "__own")
    place = [*keys, "__level", "__bin"]
    counts = binned.filter("__level >= 0").groupBy(*place).agg(F.count(F.lit(1)).alias("__n"))
    full = cut_lineage(counts.filter(F.col("__n") > BIN_INTERVALS).select(*place, F.ceil(F.col("__n") / BIN_INTERVALS).cast("int").alias("__parts")))
    dealt = attach(binned, full, place, "left").withColumn("__part", F.coalesce(F.pmod("__id", "__parts"), F.lit(0)).cast("int"))
    levels = F.coalesce("__levels", F.array(F.lit(-1)))
    asked = attach(moments, large, keys, "left").select(*keys, ts, F.explode(levels).alias("__level")).withColumn("__bin", bin_of(ts))
    parts = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
    asked = attach(asked, full, place, "left").withColumn("__part", F.explode(parts))
    # joined on a struct, both sides are shuffled by the join itself and a hot part can be split
    key = F.struct(*place, "__part").alias("__at")
    values = [c for c in intervals.columns if c not in keys]
    found = asked.select(key, ts).join(dealt.select(key, *values), "__at")
    inside = found.filter((F.col(start) <= F.col(ts)) & (F.col(ts) <= F.col(end)))
    return inside.select(*[F.col("__at")[k].alias(k) for k in keys], ts, *values)


def first_interval_at(
    times: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    ts: str = "charttime",
    start: str = "starttime",
    end: str = "endtime",
    columns: list[str] | None = None,
) -> DataFrame:
    """Every distinct (keys, time): number of intervals around it (``n_intervals``), and the earliest one of them.

    The earliest has the lowest start, then end, then further columns; its columns are null if there is none.
    """
    kept = [start, end, *(c for c in columns or [] if c not in (start, end))]
    asked = cut_lineage(times.select(*keys, ts).distinct())
    matches = _matches(asked.dropna(), intervals.select(*keys, *kept), keys, ts, start, end)
    first = matches.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("n_intervals"), F.min(F.struct(*kept)).alias("__first"))
    joined = attach(asked, first, [*keys, ts], "left")
    return joined.select(*keys, ts, F.coalesce("n_intervals", F.lit(0)).alias("n_intervals"), *[F.col("__first")[c].alias(c) for c in kept])
