"""Bringing several sources onto one (entity, time) axis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def merge_measure(
    base: DataFrame, base_column: str, other: DataFrame, other_column: str, keys: list[str], name: str
) -> DataFrame:
    """One measure recorded in two sources: distinct non-null values of both, joined back to base.

    ``base_column`` is replaced by ``name``; moments known only to the other source appear as new
    rows, and two values at one moment give two rows.
    """
    values = (
        base.select(*keys, F.col(base_column).alias(name))
        .unionByName(other.select(*keys, F.col(other_column).alias(name)))
        .filter(F.col(name).isNotNull())
        .distinct()
    )
    return base.drop(base_column).join(values, keys, "full")


def align(sources: list[DataFrame], keys: list[str] | list[list[str]], mode: str = "join") -> DataFrame:
    """Full outer alignment.

    ``join``: chained full joins; ``keys`` may differ per join, two rows of a source at one moment
    repeat the columns of the others. ``union``: one shuffle; two rows of a source at one moment become
    one with the highest value of each column. ``stacked``: one shuffle, and the rows of ``join``.
    """
    if mode == "stacked":
        if keys and isinstance(keys[0], list):
            raise ValueError("the stacked form takes one key list")
        return _align_stacked(sources, keys)
    if mode == "union":
        if keys and isinstance(keys[0], list):
            raise ValueError("the union form takes one key list")
        return _align_union(sources, keys)
    if mode != "join":
        raise ValueError(f"unknown alignment: {mode}")
    per_join = keys if keys and isinstance(keys[0], list) else [keys] * (len(sources) - 1)
    out = sources[0]
    for source, on in zip(sources[1:], per_join):
        out = out.join(source, on, "full")
    return out


def _align_stacked(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full join of all sources on the same keys by one exchange.

    The sources are stacked with their number and dealt out by the keys once. A moment with n1, n2, ... rows
    per source has the product of these as combinations (a source without rows counts once); each row takes
    the combinations with its own number, and these are put together. No rows are held in memory: windows
    and aggregation spill. Rows with a null key match nothing and stay as they are.
    """
    values = [[c for c in s.columns if c not in keys] for s in sources]
    types = [F.struct(*v) if v else F.struct(F.lit(True).alias("__present")) for v in values]
    empty = [s.select(t.alias("v")).schema["v"].dataType for s, t in zip(sources, types)]

    def lifted(i: int) -> DataFrame:
        columns = [types[k].alias(f"__{k}") if k == i else F.lit(None).cast(empty[k]).alias(f"__{k}") for k in range(len(sources))]
        return sources[i].select(*keys, F.lit(i).alias("__source"), *columns)

    stacked = reduce(lambda a, b: a.union(b), map(lifted, range(len(sources))))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    moment, own = Window.partitionBy(*keys), Window.partitionBy(*keys, "__source").orderBy("__source")
    counted = stacked.filter(known).repartition(*keys).withColumns(
        {f"__n{i}": F.greatest(F.count(F.col(f"__{i}")).over(moment), F.lit(1)) for i in range(len(sources))}
    )
    numbered = counted.withColumn("__row", F.row_number().over(own) - 1)
    # the combinations are the numbers below the product; the rows of the sources are their digits
    before = [reduce(lambda a, b: a * b, [F.col(f"__n{k}") for k in range(i)], F.lit(1).cast("bigint")) for i in range(len(sources) + 1)]
    low, count, high = (_by_source(c) for c in (before[:-1], [F.col(f"__n{i}") for i in range(len(sources))], before[1:]))
    inner = F.sequence(F.lit(0).cast("bigint"), low - 1)
    outer = F.sequence(F.lit(0).cast("bigint"), F.floor(before[-1] / high) - 1)
    combos = F.flatten(F.transform(outer, lambda o: F.transform(inner, lambda i: i + low * F.col("__row") + o * low * count)))
    met = numbered.withColumn("__combo", F.explode(combos)).groupBy(*keys, "__combo")
    joined = met.agg(*[F.first(f"__{i}", ignorenulls=True).alias(f"__{i}") for i in range(len(sources))])
    whole = joined.drop("__combo").unionByName(stacked.filter(~known).drop("__source"))
    return whole.select(*keys, *[F.col(f"__{i}")[c].alias(c) for i, names in enumerate(values) for c in names])


def _by_source(choices: list[Column]) -> Column:
    return reduce(lambda out, i: F.when(F.col("__source") == i, choices[i]).otherwise(out), range(len(choices)), F.lit(None).cast("bigint"))


def _align_union(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])
