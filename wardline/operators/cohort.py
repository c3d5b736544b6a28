"""Choosing entities and rows: eligibility, age, observed span, samples and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardline.functions.columns import any_present, days_between, micros_between
from wardline.operators.scans import attach, rank_rows
from wardline.sources.tables import cut_lineage

_DAY_MICROS = 86_400_000_000


def eligible_entities(stages: DataFrame, measures: list[str], label: str, key: str) -> DataFrame:
    """Entities with at least one row that has a measurement and a label."""
    return stages.filter(any_present(*measures) & F.col(label).isNotNull()).select(key).distinct()


def keep_entities(df: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    return attach(df, entities.select(key).distinct(), [key], "left_semi")


def drop_entities(df: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    return attach(df, entities.select(key).distinct(), [key], "left_anti")


def extract_cohort(
    tables: dict[str, DataFrame], stages: DataFrame, measures: list[str], label: str, key: str
) -> dict[str, DataFrame]:
    """Restrict every table to the eligible entities, which are determined once."""
    chosen = cut_lineage(eligible_entities(stages, measures, label, key))
    return {name: keep_entities(df, chosen, key) for name, df in tables.items()}


def drop_any_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def drop_all_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(how="all", subset=columns)


def adults(detail: DataFrame, min_age: float, age: str = "age") -> DataFrame:
    return detail.filter(F.col(age) >= min_age)


def spans(df: DataFrame, key: str, ts: str) -> DataFrame:
    """First and last moment per entity and the days between them, rounded to 4 digits."""
    return (
        df.groupBy(key)
        .agg(F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))
        .withColumn("span_days", days_between("first_time", "last_time"))
    )


def span_filter(
    df: DataFrame,
    key: str,
    ts: str,
    min_days: float,
    max_days: float | None = None,
) -> DataFrame:
    """Drop entities observed for less than ``min_days``; keep the last ``max_days`` of the others.

    After trimming the span is checked once more. Spans come from aggregations, not from windows:
    the rows of an entity need not meet in one task. ``df`` is read several times.
    """
    kept = spans(df, key, ts).filter(F.col("span_days") >= min_days)
    if max_days is None:
        return keep_entities(df, kept, key)
    last = F.col("last_time")
    late = F.when(F.col("span_days") <= max_days, F.lit(True)).otherwise(_not_older(F.col(ts), last, max_days))
    dated = attach(df, kept.select(key, "last_time", "span_days"), [key], "inner")
    trimmed = dated.filter(late).drop("last_time", "span_days")
    still_long = spans(trimmed, key, ts).filter(F.col("span_days") >= min_days)
    return keep_entities(trimmed, still_long, key)


def trim_last_days(df: DataFrame, key: str, ts: str, days: float) -> DataFrame:
    """Keep the rows at most ``days`` before the entity's last one."""
    last = df.groupBy(key).agg(F.max(ts).alias("last_time"))
    return attach(df, last, [key], "inner").filter(_not_older(F.col(ts), F.col("last_time"), days)).drop("last_time")


def _not_older(ts: Column, last: Column, days: float) -> Column:
    return micros_between(ts, last) <= F.lit(int(days * _DAY_MICROS))


def ranked_entities(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Distinct entities in a reproducible pseudo-random order: key, position (from 1), total."""
    entities = df.select(key).distinct().filter(F.col(key).isNotNull())
    shuffled = entities.withColumn("__hash", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))
    # the first three hex digits make 4096 even cells
    cell = F.substring("__hash", 1, 3)
    return rank_rows(shuffled, [], cell, [F.col("__hash"), F.col(key)], "position", total="total").drop("__hash")


def split_entities(df: DataFrame, key: str, holdout: float = 0.2, test_share: float = 0.5, seed: int = 42) -> DataFrame:
    """(key, split): exact shares of entities for train, valid and test."""
    held = F.ceil(F.lit(holdout) * F.col("total"))
    tested = F.ceil(F.lit(test_share) * held)
    train_end = F.col("total") - held
    name = (
        F.when(F.col("position") <= train_end, "train")
        .when(F.col("position") <= F.col("total") - tested, "valid")
        .otherwise("test")
    )
    return ranked_entities(df, key, seed).select(key, name.alias("split"))


def assign_split(
    df: DataFrame,
    key: str,
    holdout: float = 0.2,
    test_share: float = 0.5,
    seed: int = 42,
) -> DataFrame:
    return attach(df, split_entities(df, key, holdout, test_share, seed), [key], "inner")


def sample_entities(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """All rows of the given share of entities."""
    chosen = ranked_entities(df, key, seed).filter(F.col("position") > F.col("total") - F.ceil(F.lit(fraction) * F.col("total")))
    return keep_entities(df, chosen, key)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
