"""Long event log to wide table: harmonise codes, null implausible values, pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardline.functions.codes import CodeRule, labels_of, rules_frame
from wardline.operators.scans import attach

_AGGREGATES = {"min": F.min, "max": F.max, "mean": F.avg}


def harmonise(events: DataFrame, rules: list[CodeRule], code: str = "itemid", value: str = "valuenum") -> DataFrame:
    """Keep events with a known code, add label and label number, null implausible values, convert units.

    The rule table has one row per code, a fixed list, so it is always broadcast.
    """
    known = events.filter(F.col(code).isin([r.code for r in rules]))
    dim = F.broadcast(rules_frame(events.sparkSession, rules))
    raw = F.col(value)
    above = F.col("low").isNull() | (raw > F.col("low")) | (F.col("low_inclusive") & (raw == F.col("low")))
    below = F.col("high").isNull() | (raw < F.col("high")) | (F.col("high_inclusive") & (raw == F.col("high")))
    converted = F.when(F.col("fahrenheit"), (raw - F.lit(32.0)) / F.lit(1.8)).otherwise(raw)
    return (
        known.join(dim, known[code] == dim["code"])
        .withColumn(value, F.when(above & below, converted))
        .withColumnRenamed("rule_label", "label")
        .drop("code", "low", "high", "low_inclusive", "high_inclusive", "fahrenheit")
    )


def pivot_labels(
    events: DataFrame,
    keys: list[str],
    labels: dict[object, str],
    aggregates: list[str],
    label: str = "label",
    value: str = "valuenum",
) -> DataFrame:
    """One row per key, ``<name>_<aggregate>`` columns from a single partial aggregation.

    ``labels`` maps the values of the label column to names. Groups whose values are all null are
    kept.
    """

    def measure(found, name: str, aggregate: str) -> Column:
        return _AGGREGATES[aggregate](F.when(F.col(label) == found, F.col(value))).alias(f"{name}_{aggregate}")

    return events.groupBy(*keys).agg(*[measure(v, n, a) for v, n in labels.items() for a in aggregates])


def pivot_events(
    events: DataFrame,
    rules: list[CodeRule],
    keys: list[str],
    aggregates: list[str],
    code: str = "itemid",
    value: str = "valuenum",
) -> DataFrame:
    judged = harmonise(events, rules, code, value)
    # comparing numbers: every row is compared with every label
    return pivot_labels(judged, keys, dict(enumerate(labels_of(rules))), aggregates, "label_number", value)


def left_join_groups(entities: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Left outer join of entities with already aggregated groups.

    Written as inner join plus unmatched entities: then a key with very many groups can be spread,
    which an outer join preserving the other side does not allow.
    """
    entities = entities.distinct()
    matched = attach(groups, entities, keys)
    unmatched = entities.join(groups.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
