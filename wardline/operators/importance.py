"""Importance of features, rolled up from the positions of a flat step x feature vector."""

from __future__ import annotations

from pyspark.ml.linalg import Vector, Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def position_values(spark: SparkSession, values: Vector, features: list[str]) -> DataFrame:
    """(step, feature, value) of a model's vector; its length is fixed by the feature layout."""
    data = [float(v) for v in values.toArray()]
    frame = spark.createDataFrame(list(enumerate(data)), "pos int, value double")
    names = F.array(*[F.lit(f) for f in features])
    width = F.lit(len(features))
    feature = F.element_at(names, (F.pmod(F.col("pos"), width) + F.lit(1)).cast("int"))
    return frame.select(F.floor(F.col("pos") / width).alias("step"), feature.alias("feature"), "value")


def total_importance(positions: DataFrame) -> DataFrame:
    """Sum over the steps (tree importances)."""
    return positions.groupBy("feature").agg(F.sum("value").alias("importance"))


def signed_odds(positions: DataFrame) -> DataFrame:
    """Mean odds ratio over the steps, with the sign of the mean coefficient (+ for zero)."""
    sign = F.when(F.avg("value") < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    return positions.groupBy("feature").agg((F.avg(F.exp("value")) * sign).alias("importance"))


def linear_attribution(df: DataFrame, coefficients: Vector, features: list[str], vector: str = "features") -> DataFrame:
    """Mean attribution per feature of a linear model against the zero baseline.

    Attribution of a position is coefficient times value, so the mean over rows is the coefficient
    times the mean vector, which Spark sums up in a tree.
    """
    mean = df.select(Summarizer.mean(F.col(vector)).alias("m")).first()["m"]
    products = Vectors.dense(coefficients.toArray() * mean.toArray())
    return position_values(df.sparkSession, products, features).groupBy("feature").agg(F.avg("value").alias("importance"))


def top(importances: DataFrame, k: int = 10, absolute: bool = True) -> DataFrame:
    """The k largest by (absolute) importance; ties by name."""
    value: Column = F.abs("importance") if absolute else F.col("importance")
    return importances.orderBy(value.desc(), F.col("feature")).limit(k)
