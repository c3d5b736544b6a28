"""Grid rows to fixed-size sequences, flat vectors and length-sorted batches."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardline.operators.scans import number_rows
from wardline.sources.tables import cut_lineage


def to_sequences(grid: DataFrame, key: str, ts: str, features: list[str], carry: list[str] | None = None) -> DataFrame:
    """(key, seq): all of the entity's rows in time order as an array of feature arrays.

    ``grid`` has one row per entity and step, so a sequence is bounded by the entity's span. ``carry``
    columns hold one value per entity.
    """
    row = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    ordered = F.array_sort(F.collect_list(F.struct(F.col(ts).alias("ts"), row.alias("x"))))
    return grid.groupBy(key).agg(
        F.transform(ordered, lambda s: s["x"]).alias("seq"), *[F.max(c).alias(c) for c in carry or []]
    )


def longest(sequences: DataFrame, seq: str = "seq") -> int:
    """Rows of the longest sequence, over all entities; runs at once."""
    return sequences.agg(F.coalesce(F.max(F.size(seq)), F.lit(0))).first()[0]


def sequence_shape(sequences: DataFrame, seq: str = "seq") -> DataFrame:
    """Sequences, longest sequence, features per step."""
    return sequences.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.max(F.size(seq)).alias("steps"),
        F.max(F.size(F.col(seq)[0])).alias("features"),
    )


def pad(seq: Column, steps: Column, width: int, fill: float = 0.0) -> Column:
    """Extend a sequence to ``steps`` rows of ``fill``; a longer one is an error."""
    blank = F.array(*[F.lit(float(fill))] * width)
    padded = F.concat(seq, F.array_repeat(blank, steps - F.size(seq)))
    too_long = F.raise_error(F.concat(F.lit("a sequence has more steps than "), steps.cast("string")))
    return F.when(F.size(seq) > steps, too_long.cast("array<array<double>>")).otherwise(padded)


def flatten_padded(sequences: DataFrame, steps: int | Column, width: int, fill: float = 0.0, name: str = "flat") -> DataFrame:
    """Step-major flat array of ``steps * width`` values."""
    steps = F.lit(steps) if isinstance(steps, int) else steps
    return sequences.withColumn(name, F.flatten(pad(F.col("seq"), steps, width, fill)))


def to_vectors(
    grid: DataFrame,
    key: str,
    ts: str,
    features: list[str],
    steps: int | None = None,
    carry: list[str] | None = None,
    fill: float = 0.0,
) -> DataFrame:
    """(key, features, carried columns): flat vectors, stored sparse where that is smaller.

    Without ``steps`` all vectors are as long as the longest sequence, which is looked up at once; a
    sequence longer than given ``steps`` is an error.
    """
    sequences = to_sequences(grid, key, ts, features, carry)
    if steps is None:
        sequences = cut_lineage(sequences)
        steps = longest(sequences)
    flat = flatten_padded(sequences, steps, len(features), fill).withColumn("__dense", array_to_vector("flat"))
    assembler = VectorAssembler(inputCols=["__dense"], outputCol="features")
    sized = assembler.transform(_with_size(flat, steps * len(features)))
    return sized.select(key, *(carry or []), "features")


def _with_size(flat: DataFrame, size: int) -> DataFrame:
    """Declare the vector size, which otherwise is looked up by running the query."""
    meta = {"ml_attr": {"num_attrs": size}}
    return flat.withColumn("__dense", F.col("__dense").alias("__dense", metadata=meta))


def batch_positions(sequences: DataFrame, key: str, size: int) -> DataFrame:
    """(key, length, position, batch, batch_steps): batches of ``size`` sequences, longest first.

    The position of a sequence is its rank by (length descending, key), for keys of any type.
    """
    lengths = sequences.select(key, F.size("seq").alias("length"))
    ranked = number_rows(lengths, [F.col("length").desc(), F.col(key).asc()], "position")
    batched = ranked.withColumn("batch", F.floor((F.col("position") - F.lit(1)) / F.lit(size)))
    # a batch has ``size`` rows
    return batched.withColumn("batch_steps", F.max("length").over(Window.partitionBy("batch")))


def length_batches(sequences: DataFrame, key: str, size: int, width: int, fill: float = 0.0) -> DataFrame:
    """Sequences with their batch, each padded to the longest sequence of the batch.

    Only the lengths are ranked; the sequences, which are stored, meet their batch by key.
    """
    sequences = cut_lineage(sequences)
    placed = sequences.join(batch_positions(sequences, key, size), key)
    return placed.withColumn("seq", pad(F.col("seq"), F.col("batch_steps"), width, fill))
