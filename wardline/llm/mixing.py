"""Mixing sources to target weights by systematic sampling.

Sources get targets by weight, none above a multiple of its size. A document's expected copies are
its source's target divided by its source's size. They are summed up within the source, in the
order of document size, with one random offset; a document is taken once for every integer boundary
its part of the sum crosses. Ordering by size spreads every size evenly, so the words taken come
near the target.

Only DataFrame functions are used. Prefix sums need no source in one task: the rows are sorted over
all tasks by (source, size, hash), a row's number in its task comes from the task itself, and only
one row per task and source is summed up in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardline.llm.common import pick, store, word_array

WEIGHTS = (3, 1, 2)
SEED = "mix"


def unit_hash(value: Column) -> Column:
    """A number in [0, 1) from 48 bits of an MD5."""
    return F.conv(F.substring(F.md5(value), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], cap: int) -> DataFrame:
    """Add ``target`` to one row per source (``src, source_size``).

    All targets come to ``share`` (a fraction) of all sizes. Weights repeat over the sources in
    order. Targets stop at ``cap`` times the source's size and the excess goes to the others by
    weight: with the sources ordered by size per weight, the first so many are at their cap and the
    rest share what is left.
    """
    n = len(weights)
    number = Window.orderBy("src")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(number) - 1, F.lit(n)) + 1).cast("int"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source_size") / F.col("w"), "src")
    until = order.rowsBetween(Window.unboundedPreceding, -1)
    num, den = share
    ranked = (
        sources.withColumn("w", weight.cast("bigint"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("capped", F.coalesce(F.sum("source_size").over(until), F.lit(0)) * cap)
        .withColumn("w_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(until), F.lit(0)))
        .withColumn("total", F.sum("source_size").over(every))
        # what is left per weight if all sources before this one are at their cap, times den and w_left
        .withColumn("left", F.col("total") * num - F.col("capped") * den)
    )
    # The first source that stays within its cap; those before it are at theirs.
    fits = F.col("left") * F.col("w") <= F.col("source_size") * cap * den * F.col("w_left")
    first = F.min(F.when(fits, F.struct("place", "left", "w_left"))).over(every)
    shared = (F.col("w") * F.col("f.left")).cast("double") / (F.col("f.w_left") * den).cast("double")
    within = F.col("f").isNotNull() & (F.col("place") >= F.col("f.place"))
    return ranked.withColumn("f", first).select(
        "src", "source_size", F.when(within, shared).otherwise((F.col("source_size") * cap).cast("double")).alias("target")
    )


def _plan(
    docs: DataFrame, carry: list[str], weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), cap: int = 2,
    seed: str = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The columns ``carry`` as c0, c1 and so on, then ``size, source_size, target, copies``."""
    kept = pick(
        docs,
        **{f"c{i}": F.col(f"`{c}`") for i, c in enumerate(carry)},
        src=F.struct(F.col(source).isNull().alias("none"), F.coalesce(F.col(source), F.lit("")).alias("name")),
        size=F.size(word_array(F.col(text))).cast("bigint"),
        id=F.col(doc_id).cast("bigint"),
    )
    order = ["src", "size", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))), "id"]
    rows = store(
        kept.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    ).withColumn("task", F.shiftright("row", 33))
    cells = rows.groupBy("src", "task").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"), F.min("row").alias("first"))
    known = targets(cells.groupBy("src").agg(F.sum("s").alias("source_size")), weights, share, cap)
    before = Window.partitionBy("src").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = cells.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).join(known, "src")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = unit_hash(F.concat(F.lit(seed + "/"), F.col("src.none").cast("string"), F.lit("/"), F.col("src.name")))
    parts = base.select("src", "task", "base", "source_size", "target", rate.alias("rate"), offset.alias("u"))
    place = F.col("base") + F.col("row")
    copies = F.floor(F.col("u") + (place + 1) * F.col("rate")) - F.floor(F.col("u") + place * F.col("rate"))
    names = [f"c{i}" for i in range(len(carry))]
    return rows.join(parts, ["src", "task"]).select(*names, "size", "source_size", "target", copies.alias("copies"))


def mixing_plan(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per row of ``docs``: ``doc_id, size, source_size, target, copies``.

    Null sources form one source, the last in order. Null and empty texts have no words; a source
    without words is not taken. Repeated rows are taken like any others; which of several equal rows
    is taken does not matter. The result depends on the rows and the seed only. An empty table gives
    an empty plan, and columns that are not named are not read.
    """
    return _plan(docs, [doc_id], doc_id=doc_id, **options).withColumnRenamed("c0", doc_id)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every document as often as it is taken, with the columns of ``docs``."""
    plan = _plan(docs, docs.columns, **options).filter(F.col("copies") > 0)
    repeated = plan.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return repeated.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
