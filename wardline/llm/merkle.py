"""A Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf. The leaves of a source ascend by id and are cut into aligned blocks of
``fanout ** levels``; a block is what a partition of a distributed tree holds, and it builds its own
subtree. Then the blocks go through rounds. In round r a block of a source stands for the node over
the ``fanout ** r`` blocks around it, and aligned groups of fanout such nodes swap: each block sends
its node to the blocks at its own offset in the other nodes of the group (where the last node is
smaller, its blocks send to several). All blocks of the group hash the same parent, and each has
the siblings on its way up. After the last round every block knows the whole upper part of its
proof, so nothing is passed down again. The sources' roots go through the same rounds.

All of it is DataFrame functions. A block is one row of a table, a message is one row of a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardline.llm.common import Stored, lower_ascii, pick, store
from wardline.operators.scans import number_rows

FANOUT = 16
LEVELS = 2
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*values: Column) -> Column:
    return digest(F.concat(*map(field, values)))


def _parents(nodes: Column, fanout: int) -> Column:
    """Digests of runs of ``fanout`` nodes; the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * fanout + 1, F.lit(fanout)), "")))


def _siblings(nodes: Column, at: Column, fanout: int) -> Column:
    """What stands left and right of node ``at`` in its run, concatenated."""
    first = at - at % fanout
    left = F.array_join(F.slice(nodes, first + 1, at - first), "")
    right = F.array_join(F.slice(nodes, at + 2, first + fanout - at - 1), "")
    return F.struct(left.alias("left"), right.alias("right"))


def butterfly(nodes: DataFrame, largest: int, fanout: int = FANOUT) -> DataFrame:
    """Rounds of exchange over ``key, at, n, node``: n nodes of a key, numbered from 0.

    Gives ``key, at, root, upper``: the key's root and, level by level, the siblings (left, right) on the
    way to it. ``largest`` is the greatest n. A round shuffles at most ``fanout`` messages for each node.
    """
    state = nodes.withColumn("upper", F.expr("cast(array() as array<struct<left:string,right:string>>)"))
    width = 1
    while width < largest:
        size = lambda q, w=width: F.least(F.lit(w), F.col("n") - q * w)
        own, offset = F.floor(F.col("at") / width), F.col("at") % width
        first = own - own % fanout
        last = F.least(first + fanout - 1, F.floor((F.col("n") - 1) / width))
        reached = F.filter(F.sequence(first, last), lambda q: size(q) > offset)
        targets = F.flatten(F.transform(reached, lambda q: F.sequence(q * width + offset, q * width + size(q) - 1, size(own))))
        sent = state.select(
            "key", "n", F.explode(targets).alias("to"), "at", own.alias("q"), "node", "upper"
        )
        mine = F.max(F.when(F.col("at") == F.col("to"), F.struct("q", "upper")))
        group = sent.groupBy("key", "n", "to").agg(F.array_sort(F.collect_list(F.struct("q", "node"))).alias("group"), mine.alias("mine"))
        side = lambda keep: F.array_join(F.transform(F.filter("group", keep), lambda g: g["node"]), "")
        left, right = side(lambda g: g["q"] < F.col("mine.q")), side(lambda g: g["q"] > F.col("mine.q"))
        parent = digest(F.array_join(F.transform("group", lambda g: g["node"]), ""))
        level = F.array(F.struct(left.alias("left"), right.alias("right")))
        up = F.col("n") > width
        state = group.select(
            "key",
            F.col("to").alias("at"),
            "n",
            F.when(up, parent).otherwise(F.col("group")[0]["node"]).alias("node"),
            F.when(up, F.concat("mine.upper", level)).otherwise(F.col("mine.upper")).alias("upper"),
        )
        width *= fanout
    return state.select("key", "at", F.col("node").alias("root"), "upper")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof give."""
    return F.aggregate(proof, leaf, lambda h, s: digest(F.concat(s["left"], h, s["right"])))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""))


def build(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The tree over ``source, id, leaf`` (and ``seen``, a leaf to be held against the root): a row per leaf.

    Sources are ordered bytewise, null first; leaves by id, null first, then by digest. Gives these columns
    with ``subroot``, ``root`` and ``proof``, an array of (left, right) from the leaf's level to the root.
    An empty table gives none.
    """
    key = F.struct(F.col("source").isNotNull().alias("some"), F.coalesce("source", F.lit("")).alias("name"))
    order = ["key", "id", "leaf", "seen"]
    narrow = store(leaves.select(key.alias("key"), "id", "leaf", "seen"))
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    rows = Stored(dealt).df.withColumn("task", F.shiftright("row", 33))
    cells = rows.groupBy("key", "task").agg(F.count(F.lit(1)).alias("k"), F.min("row").alias("first"))
    before = Window.partitionBy("key").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = cells.select(
        "key", "task", (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first")).alias("base"),
        F.sum("k").over(Window.partitionBy("key")).alias("count"),
    )
    span = fanout**levels
    placed = rows.join(base, ["key", "task"]).withColumn("place", F.col("base") + F.col("row"))
    grouped = placed.groupBy("key", F.floor(F.col("place") / span).alias("at"), "count").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "leaf", "seen"))).alias("leaves")
    )
    nodes = grouped.withColumn("level0", F.transform("leaves", lambda x: x["leaf"]))
    for j in range(levels):
        above = _parents(F.col(f"level{j}"), fanout)
        nodes = nodes.withColumn(f"level{j + 1}", F.when(F.col("count") > fanout**j, above).otherwise(F.col(f"level{j}")))
    nodes = nodes.withColumns({"n": F.ceil(F.col("count") / span), "node": F.element_at(f"level{levels}", 1)})
    blocks = Stored(nodes.drop(f"level{levels}"))
    most = blocks.df.agg(F.max("n")).first()[0] or 0
    known = Stored(butterfly(blocks.df.select("key", "at", "n", "node"), most, fanout)).df
    sources = number_rows(known.filter("at = 0").select("key", F.col("root").alias("node")), [F.col("key")], "place")
    tops = Stored(sources.select("key", (F.col("place") - 1).alias("at"), "node"))
    n = tops.df.count()
    one = tops.df.select(F.lit(0).alias("key"), "at", F.lit(n).cast("bigint").alias("n"), "node")
    over = butterfly(one, n, fanout).select("at", F.col("root").alias("top"), F.col("upper").alias("last"))
    over = tops.df.join(over, "at").select("key", "top", "last")
    told = known.join(over, "key").select("key", "at", F.col("root").alias("subroot"), "top", F.concat("upper", "last").alias("upper"))
    spread = blocks.df.join(told, ["key", "at"]).select("*", F.posexplode("leaves").alias("i", "one"))
    proof = F.col("upper")
    for j in reversed(range(levels)):
        mine = F.floor(F.col("i") / fanout**j).cast("int")
        step = F.array(_siblings(F.col(f"level{j}"), mine, fanout))
        proof = F.when(F.col("count") > fanout**j, F.concat(step, proof)).otherwise(proof)
    return spread.select(
        F.when(F.col("key.some"), F.col("key.name")).alias("source"), F.col("one.id").alias("id"), F.col("one.leaf").alias("leaf"),
        F.col("one.seen").alias("seen"), "subroot", F.col("top").alias("root"), proof.alias("proof"),
    )


def manifest(
    docs: DataFrame, tampered: Column | None = None, columns: tuple[str, ...] = COLUMNS, fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """Leaves, roots and proofs of ``docs``: ``doc_id, source, leaf, seen, subroot, root, proof``.

    ``columns`` are hashed in that order; the first is the id, the second the source, the last the text.
    Nulls in any of them are part of the leaf; empty texts have length 0. Repeated rows are leaves of
    their own, next to each other. Where ``tampered`` holds (a condition on the id, named ``id``), ``seen``
    is the leaf of the text with A-Z in lower case, elsewhere the leaf. Other columns are not read.
    """
    names = [f"c{i}" for i in range(len(columns))]
    frame = pick(docs, **{n: F.col(f"`{c}`") for n, c in zip(names, columns, strict=True)}).withColumn("id", F.col("c0").cast("bigint"))
    values = [F.col(n) for n in names]
    changed = leaf_of(*values[:-1], lower_ascii(values[-1].cast("string")))
    honest = leaf_of(*values)
    seen = honest if tampered is None else F.when(tampered, changed).otherwise(honest)
    leaves = frame.select(F.col("c1").cast("string").alias("source"), "id", honest.alias("leaf"), seen.alias("seen"))
    return build(leaves, fanout, levels).withColumnRenamed("id", "doc_id")
