"""Near-duplicates by SuperMinHash, banding, verification and union-find.

* A text's set is its distinct shingles (of two words, unless given), as 64-bit hashes. Texts with equal sets form one
  class, of which one text goes on.
* SuperMinHash: every element meets every component once, in the order of a permutation of its own;
  level j adds j to the element's random number. The ranks are correlated, which lowers the variance
  of small sets, and a set is finished as soon as no component can get lower.
* Bands of components give buckets. Members of a bucket are tied to its first member only, so a
  bucket of any size makes no pairs; connected buckets form coarse clusters.
* In a cluster, links are confirmed on the full sets. Members that are in one group already are not
  compared. Clusters above a size are cut into blocks, and a table of sets holds two blocks at most.
  One block of members outside a cluster's largest group, then two, then four and so on, is compared
  with all blocks; in between the links found are united to groups. It ends when every member outside
  the largest group was compared with all others, so no link is lost. Near copies of one text are one
  group after the first round, in which every member is copied about once.
* Confirmed links, at most one a member and table, are united to groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wardline.llm.common import Stored, give_back, pick, rows_of, utf8

SHINGLE = 2
SIMILARITY = 80  # percent
COMPONENTS = 256
# A pair at the similarity of 0.8 is missed by all bands with a probability of 3e-6.
BANDS, BAND_ROWS = 42, 6
# Shingles of a block; a table of sets holds two blocks.
BLOCK_SHINGLES = 1 << 19
MAX_ROUNDS = 60

_LOWER = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ x >> np.uint64(30)) * _MIX1
    x = (x ^ x >> np.uint64(27)) * _MIX2
    return x ^ x >> np.uint64(31)


def shingles(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a text of fewer words is one shingle, none without words."""
    words = utf8(text).translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(values) - size + 1, np.uint64(size))
    for i in range(size):
        out = mixed(out * _GOLDEN + values[i : len(values) - size + 1 + i])
    return np.unique(out)


def super_minhash(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, COMPONENTS) ranks: the level in the upper 32 bits, the random number in the lower."""
    out = np.full((len(sets), COMPONENTS), np.uint64(2**64 - 1))
    flat = out.reshape(-1)
    x = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keys = mixed(x ^ _GOLDEN)
    last = COMPONENTS - 1
    part = [(keys >> np.uint64(8 * i)).astype(np.uint32) & np.uint32(last) for i in range(7)]
    check = 0
    for level in range(COMPONENTS):
        # the place of this level in the element's permutation: steps that can each be undone
        y = np.uint32(level) ^ part[0]
        y = (y * (part[1] | np.uint32(1)) + part[2]) & np.uint32(last)
        y ^= y >> np.uint32(4)
        y = (y * (part[3] | np.uint32(1)) + part[4]) & np.uint32(last)
        y ^= y >> np.uint32(5)
        y = (y * (part[5] | np.uint32(1)) + part[6]) & np.uint32(last)
        rank = mixed(x + np.uint64((level + 1) * int(_GOLDEN) % 2**64)) >> np.uint64(32) | np.uint64(level << 32)
        np.minimum.at(flat, owner * COMPONENTS + y, rank)
        if level >= check:
            check = level + 1 + level // 4
            finished = out.max(axis=1) < np.uint64((level + 1) << 32)
            if finished.all():
                break
            going = ~finished[owner]
            if not going.all():
                x, owner, part = x[going], owner[going], [p[going] for p in part]
    return out


def band_hashes(ranks: np.ndarray) -> np.ndarray:
    """(sets, BANDS) signed hashes, different for every band."""
    rows = ranks[:, : BANDS * BAND_ROWS].reshape(len(ranks), BANDS, BAND_ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX1, rows.shape[:2])
    for i in range(BAND_ROWS):
        out = mixed(out * _GOLDEN + rows[:, :, i])
    return out.view(np.int64)


def id_or_lowest(doc_id: Column) -> Column:
    """The id as a key that is never null."""
    return F.coalesce(doc_id.cast("bigint"), F.lit(-(2**63)))


def fingerprint(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def sign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Per row ``doc_id, fingerprint`` (of the text), ``n_shingles, key`` (of the set, null if empty) and ``bands``."""
    kept = pick(docs, doc_id=F.col(doc_id).cast("bigint"), text=F.col(text).cast("string"))
    kept = kept.select("doc_id", fingerprint(F.col("text")).alias("fingerprint"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            hashes = WordHashes()
            sets = [shingles(t, hashes, size) for t in batch.column(2).to_pylist()]
            for at in range(0, len(sets), 2000):
                some = sets[at : at + 2000]
                filled = [s for s in some if len(s)]
                bands = iter(band_hashes(super_minhash(filled)) if filled else ())
                rows = [next(bands) if len(s) else None for s in some]
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in some]
                n = pa.array([len(s) for s in some], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(some)), batch.column(1).slice(at, len(some)), n,
                        pa.array(keys, pa.binary()), pa.array(rows, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "fingerprint", "n_shingles", "key", "bands"],
                )

    return kept.mapInArrow(run, "doc_id bigint, fingerprint bigint, n_shingles bigint, key binary, bands array<bigint>")


def components(links: DataFrame) -> Stored:
    """Groups of linked nodes: a row ``a, b`` for every node but the smallest of its group, which is b.

    ``links`` has two bigint columns a and b. Nodes are tied to ever smaller neighbours, in turns to
    those of larger and of smaller number, until every group is a star; a hot node is the centre of
    rows that are joined with a single row, which Spark can split.
    """
    edges = Stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        state = edges.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return edges
        before = state
        both = edges.df.union(edges.df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # stored, so that both sides of the join are shuffled by it and Spark can split a hot centre
        least = Stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(least.df, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = Stored(large.distinct())
        lower = Stored(larger.df.groupBy("a").agg(F.min("b").alias("m")))
        small = larger.df.join(lower.df, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = Stored(small.union(lower.df).distinct())
        for made in (edges, least, larger, lower):
            made.delete()
        edges = after
    raise RuntimeError("groups did not settle")


def link(groups: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Ties of groups (of two sets each), so that nodes with linked sets are in one group.

    Nodes of equal ``groups`` are in one group already. A node is compared with the nodes of all other
    groups, until only the largest group has nodes that were not compared.
    """
    sizes = np.array([len(s) for s in sets])
    names, place = np.unique(np.concatenate(sets), return_inverse=True)
    holder = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(place, kind="stable")
    held = holder[order]
    counts = np.bincount(place, minlength=len(names))
    starts = np.cumsum(counts) - counts
    own = np.split(place, np.cumsum(sizes)[:-1])
    label = np.unique(groups, return_inverse=True)[1]
    fresh = np.ones(len(sets), bool)
    ties = []
    while (left := fresh & (label != np.bincount(label).argmax())).any():
        u = left.argmax()
        fresh[u] = False
        at, n = starts[own[u]], counts[own[u]]
        ends = np.cumsum(n)
        rows = held[np.arange(ends[-1]) + np.repeat(at - ends + n, n)]
        common = np.bincount(rows, minlength=len(sets))
        near = np.flatnonzero((label != label[u]) & (100 * common >= SIMILARITY * (sizes + sizes[u] - common)))
        for v in near:
            if label[v] != label[u]:
                ties.append((int(groups[u]), int(groups[v])))
                label[label == label[v]] = label[u]
    return ties


def _link_units(table: pa.Table) -> pa.Table:
    """Links of all units of a table; a unit is a cluster, or a block or two of one."""
    out: list[tuple[int, int]] = []
    root, node, group = (table.column(c).to_numpy() for c in ("root", "node", "group"))
    elements = table.column("elements")
    order = np.lexsort((node, root))
    for unit in np.split(order, np.flatnonzero(np.diff(root[order])) + 1):
        # a text that is there several times has the same node
        unit = unit[np.append(True, np.diff(node[unit]) != 0)]
        if len(unit) > 1:
            out += link(group[unit], [np.frombuffer(elements[int(i)].as_py(), np.uint64) for i in unit])
    give_back()
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def link_blocks(sets: DataFrame, members: DataFrame, block_shingles: int) -> Stored:
    """Links of clusters of several blocks: a row ``a, b`` for every node but the smallest of its group, which is b.

    ``members`` has ``node, root, n``, ``sets`` has ``node, elements``. A node is done once it was compared
    with all others of its cluster.
    """
    state = Stored(members.select("node", "root", "n", F.col("node").alias("group"), F.lit(False).alias("done")))
    hubs = 1
    while True:
        by_group = Stored(state.df.groupBy("root", "group").agg(F.sum("n").alias("n")))
        heart = by_group.df.groupBy("root").agg(F.max(F.struct("n", "group")).alias("h")).select("root", F.col("h.group").alias("heart"))
        hearts = Stored(heart)
        marked = Stored(state.df.filter("not done").join(hearts.df, "root").withColumn("rest", F.col("group") != F.col("heart")).drop("heart"))
        rest = F.sum(F.when(F.col("rest"), F.col("n")).otherwise(0))
        blocks = marked.df.groupBy("root").agg(rest.alias("r"), F.sum("n").alias("t")).filter("r > 0")
        blocks = blocks.withColumn("rests", F.ceil(F.col("r") / F.lit(block_shingles)).cast("int"))
        blocks = blocks.withColumn("hubs", F.least("rests", F.lit(hubs)))
        others = F.ceil((F.col("t") - F.col("r") * F.col("hubs") / F.col("rests")) / F.lit(block_shingles))
        plan = Stored(blocks.select("root", "rests", "hubs", F.greatest(F.lit(1), others).cast("int").alias("others")))
        some = plan.df.count()
        if some:
            # hubs have the first blocks and meet all blocks, other nodes meet the hubs
            h = F.xxhash64("node", F.lit(hubs))
            hub = F.col("rest") & (F.pmod(h, F.col("rests")) < F.col("hubs"))
            placed = marked.df.join(plan.df, "root").withColumn("hub", hub)
            first, second = F.pmod(h, F.col("rests")), F.col("hubs") + F.pmod(F.xxhash64(h), F.col("others"))
            dealt = Stored(placed.withColumn("block", F.when(F.col("hub"), first).otherwise(second)))
            other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(F.col("hub"), F.col("hubs") + F.col("others")).otherwise(F.col("hubs")) - 1))
            units = (
                sets.join(dealt.df, "node")
                .select("root", "node", "group", "elements", "block", other.alias("other"))
                .select("root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "group", "elements")
            )
            links = Stored(units.groupBy("root", "low", "high").applyInArrow(_link_units, "a bigint, b bigint"))
            up = components(links.df)
            met = dealt.df.filter("hub").select("node", F.lit(True).alias("met"))
            after = state.df.join(up.df.select(F.col("a").alias("group"), F.col("b").alias("up")), "group", "left").join(met, "node", "left")
            after = Stored(after.select("node", "root", "n", F.coalesce("up", "group").alias("group"), (F.col("done") | F.col("met").isNotNull()).alias("done")))
            for made in (state, dealt, links, up):
                made.delete()
            state = after
            hubs *= 2
        for made in (by_group, hearts, marked, plan):
            made.delete()
        if not some:
            found = Stored(state.df.filter("node <> group").select(F.col("node").alias("a"), F.col("group").alias("b")))
            state.delete()
            return found


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_shingles: int = BLOCK_SHINGLES, size: int = SHINGLE
) -> DataFrame:
    """Per row ``doc_id, fingerprint, n_shingles, component_id, root``.

    ``component_id`` is the smallest doc_id of the group; a text without words is a group of its own.
    Rows without doc_id take part, but their id is the smallest of a group only if it has no other.
    Repeated rows and equal texts are in one group. Other columns are not read. ``root`` names the
    group (null without words). ``size`` is the number of words of a shingle.
    """
    signed = Stored(sign(docs, doc_id, text, size))
    rows = signed.df.select("doc_id", "fingerprint", "n_shingles", "key")
    by_key = signed.df.filter("n_shingles > 0").groupBy("key")
    # the row whose text stands for the class: the one with the smallest id, if any has one
    first = F.min(F.struct(F.col("doc_id").isNull(), id_or_lowest(F.col("doc_id")).alias("id"), F.col("fingerprint").alias("print")))
    found = by_key.agg(F.min("doc_id").alias("rep"), first.alias("first"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands"))
    # the numbers of the classes are kept by storing them
    classes = Stored(found.withColumn("node", F.monotonically_increasing_id()))

    bands = classes.df.select("node", F.explode("bands").alias("band"))
    buckets = Stored(bands.groupBy("band").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    stars = bands.join(buckets.df, "band").select(F.col("node").alias("a"), F.col("first").alias("b"))
    coarse = components(stars)
    buckets.delete()
    inside = coarse.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
    inside = inside.union(coarse.df.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    members = Stored(classes.df.select("node", "key", "first.id", "first.print", "n").join(inside, "node"))
    coarse.delete()

    # what is joined by root is stored before, so that Spark can split a hot group
    weights = Stored(members.df.groupBy("root").agg(F.sum("n").alias("weight")))
    total, largest = weights.df.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.coalesce(F.max("weight"), F.lit(0))).first()
    bins = 1 + total // block_shingles
    placed = members.df.join(weights.df, "root")
    # rows with one id, or none, are told apart by their fingerprint; of equal ones one text is enough
    source = pick(docs, id=id_or_lowest(F.col(doc_id)), print=fingerprint(F.col(text)), text=F.col(text).cast("string"))
    # the same plan at every size: texts are shuffled to the members, however few these are
    met = source.join(placed.hint("merge"), ["id", "print"]).dropDuplicates(["id", "print", "node"])
    texts = met.select("key", "node", "root", "weight", "text")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            hashes = WordHashes()
            sets = [shingles(t, hashes, size).tobytes() for t in batch.column(4).to_pylist()]
            # another text with the same fingerprint is not the one that was signed
            same = [xxhash.xxh3_128_digest(s) == k for s, k in zip(sets, batch.column(0).to_pylist(), strict=True)]
            columns = [*batch.columns[1:4], pa.array(sets, pa.binary())]
            names = ["node", "root", "weight", "elements"]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(same, pa.bool_()))

    sets = Stored(texts.mapInArrow(sets_of, "node bigint, root bigint, weight bigint, elements binary"))
    # a cluster of an eighth of a block is a table of its own, smaller ones share tables
    bin = F.when(F.col("weight") * 8 > block_shingles, F.col("root")).otherwise(-1 - F.pmod(F.xxhash64("root"), F.lit(bins)))
    units = sets.df.filter(F.col("weight") <= block_shingles).select(bin.alias("bin"), "root", "node", F.col("node").alias("group"), "elements")
    links = Stored(units.groupBy("bin").applyInArrow(_link_units, "a bigint, b bigint"))
    if largest > block_shingles:
        large = members.df.join(weights.df.filter(F.col("weight") > block_shingles), "root")
        whole = link_blocks(sets.df.select("node", "elements"), large, block_shingles)
        groups = components(links.df.union(whole.df))
        whole.delete()
    else:
        groups = components(links.df)
    sets.delete()
    links.delete()

    # members that were not linked, and classes outside all clusters, are groups of their own
    tied = classes.df.select("key", "rep", "node").join(groups.df.select(F.col("a").alias("node"), F.col("b").alias("up")), "node", "left")
    tied = tied.withColumn("root", F.coalesce("up", "node"))
    lowest = Stored(tied.groupBy("root").agg(F.min("rep").alias("component_id")))
    named = Stored(tied.join(lowest.df, "root").select("key", "root", "component_id"))
    for made in (members, weights, lowest, groups, classes):
        made.delete()
    columns = ["doc_id", "fingerprint", "n_shingles", "component_id", "root"]
    empty = rows.filter("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "root": F.lit(None).cast("bigint")})
    return rows.filter("n_shingles > 0").join(named.df, "key").select(*columns).union(empty.select(*columns))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One document of each group, all columns as they were; texts without words all stay.

    The document with the smallest doc_id stays; of several texts under that id the one with the lowest
    fingerprint, of several rows with that text the one that a hash of the whole row puts first, so
    reruns agree. Groups without any id keep one row; an empty table gives none.
    """
    found = near_duplicates(docs, doc_id, text, size=size)
    single = (
        found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("root").isNotNull())
        .groupBy("root")
        .agg(F.min(F.struct(id_or_lowest(F.col("doc_id")).alias("__id"), F.col("fingerprint").alias("__print"))).alias("k"))
        .select("k.*")
    )
    # the same columns place the rows for the join and for the choice of one of them, which depends on the whole row
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.select(whole.alias("d"), id_or_lowest(F.col(doc_id)).alias("__id"), fingerprint(F.col(text)).alias("__print"))
    chosen = F.min_by("d", F.struct(F.xxhash64(F.to_json("d")), F.to_json("d"))).alias("d")
    one = marked.join(single, ["__id", "__print"]).groupBy("__id", "__print").agg(chosen)
    blank = ~F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return one.select("d.*").union(docs.filter(blank))
