"""Removal of long repeated strings by refining hashes of strings around anchors.

This replaces a merge of Burrows-Wheeler transforms: refined byte by byte, its interleave would need as
many passes over the corpus as the strings are long, 400. No transform and no interleave is built.

* Every string of 400 bytes has an anchor: the place of the smallest hash of eight bytes among the
  first places of the string. Equal strings have it at the same place, so only what stands around
  anchors needs to be compared. An anchor serves the strings that start in a short range before it.
* A shard (the texts a task reads together) names the part that all strings of an anchor share by its
  hash and counts equal names; they are sorted by name, not by characters.
* A round adds up the counts of equal names of all shards in a shuffle, and names that occur once
  leave. Only names and counts are exchanged. The named part grows from round to round: first the part
  all strings of an anchor share, then that with everything before and after it (then the whole range
  is repeated), then, for those that fall apart in this round, sixteen strings at a time, and last the
  single strings.

The rounds are a fixed number and each is partial aggregation and joins with one row per name, so a
string that every document holds is no hot spot. Names are hashes of 128 bits where they decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import Stored, pick, rows_of, utf8

LENGTH = 400
GRAM = 8
# An anchor is sought in so many first bytes of a string.
WINDOW = 160
# Strings that the last but one round takes together.
STEP = 16

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLES = [np.random.default_rng(seed).integers(0, 2**64 - 1, 256, np.uint64) for seed in (1, 2)]
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> _U(30)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ x >> _U(27)) * _U(0x94D049BB133111EB)
    return x ^ x >> _U(31)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept by the worker, and grown when a longer text comes."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(1 << 17, 2 * n)
        for name, factor in (("up", _BASE), ("down", _INVERSE)):
            _POWERS[name] = np.cumprod(np.append(_U(1), np.full(size, factor)), dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


class Prefixes:
    """Hashes of any part of a text, from running sums."""

    def __init__(self, data: np.ndarray, table: int = 0):
        up, self.down = _powers(len(data))
        self.sums = np.append(_U(0), np.cumsum(_TABLES[table][data] * up[: len(data)], dtype=np.uint64))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        length = (stop - start).astype(np.uint64) * _BASE
        return mixed((self.sums[stop] - self.sums[start]) * self.down[start] + length)


def anchors(data: np.ndarray, prefixes: Prefixes, length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of a text in order, each with the first and last string start it serves."""
    starts = len(data) - length + 1
    if starts <= 0:
        return (np.zeros(0, np.int64),) * 3
    at = np.arange(len(data) - GRAM + 1)
    # the upper half of the hash, then the place: of equal hashes the first counts
    best = prefixes.of(at, at + GRAM) & _U(0xFFFFFFFF00000000) | at.astype(np.uint64)
    width, grams = 1, window - GRAM + 1
    while width < grams:  # the smallest in ever wider windows
        step = min(width, grams - width)
        best = np.minimum(best[:-step], best[step:])
        width += step
    best = (best[:starts] & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, np.diff(best) != 0))
    return best[first], first, np.append(first[1:] - 1, starts - 1)


def _common(anchor: np.ndarray, prefixes: Prefixes, length: int, window: int) -> np.ndarray:
    """Name of the part that all strings of an anchor hold: what follows the anchor up to the end of the first string."""
    return prefixes.of(anchor, anchor + length - window + GRAM).view(np.int64)


def _shard_names(length: int, window: int):
    """Per text, the distinct names of its anchors' common parts, in order of name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            names, owner = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                data = np.frombuffer(utf8(text), np.uint8)
                if len(data) >= length:
                    prefixes = Prefixes(data)
                    found = _common(anchors(data, prefixes, length, window)[0], prefixes, length, window)
                    names.append(found)
                    owner.append(np.full(len(found), i))
            if not names:
                continue
            names, owner = np.concatenate(names), np.concatenate(owner)
            order = np.lexsort((owner, names))
            names, owner = names[order], owner[order]
            edge = np.flatnonzero(np.append(True, (np.diff(names) != 0) | (np.diff(owner) != 0)))
            counts = np.diff(np.append(edge, len(names)))
            rows = pa.array(owner[edge])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(names[edge]), pa.array(counts.astype(np.int32))],
                names=["id", "print", "name", "n"],
            )

    return run


def _keep_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in rows_of(batches):
        packed = pa.array([squeeze.compress(utf8(t)) for t in batch.column(3).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed], names=["doc_id", "id", "print", "packed"])


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without a repeated name are finished; the others keep their text."""
    for batch in batches:
        sizes, sums, kept = [], [], []
        for packed, names in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            data = _unpack(packed)
            sizes.append(len(data))
            sums.append(None if names else hashlib.sha256(data).hexdigest())
            kept.append(packed if names else None)
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.string()), pa.array(kept, pa.binary()), batch.column(2)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "sha256", "packed", "names"])


def _active(packed: bytes, names: list[int], length: int, window: int):
    """Text, hashes, and the anchors with their ranges and names whose name is repeated."""
    data = np.frombuffer(_unpack(packed), np.uint8)
    both = Prefixes(data), Prefixes(data, 1)
    anchor, low, high = anchors(data, both[0], length, window)
    common = _common(anchor, both[0], length, window)
    on = np.flatnonzero(np.isin(common, np.array(names, np.int64)))
    return data, both, on, anchor[on], low[on], high[on], common[on]


def _contexts(length: int, window: int):
    """Per active suffix the name of everything its strings cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, packed, names in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, both, on, anchor, low, high, common = _active(packed, names, length, window)
                place = ((anchor - low) << 20 | (high - low)).astype(np.uint64)
                whole = [mixed(p.of(low, high + length) ^ place).view(np.int64) for p in both]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(on), row)), pa.array(on.astype(np.int32)), pa.array(common), *map(pa.array, whole)],
                    names=["row", "suffix", "name", "whole", "whole2"],
                )

    return run


def _edges(length: int, window: int):
    """The bytes of the suffixes that fall apart, to be compared string by string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, packed, names, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, _, on, anchor, low, high, _ = _active(packed, names, length, window)
                single = {x["suffix"]: x["single"] for x in wanted}
                rows = [i for i, s in enumerate(on.tolist()) if s in single]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * len(rows), pa.int64()),
                        pa.array([int(on[i]) for i in rows], pa.int32()),
                        pa.array([single[int(on[i])] for i in rows], pa.bool_()),
                        pa.array([int(anchor[i] - low[i]) for i in rows], pa.int32()),
                        pa.array([int(high[i] - low[i]) + 1 for i in rows], pa.int32()),
                        pa.array([data[low[i] : high[i] + length].tobytes() for i in rows], pa.binary()),
                    ],
                    names=["row", "suffix", "single", "lead", "strings", "bytes"],
                )

    return run


EDGE = "edge bigint, row bigint, suffix int, single boolean, lead int, strings int, bytes binary"


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Parts one after the other, and where each begins; hashes within a part do not see the others."""
    sizes = np.array([len(p) for p in parts])
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes


def _ranges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every one of so many things of each owner: the owner, and the number from 0."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _steps(length: int, step: int):
    """Names of ``step`` strings at a time: of what they share and of all they cover.

    Strings are counted from the anchor, so equal ones fall into equal steps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1 << 20):
            edge, lead, strings = (c.to_numpy() for c in batch.columns[:3])
            data, base = _joined(batch.column(3).to_pylist())
            both = Prefixes(data), Prefixes(data, 1)
            owner, at = _ranges(strings)
            number = (lead[owner] - at) // step  # falls along the text
            new = np.append(True, (np.diff(number) != 0) | (np.diff(owner) != 0))
            first = np.flatnonzero(new)
            last = at[np.append(first[1:], len(at)) - 1]
            owner, number, first = owner[first], number[first], at[first]
            place = (number << 10 | (last - first)).astype(np.uint64)
            # held by all strings the step can have, also where some of them have another anchor
            held, here = lead[owner] - number * step, base[owner]
            shared = mixed(both[0].of(here + held, here + held - step + 1 + length) ^ number.astype(np.uint64))
            whole = [mixed(p.of(here + first, here + last + length) ^ place) for p in both]
            columns = [edge[owner], first.astype(np.int32), last.astype(np.int32), *(x.view(np.int64) for x in (shared, *whole))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["edge", "first", "last", "name", "whole", "whole2"])

    return run


def _strings(length: int):
    """Names of single strings of the steps that fall apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1 << 20):
            edge = batch.column(0).to_numpy()
            data, base = _joined(batch.column(1).to_pylist())
            steps = [(i, x["first"], x["last"], x["single"]) for i, xs in enumerate(batch.column(2).to_pylist()) for x in xs]
            which, first, last, single = (np.array(c) for c in zip(*steps, strict=True))
            owner, number = _ranges(last + 1 - first)
            at, which = first[owner] + number, which[owner]
            start = base[which] + at
            whole = [Prefixes(data, t).of(start, start + length).view(np.int64) for t in (0, 1)]
            columns = [edge[which], at.astype(np.int32), single[owner], *whole]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["edge", "at", "single", "whole", "whole2"])

    return run


def _remove(length: int, window: int):
    """Marks the bytes of all repeated strings, and cuts them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, n, done, packed, names, apart in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if done is not None:
                    out.append((doc_id, n, 0, 0, done, [], []))
                    continue
                data, _, on, _, low, high, _ = _active(packed, names, length, window)
                change = np.zeros(n + 1, np.int64)
                partly = {x["suffix"]: x["ranges"] for x in apart or ()}
                for i, suffix in enumerate(on.tolist()):
                    whole = [{"first": 0, "last": high[i] - low[i]}]
                    for x in partly.get(suffix, whole):
                        change[low[i] + x["first"]] += 1
                        change[low[i] + x["last"] + length] -= 1
                gone = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
                left = data[~gone].tobytes()
                spans = edges.astype(np.int32)
                out.append((doc_id, n, int(gone.sum()), len(edges) // 2, hashlib.sha256(left).hexdigest(), spans[::2], spans[1::2]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            names_out = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "stops"]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=names_out)

    return run


def _fall_apart(names: DataFrame, place: list[str]) -> DataFrame:
    """One round: of the names of what is covered, those with others beside them under the same shared name.

    Equal ones are one interval, whose first suffix stands for all. ``single`` tells that the interval
    has no other suffix. The result has the columns ``place`` and ``single``.
    """
    whole = Stored(
        names.groupBy("name", "whole", "whole2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*place)).alias("first"))
    )
    mixed_names = Stored(whole.df.groupBy("name").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("name"))
    return whole.df.join(mixed_names.df, "name").select("first.*", (F.col("n") == 1).alias("single"))


def repeated_strings(
    docs: DataFrame, length: int = LENGTH, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the removed spans (``starts, stops``).

    A byte is removed if a string of ``length`` bytes that covers it starts anywhere else too, in the
    same text or another; texts are taken as UTF-8 and judged as they came. Null and empty texts have
    no bytes; texts shorter than ``length`` lose nothing; repeated rows repeat each other's strings.
    Other columns are not read. ``length`` must be at least twice ``window``.
    """
    if length < 2 * window or window < 2 * GRAM:
        raise ValueError("the window must be between 16 and half the length")
    kept = pick(docs, doc_id=F.col(doc_id).cast("bigint"), text=F.col(text).cast("string")).select(
        "doc_id", F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"), "text"
    )
    # First round: intervals by the part that all strings of a suffix share.
    shards = kept.select("id", "print", "text").mapInArrow(_shard_names(length, window), "id bigint, print bigint, name bigint, n int")
    repeated = Stored(shards.groupBy("name").agg(F.sum("n").alias("n")).filter("n > 1").select("name"))
    active = shards.join(repeated.df, "name").groupBy("id", "print").agg(F.collect_set("name").alias("names"))
    packed = kept.mapInArrow(_keep_texts, "doc_id bigint, id bigint, print bigint, packed binary")
    joined = packed.join(active, ["id", "print"], "left").select("doc_id", "packed", "names")
    settled = joined.mapInArrow(_settle, "doc_id bigint, n_bytes bigint, sha256 string, packed binary, names array<bigint>")
    texts = Stored(settled.withColumn("row", F.monotonically_increasing_id()))
    repeated.delete()
    open_texts = texts.df.filter("sha256 IS NULL")

    # Second round: with all that the strings of a suffix cover.
    names = open_texts.select("row", "packed", "names").mapInArrow(
        _contexts(length, window), "row bigint, suffix int, name bigint, whole bigint, whole2 bigint"
    )
    wanted = _fall_apart(names, ["row", "suffix"]).groupBy("row").agg(F.collect_list(F.struct("suffix", "single")).alias("wanted"))
    found = open_texts.select("row", "packed", "names").join(wanted, "row")
    edges = Stored(
        found.select("row", "packed", "names", "wanted")
        .mapInArrow(_edges(length, window), EDGE.removeprefix("edge bigint, "))
        .withColumn("edge", F.monotonically_increasing_id())
    )

    # Third and last round: a few strings at a time, then single ones.
    steps = edges.df.select("edge", "lead", "strings", "bytes").mapInArrow(
        _steps(length, STEP), "edge bigint, first int, last int, name bigint, whole bigint, whole2 bigint"
    )
    shared = Stored(steps)
    apart = Stored(_fall_apart(shared.df, ["edge", "first", "last"]))
    singles = edges.df.select("edge", "bytes").join(
        apart.df.groupBy("edge").agg(F.collect_list(F.struct("first", "last", "single")).alias("wanted")), "edge"
    )
    strings = Stored(
        singles.select("edge", "bytes", "wanted").mapInArrow(_strings(length), "edge bigint, at int, single boolean, whole bigint, whole2 bigint")
    )
    key = ["whole", "whole2"]
    # Steps with several suffixes are repeated as they are, and so are strings that occur again.
    several = Stored(shared.df.groupBy("name", *key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name", *key))
    by_step = shared.df.join(several.df, ["name", *key]).select("edge", "first", "last")
    again = Stored(strings.df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key))
    by_string = strings.df.filter("single").join(again.df, key).select("edge", F.col("at").alias("first"), F.col("at").alias("last"))
    # The suffixes that stand alone lose just these strings; all other active suffixes lose their whole range.
    alone = edges.df.filter("single").select("edge", "row", "suffix")
    lost = by_step.union(by_string).groupBy("edge").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    ranges = F.coalesce("ranges", F.array().cast("array<struct<first:int,last:int>>")).alias("ranges")
    partly = alone.join(lost, "edge", "left").groupBy("row").agg(F.collect_list(F.struct("suffix", ranges)).alias("apart"))
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, starts array<int>, stops array<int>"
    marked = texts.df.join(partly, "row", "left").select("doc_id", "n_bytes", "sha256", "packed", "names", "apart")
    return marked.mapInArrow(_remove(length, window), schema)
