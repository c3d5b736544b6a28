"""Packing documents into sequences of bounded length by exact complements.

Only documents longer than a sequence are cut: into whole sequences, before which a shorter first
piece may stand. What is packed are lengths, not pieces: there are at most ``capacity`` different
ones, so the counts of pieces per length are all the plan needs, however many documents there are.

The plan opens a sequence with the longest length left. A gap is looked up among the sums of one,
two and three available lengths; a combination that fills it exactly is taken as often as the
counts allow. Where there is none, the longest length that fits goes in (best fit) and the smaller
gap is looked up. Each pattern found so is taken as often as its scarcest length allows, so a
pattern uses up a length at least once in a while and there are few of them.

Pieces are numbered within their length: by the task that encodes them, plus the numbers of tasks
before. The n-th piece of a length takes the n-th place the plan has for that length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wardline.llm.common import Stored, pick, rows_of
from wardline.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
_WIDTH = 4
_SHIFT = 40  # pieces of one length are fewer than 2**40


class Available:
    """Lengths that are left, and for each sum how many ordered pairs of different or equal lengths make it."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)
        self.have = self.left > 0
        self.pairs = np.zeros(len(counts), np.int64)
        for a in np.flatnonzero(self.have):
            self.pairs[a:] += self.have[: len(counts) - a]

    def take(self, pattern: Counter[int], times: int) -> None:
        for length, copies in pattern.items():
            self.left[length] -= copies * times
            if not self.left[length] and self.have[length]:
                size = len(self.left)
                self.pairs[length:] -= 2 * self.have[: size - length]
                if 2 * length < size:
                    self.pairs[2 * length] += 1
                self.have[length] = False

    def enough(self, used: Counter[int], *more: int) -> bool:
        wanted = Counter(more)
        return all(self.left[length] - used[length] >= n for length, n in wanted.items())

    def single(self, gap: int, used: Counter[int]) -> tuple[int, ...]:
        return (gap,) if self.have[gap] and self.enough(used, gap) else ()

    def pair(self, gap: int, used: Counter[int], *third: int) -> tuple[int, ...]:
        """Two lengths, the longer one as long as can be, that fill the gap (next to a third one)."""
        if gap < 2 or not self.pairs[gap]:
            return ()
        low = (gap + 1) // 2
        longer = np.flatnonzero(self.have[low:gap] & self.have[gap - low : 0 : -1]) + low
        for a in longer[::-1].tolist():
            if self.enough(used, a, gap - a, *third):
                return (a, gap - a, *third)
        return ()

    def triple(self, gap: int, used: Counter[int]) -> tuple[int, ...]:
        if gap < 3:
            return ()
        first = np.flatnonzero(self.have[1 : gap - 1] & (self.pairs[gap - 1 : 1 : -1] > 0)) + 1
        for a in first[::-1].tolist():
            if made := self.pair(gap - a, used, a):
                return made
        return ()

    def fitting(self, gap: int, used: Counter[int]) -> tuple[int, ...]:
        for length in np.flatnonzero(self.have[: gap + 1])[::-1].tolist():
            if self.enough(used, length):
                return (length,)
        return ()


def plan(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of sequences, [(length, copies), ...]) that use up ``counts[length]`` pieces of each length.

    The capacity is the last index of ``counts``.
    """
    capacity, kept = len(counts) - 1, Available(counts)
    patterns = []
    for longest in range(capacity, 0, -1):
        while kept.left[longest]:
            used, gap = Counter([longest]), capacity - longest
            while gap:
                exact = kept.single(gap, used) or kept.pair(gap, used) or kept.triple(gap, used)
                more = exact or kept.fitting(gap, used)
                if not more:
                    break
                used.update(more)
                gap -= sum(more)
            times = min(int(kept.left[length]) // copies for length, copies in used.items())
            kept.take(used, times)
            patterns.append((times, sorted(used.items(), reverse=True)))
    return patterns


@dataclass(frozen=True)
class Places:
    """The plan as sorted arrays: a row is a range of piece numbers of one length within one pattern."""

    key: np.ndarray  # length << _SHIFT | first piece number
    copies: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, patterns: list[tuple[int, list[tuple[int, int]]]]) -> Places:
        taken: Counter[int] = Counter()
        rows, sequence = [], 0
        for times, lengths in patterns:
            offset = 0
            for length, copies in lengths:
                rows.append((length << _SHIFT | taken[length], copies, sequence, offset))
                taken[length] += times * copies
                offset += length * copies
            sequence += times
        return cls(*(np.array(c, np.int64) for c in zip(*sorted(rows), strict=True))) if rows else cls(*[np.zeros(0, np.int64)] * 4)

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``number``-th pieces of lengths."""
        key = length << _SHIFT | number
        row = np.searchsorted(self.key, key, "right") - 1
        turn, copy = np.divmod(key - self.key[row], self.copies[row])
        return self.sequence[row] + turn, self.offset[row] + copy * length


def cut(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of ``n`` ids start, and its end; the first piece may be shorter."""
    return [0, *range((n - 1) % capacity + 1, n + 1, capacity)]


_COLUMNS = [
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("task", pa.int32()), ("place", pa.int64()),
]
_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """The pieces of all documents; ``place`` counts those of one length within ``task``."""
    end = end_id.to_bytes(_WIDTH, "little")
    columns = [*_COLUMNS, *([("ids", pa.binary())] if with_ids else [])]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, task, seen = encoder(tokenizer_path, _WIDTH), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in rows_of(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = made.ids(text) + end
                bounds = cut(len(ids) // _WIDTH, capacity)
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    part = ids[a * _WIDTH : b * _WIDTH]
                    rows.append((doc_id, k, a, b - a, zlib.crc32(part), task, seen[b - a], part)[: len(columns)])
                    seen[b - a] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kind) for v, (_, kind) in zip(zip(*rows, strict=True), columns, strict=True)],
                names=[name for name, _ in columns],
            )

    return docs.mapInArrow(encode, _SCHEMA + ", ids binary" * with_ids)


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if asked for, ``ids``.

    A document is the ids of its whole text with ``end_id`` after them; null and empty texts have that
    id alone. Rows without id and repeated rows are documents like any other; an empty table gives no
    pieces. Other columns are not read. The driver gets one count per length, tasks the plan made
    from these; both are bounded by the capacity.
    """
    narrow = pick(docs, doc_id=F.col(f"`{doc_id}`").cast("bigint"), text=F.col(f"`{text}`").cast("string"))
    made = Stored(pieces(narrow, tokenizer_path, capacity, end_id, with_ids))
    cells = made.df.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cells.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    places = docs.sparkSession.sparkContext.broadcast(Places.of(plan(counts)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = cells.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    numbered = made.df.join(base, ["length", "task"]).select(*kept, (F.col("base") + F.col("place")).alias("number"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.value.find(batch.column("length").to_numpy(), batch.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
            )

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    placed = numbered.mapInArrow(put, schema + ", sequence_id bigint, offset bigint")
    return placed.withColumnRenamed("doc_id", doc_id)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences of ``pack(..., with_ids=True)``: ``sequence_id, n_tokens, ids`` (unsigned, 32 bits, little-endian).

    A sequence has at most as many pieces as its capacity, so each group is small.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform("parts", lambda p: p["ids"]), F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    return (
        packed.groupBy("sequence_id")
        .agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
        .select("sequence_id", "n_tokens", joined.alias("ids"))
    )
