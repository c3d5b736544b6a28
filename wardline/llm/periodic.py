"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q and a length of at least ``max(6, 4 * q)`` that
no neighbouring word extends. At scale B = 1, 2, 4, ... the words are cut into blocks of B. A run
with B <= q < 2 * B holds a whole block that occurs again q words later, because the stretch in
which words equal those q later has at least 3 * B of them. So every block is compared with the two
blocks after it at all distances from B to 2 * B - 1: the squared differences of word numbers,
summed over the block, are zero exactly where it occurs again. The sum is block squares plus window
squares minus twice a correlation, which a number-theoretic transform gives in integers modulo a
prime. Distances with a zero seed the extension to both sides, word by word.

The transform of a window of two blocks follows from those of the blocks, and that of a reversed
block from its own, so each scale takes one transform forward and one back. Documents of an Arrow
slice lie one after another, the longest first, with a separator between them; a scale runs over
those that are long enough for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardline.llm.common import pick, rows_of, word_array

LEAST_WORDS = 6
REPEATS = 4
PRIME = 998244353  # 119 * 2**23 + 1; 3 generates its multiplicative group
GENERATOR = 3
# Numbers that one transform works on at a time, so that they stay in the cache.
CHUNK = 1 << 15
# Up to this scale all seeds are extended together, one word at a time.
TOGETHER = 16

_P = np.uint64(PRIME)
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "row bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


@cache
def _powers(half: int, inverse: bool) -> np.ndarray:
    """Powers 0 to half - 1 of a root of unity of order 2 * half."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out = np.ones(half, np.uint64)
    filled = 1
    while filled < half:
        out[filled : 2 * filled] = out[:filled] * np.uint64(pow(root, filled, PRIME)) % _P
        filled *= 2
    return out


@cache
def _negated(size: int) -> np.ndarray:
    """Places, in bit-reversed order, of the frequencies -k for those of the frequencies k."""
    reverse = np.zeros(size, np.int64)
    for bit in range(size.bit_length() - 1):
        reverse |= (np.arange(size) >> bit & 1) << (size.bit_length() - 2 - bit)
    return reverse[(-reverse) % size]


class Transform:
    """Number-theoretic transforms of ``size`` rows for ``columns`` vectors at once, in buffers of their own."""

    def __init__(self, size: int, columns: int):
        self.size, self.columns = size, columns
        self.spare = np.empty((2, size // 2 * columns), np.uint64)
        self.roots: dict[tuple[int, bool], np.ndarray] = {}

    def _root(self, half: int, inverse: bool) -> np.ndarray:
        if (half, inverse) not in self.roots:
            self.roots[half, inverse] = np.repeat(_powers(half, inverse), self.columns)
        return self.roots[half, inverse]

    @staticmethod
    def _reduce(values: np.ndarray, spare: np.ndarray) -> None:
        np.floor_divide(values, _P, out=spare)
        spare *= _P
        values -= spare

    def forward(self, data: np.ndarray) -> None:
        """In place, natural to bit-reversed order of the rows."""
        half = self.size // 2
        while half:
            pairs = data.reshape(self.size // (2 * half), 2, half * self.columns)
            a, b = pairs[:, 0], pairs[:, 1]
            total, spare = (s.reshape(a.shape) for s in self.spare)
            np.add(a, b, out=total)
            a += _P
            a -= b
            np.multiply(a, self._root(half, False), out=b)
            self._reduce(b, spare)
            np.subtract(total, _P, out=spare)
            np.minimum(total, spare, out=a)  # unsigned: what would be negative is large
            half //= 2

    def backward(self, data: np.ndarray) -> None:
        """In place, bit-reversed to natural order, times ``size``."""
        half = 1
        while half < self.size:
            pairs = data.reshape(self.size // (2 * half), 2, half * self.columns)
            a, b = pairs[:, 0], pairs[:, 1]
            total, spare = (s.reshape(a.shape) for s in self.spare)
            b *= self._root(half, True)
            self._reduce(b, spare)
            np.add(a, b, out=total)
            a += _P
            a -= b
            np.subtract(a, _P, out=spare)
            np.minimum(a, spare, out=b)
            np.subtract(total, _P, out=spare)
            np.minimum(total, spare, out=a)
            half *= 2


def occurrences(x: np.ndarray, n: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of the first ``n`` numbers of ``x`` and distances from scale to 2 * scale - 1 with a zero sum modulo the prime.

    Gives the blocks' first places and the distances. ``x`` goes on for ``4 * scale`` numbers at least.
    """
    blocks, size = -(-n // scale), 2 * scale
    width = max(8, CHUNK // size)
    work = Transform(size, min(width, blocks) + 2)
    unit = np.uint64(pow(scale, -1, PRIME))  # twice the correlation: 2 / size
    places, distances = [], []
    for first in range(0, blocks, width):
        count = min(width, blocks - first)
        if count + 2 != work.columns:
            work = Transform(size, count + 2)
        at = first * scale
        part = np.zeros((count + 3) * scale, np.uint64)
        known = x[at : at + len(part)]
        part[: len(known)] = known
        part %= _P
        squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * part % _P, dtype=np.uint64)])
        data = np.zeros((size, count + 2), np.uint64)
        data[:scale] = part[: (count + 2) * scale].reshape(count + 2, scale).T
        work.forward(data)
        # the window's transform: the second block is shifted by half of the size, which changes the sign of odd frequencies
        window = np.empty((size, count + 2), np.uint64)
        np.add(data[:scale, 1:-1], data[:scale, 2:], out=window[:scale, :-2])
        np.add(data[scale:, 1:-1], _P, out=window[scale:, :-2])
        window[scale:, :-2] -= data[scale:, 2:]
        window[:, -2:] = 0
        window *= data[_negated(size)]
        window %= _P
        work.backward(window)
        twice = window[:scale, :-2] * unit
        twice %= _P
        edges = np.arange(count) * scale
        own = squares[edges + scale] - squares[edges]
        other = edges + np.arange(scale, size)[:, None]
        wanted = (own + squares[other + scale] - squares[other]) % _P
        d, block = np.nonzero(twice == wanted)
        places.append((block + first) * scale)
        distances.append(d + scale)
    return np.concatenate(places), np.concatenate(distances)


def _confirmed(x: np.ndarray, at: np.ndarray, d: np.ndarray, scale: int) -> np.ndarray:
    """Which seeds are right: needed where a sum of squares can exceed the prime."""
    out = np.empty(len(at), bool)
    step, span = max(1, (1 << 20) // scale), np.arange(scale)
    for i in range(0, len(at), step):
        rows = at[i : i + step, None] + span
        out[i : i + step] = (x[rows] == x[rows + d[i : i + step, None]]).all(axis=1)
    return out


def _extend(x: np.ndarray, a: np.ndarray, b: np.ndarray, d: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Grow stretches [a, b) in which words equal those d later; neither side grows by a whole block."""
    a, b = a.copy(), b.copy()
    if scale <= TOGETHER:
        for ends, step in ((a, -1), (b, 0)):
            open_ = np.arange(len(ends))
            while len(open_):
                at = ends[open_] + step
                open_ = open_[x[at] == x[at + d[open_]]]
                ends[open_] += 1 + 2 * step
        return a, b
    for i in range(len(a)):
        low = max(0, a[i] - scale)
        differ = np.flatnonzero(x[low : a[i]] != x[low + d[i] : a[i] + d[i]])
        a[i] = low + differ[-1] + 1 if len(differ) else low
        differ = np.flatnonzero(x[b[i] : b[i] + scale] != x[b[i] + d[i] : b[i] + d[i] + scale])
        b[i] += differ[0] if len(differ) else scale
    return a, b


def find_runs(texts: list[np.ndarray], least: int = LEAST_WORDS, repeats: int = REPEATS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each text, by start and period; texts are positive numbers for words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i, t in enumerate(texts) if len(t) >= least), key=lambda i: -len(texts[i]))
    if not order:
        return out
    lengths = np.array([len(texts[i]) for i in order])
    highest = max(int(texts[i].max()) for i in order)
    starts = np.cumsum([1, *(lengths[:-1] + 1)])
    gap = np.zeros(1, np.int64)
    parts = [gap, *(p for i in order for p in (texts[i], gap))]
    # nothing equals what follows the last separator
    x = np.concatenate([*parts, np.full(int(lengths[0]) + 8, highest + 1, np.int64)])
    found: list[tuple[int, int, int]] = []  # start, end, period
    scale = 1
    while len(long := np.flatnonzero(lengths >= max(least, repeats * scale))):
        n = int(starts[long[-1]] + lengths[long[-1]] + 1)
        at, d = occurrences(x, n, scale)
        keep = np.ones(len(at), bool)
        by_place = np.argsort(at, kind="stable")
        sorted_at = at[by_place]
        for start, end, period in found:
            # a block in a run that meets a multiple of its period says nothing new
            low, high = np.searchsorted(sorted_at, [start, end - 2 * scale + 1])
            near = by_place[low:high]
            keep[near[(d[near] % period == 0) & (at[near] + scale + d[near] <= end)]] = False
        at, d = at[keep], d[keep]
        if (highest + 1) ** 2 * scale >= PRIME and len(at):
            right = _confirmed(x, at, d, scale)
            at, d = at[right], d[right]
        if len(at):
            order_ = np.lexsort((at, d))
            at, d = at[order_], d[order_]
            opens = np.r_[True, (d[1:] != d[:-1]) | (at[1:] != at[:-1] + scale)]
            a, b, d = at[opens], at[np.r_[opens[1:], True]] + scale, d[opens]
            a, b = _extend(x, a, b, d, scale)
            fits = b + d - a >= np.maximum(least, repeats * d)
            found += zip(a[fits].tolist(), (b + d)[fits].tolist(), d[fits].tolist())
        scale *= 2
    for start, end, period in found:
        k = int(np.searchsorted(starts, start, "right")) - 1
        out[order[k]].append((start - int(starts[k]), end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def numbers_of(words: list[bytes]) -> np.ndarray:
    """Words as numbers from 1 in order of first appearance."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known) + 1) for w in words], np.int64)


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those in no run after its first period."""
    keep = np.ones(n, bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return keep


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        texts = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        found = find_runs([numbers_of(w) for w in texts])
        kept = []
        for words, runs in zip(texts, found, strict=True):
            keep = kept_words(len(words), runs) if runs else ()
            kept.append(b" ".join([w for w, k in zip(words, keep, strict=True) if k] if runs else words))
        spans = [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array([len(w) for w in texts], pa.int64()), pa.array(spans, RUN_TYPE),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["row", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_words, runs`` (start, length and period in words, by start) and ``collapsed``.

    Words are parted by ASCII white space. ``collapsed`` has the words that no run contains after its
    first period, joined by blanks. Null and empty texts have no words, no runs and an empty collapsed
    text; rows without id and repeated rows are treated like any other; an empty table gives none.
    Other columns are not read. Rows stay where they are: there is no shuffle, and a task holds one
    slice of texts, or one text if that is longer.
    """
    narrow = pick(docs, row=F.col(f"`{doc_id}`").cast("bigint"), text=F.col(f"`{text}`").cast("string"))
    return narrow.mapInArrow(_scan, SCHEMA).withColumnRenamed("row", doc_id)


def longest_run(runs: Column) -> Column:
    """The run with the greatest length; of equal ones the first by start, then period. Null if there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    return F.when(
        F.size(runs) > 0,
        F.struct((-best["col2"]).alias("start"), best["length"].alias("length"), (-best["col3"]).alias("period")),
    )


def plant_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Known runs for a test of the search: ``doc_id, text``, with a tail that repeats itself in every tenth text.

    With h the unsigned crc32 of the decimal id (of nothing for a null one) and g = h // 10, texts with
    h % 10 = 0 go on from word a = g % n with the p words from there, p = 1 + (n - a) // (3 + g % 8).
    """
    h = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    frame = pick(docs, id=F.col(f"`{doc_id}`").cast("bigint"), text=F.col(f"`{text}`").cast("string"))
    words, n, g = word_array(F.col("text")), F.size("w"), F.floor(h / 10)
    tail = F.sequence(F.lit(0), F.col("n") - 1)
    moved = F.transform(tail, lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise((F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    chosen = h % 10 == 0
    return (
        frame.withColumn("w", F.when(chosen, words))
        .withColumns({"n": n, "g": g})
        .withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
        .select(F.col("id").alias(doc_id), F.when(F.col("n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias(text))
    )
