"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Every item is lower-cased (A-Z) and cut into words of letters, digits and non-ASCII characters. Its
windows of ten consecutive words (the whole item if it has fewer) are the patterns. Each text is
normalised the same way and scanned once; the end of a match gives its last word, and words lead
back to character offsets of the original text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardline.llm.common import Stored, pick, rows_of, utf8

WINDOW = 10
# Bytes of all patterns that one automaton may hold on an executor; the patterns of a larger benchmark are divided
# among several, which scan the texts one after another.
MAX_PATTERN_BYTES = 32 << 20

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_AUTOMATA: dict[str, object] = {}

SCHEMA = "doc_id bigint, n_words bigint, n_hit bigint, items array<bigint>, spans array<struct<start:int,stop:int>>"


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(_TABLE).split()


def item_windows(items: list[tuple[int | None, str | None]], window: int = WINDOW) -> dict[str, tuple[int, list[int]]]:
    """Pattern -> (words, ids of the items that hold it). An item without id is matched but not listed."""
    patterns: dict[str, tuple[int, set[int]]] = {}
    for item_id, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            key = (b" " + b" ".join(words[at : at + size]) + b" ").decode("latin-1")
            patterns.setdefault(key, (size, set()))[1].update([] if item_id is None else [item_id])
    return {key: (size, sorted(ids)) for key, (size, ids) in patterns.items()}


def _automaton(digest: str, patterns: dict[str, tuple[int, list[int]]]):
    """Built once per Python worker."""
    if digest not in _AUTOMATA:
        import ahocorasick

        built = ahocorasick.Automaton()
        for key, value in patterns.items():
            built.add_word(key, value)
        built.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[digest] = built
    return _AUTOMATA[digest]


def find_words(automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Words of the matches, as (first, after the last) in order of their ends, and the items that hold them."""
    line = b" " + b" ".join(words) + b" "
    found = list(automaton.iter(line.decode("latin-1"))) if words and len(automaton) else []
    if not found:
        return [], set()
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    last = np.searchsorted(gaps, [end for end, _ in found])
    ranges = [(int(stop) - size, int(stop)) for stop, (_, (size, _)) in zip(last, found, strict=True)]
    return ranges, {i for _, (_, ids) in found for i in ids}


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of ranges of words; touching ones become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def find_hits(automaton, text: str | None) -> tuple[int, int, list[int], list[tuple[int, int]]]:
    """Words, hit words, item ids and the hit spans as character offsets of the original text."""
    words = words_of(text)
    ranges, items = find_words(automaton, words)
    return described(text, len(words), merged(ranges), items)


def described(text: str | None, n: int, ranges: list[tuple[int, int]], items: set[int]):
    if not ranges:
        return n, 0, [], []
    places = [m.span() for m in _WORD.finditer(text)]
    spans = [(places[a][0], places[b - 1][1]) for a, b in ranges]
    return n, sum(b - a for a, b in ranges), sorted(items), spans


def shared_patterns(
    benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text", max_bytes: int = MAX_PATTERN_BYTES
) -> tuple[str, Broadcast]:
    """Digest and broadcast patterns of a benchmark for one automaton; its size is checked before it is collected."""
    items = pick(benchmark, item_id=F.col(item_id).cast("bigint"), text=F.col(text).cast("string"))
    if _pattern_bytes(items, window) > max_bytes:
        raise ValueError("the benchmark is too large for one automaton")
    return _shared(benchmark.sparkSession, item_windows([tuple(r) for r in items.distinct().collect()], window))


def _pattern_bytes(items: DataFrame, window: int) -> int:
    # a word is in so many windows
    return items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] * window


def _shared(spark: SparkSession, patterns: dict[str, tuple[int, list[int]]]) -> tuple[str, Broadcast]:
    digest = hashlib.sha256(repr(sorted(patterns.items())).encode()).hexdigest()
    return digest, spark.sparkContext.broadcast(patterns)


def pattern_parts(
    benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text", max_bytes: int = MAX_PATTERN_BYTES
) -> list[Callable[[], tuple[str, Broadcast]]]:
    """For each automaton a function that gives the digest and broadcast of its patterns.

    The windows of a benchmark too large for one are dealt out by a hash, so an item of any length is divided too.
    """
    items = pick(benchmark, item_id=F.col(item_id).cast("bigint"), text=F.col(text).cast("string")).distinct()
    if _pattern_bytes(items, window) <= max_bytes:
        return [partial(shared_patterns, items, window, max_bytes=max_bytes)]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            found = item_windows(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)), window)
            rows = [(key.encode("latin-1"), size, i) for key, (size, ids) in found.items() for i in ids or [None]]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            kinds = [pa.binary(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "size", "item_id"])

    made = Stored(items.mapInArrow(windows, "key binary, size int, item_id bigint").distinct())
    size = made.df.agg(F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(1.25 * size / max_bytes))

    def patterns(part: int) -> tuple[str, Broadcast]:
        found: dict[str, tuple[int, list[int]]] = {}
        for key, words, item in made.df.filter(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).collect():
            found.setdefault(bytes(key).decode("latin-1"), (words, []))[1].extend([] if item is None else [item])
        return _shared(benchmark.sparkSession, {key: (words, sorted(ids)) for key, (words, ids) in found.items()})

    return [partial(patterns, part) for part in range(parts)]


_HIT_TYPE, _ITEM_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.list_(pa.int64())


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int, max_bytes: int) -> DataFrame:
    """``docs``, which have a column ``text``, with the hit words (as ranges) and items of all automata."""
    empty = {"hits": F.expr("cast(array() as array<struct<a:int,b:int>>)"), "items": F.expr("cast(array() as array<bigint>)")}
    names = docs.columns
    state, waiting = docs.withColumns(empty), pattern_parts(benchmark, window, max_bytes=max_bytes)
    for number, patterns in enumerate(waiting):
        digest, shared = patterns()

        def scan(batches: Iterator[pa.RecordBatch], digest=digest, shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(digest, shared.value)
            for batch in rows_of(batches):
                hits, items = [], []
                for text, old, known in zip(*(batch.column(c).to_pylist() for c in ("text", "hits", "items")), strict=True):
                    ranges, found = find_words(automaton, words_of(text))
                    hits.append([{"a": a, "b": b} for a, b in merged([(r["a"], r["b"]) for r in old] + ranges)])
                    items.append(sorted({*known, *found}))
                kept = [batch.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(hits, _HIT_TYPE), pa.array(items, _ITEM_TYPE)], names=[*names, "hits", "items"])

        state = state.mapInArrow(scan, state.schema)
        if number + 1 < len(waiting):
            state = Stored(state).df
    return state


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
    max_bytes: int = MAX_PATTERN_BYTES,
) -> DataFrame:
    """One row per document: ``n_words, n_hit, items, spans``.

    Null and empty texts have no words and no hits; items without words match nothing; repeated
    items and rows count as they come; an empty benchmark hits nothing, an empty table gives none. Other columns
    of the inputs are not read. Patterns of more than ``max_bytes`` bytes take several automata and as many scans.
    """
    narrow = pick(docs, doc_id=F.col(doc_id).cast("bigint"), text=F.col(text).cast("string"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            out = []
            for t, hits, items in zip(*(batch.column(c).to_pylist() for c in ("text", "hits", "items")), strict=True):
                out.append(described(t, len(words_of(t)), [(h["a"], h["b"]) for h in hits], set(items)))
            spans = [[{"start": a, "stop": b} for a, b in x[3]] for x in out]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], pa.int64()),
                    pa.array([x[2] for x in out], pa.list_(pa.int64())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                ],
                names=["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    return _scanned(narrow, benchmark, window, max_bytes).mapInArrow(describe, SCHEMA)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", max_bytes: int = MAX_PATTERN_BYTES
) -> DataFrame:
    """The documents without any hit, all columns as they were.

    Every row is judged by its own text, so there is no join by id, and repeated ids and rows are safe. Null and
    empty texts have no hit and stay; an empty table gives none.
    """
    names = {f"c{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    carried = pick(docs, **names, text=F.col(f"`{text}`").cast("string"))
    clean = _scanned(carried, benchmark, window, max_bytes).filter(F.size("hits") == 0)
    return clean.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
