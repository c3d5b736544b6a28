"""URL rules by cascades of Bloom filters.

The first filter of a cascade encodes the listed keys. Keys of the corpus that pass it without
being listed are false positives; the second filter encodes those, the third the listed keys that
pass the second, and so on until nothing passes wrongly. As the levels are made over the complete
key universe of the corpus, membership of any of its keys is exact, and pages are judged with the
filters alone: no page is shuffled or joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Row, functions as F

from wardline.llm.common import Stored, pick, rows_of

# Keys that one level of a cascade encodes. A filter takes at most 2 bits a key for each halving of its rate;
# longer lists are divided among several cascades by a hash of the key.
MAX_KEYS = 20_000_000
# Rate of the first level, lower where the universe is so large that the second would encode more keys than the first.
FIRST_RATE = 0.01
NEXT_RATE = 0.05
MAX_LEVELS = 64
# Bytes of a filter that are collected as one row.
_BLOCK = 1 << 12


@dataclass(frozen=True)
class Level:
    """One Bloom filter; ``seed`` makes the hashes of every level independent."""

    bits: np.ndarray  # uint8, eight bits each
    hashes: int
    seed: int

    def positions(self, key: bytes) -> list[int]:
        return positions(key, self.bits.size * 8, self.hashes, self.seed)

    def passes(self, key: bytes) -> bool:
        bits = self.bits
        return all(bits[p >> 3] >> (p & 7) & 1 for p in self.positions(key))


def positions(key: bytes, size: int, hashes: int, seed: int) -> list[int]:
    whole = xxhash.xxh128_intdigest(key, seed)
    first, second = whole & (1 << 64) - 1, whole >> 64 | 1
    return [((first + i * second) & (1 << 64) - 1) % size for i in range(hashes)]


def listed(levels: list[Level], key: bytes) -> bool:
    """Odd levels hold listed keys, even ones false positives: the first level that stops a key decides."""
    for depth, level in enumerate(levels):
        if not level.passes(key):
            return depth % 2 == 1
    return len(levels) % 2 == 1


def _filter(keys: DataFrame, n: int, rate: float, seed: int) -> Level:
    """Bits are set in the tasks and packed by blocks, so the driver gets a row for each block of the finished filter."""
    size = 8 * max(1, math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 8))
    hashes = max(1, round(-math.log2(rate)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            where = [p for k in batch.column(0).to_pylist() for p in positions(k, size, hashes, seed)]
            at = np.unique(np.array(where, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(at // (8 * _BLOCK)), pa.array(at)], names=["block", "at"])

    def packed(table: pa.Table) -> pa.Table:
        # a block has as many places as it has bits, however many keys set them
        at = table.column("at").to_numpy()
        bits = np.zeros(8 * _BLOCK, np.uint8)
        bits[at % (8 * _BLOCK)] = 1
        data = np.packbits(bits, bitorder="little").tobytes()
        return pa.table({"block": pa.array([int(at[0]) // (8 * _BLOCK)], pa.int64()), "bits": pa.array([data], pa.binary())})

    found = keys.mapInArrow(run, "block bigint, at bigint").distinct().groupBy("block").applyInArrow(packed, "block bigint, bits binary")
    bits = np.zeros(-(-size // (8 * _BLOCK)) * _BLOCK, np.uint8)
    for block, data in found.toLocalIterator():
        bits[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(bytes(data), np.uint8)
    return Level(bits[: size // 8], hashes, seed)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([shared.value.passes(k) for k in batch.column(0).to_pylist()], pa.bool_()))

    return keys.mapInArrow(run, "key binary")


def first_rate(n: int, others: int) -> float:
    """Rate of the first level: of so many other keys, no more than ``n`` are expected to pass."""
    return min(FIRST_RATE, n / others) if others else FIRST_RATE


def build(keys: DataFrame, universe: DataFrame, max_keys: int = MAX_KEYS) -> list[Level]:
    """Cascade for the distinct ``keys`` over the distinct ``universe`` (both with one column ``key``, binary).

    No keys give no levels, which list nothing. A level of more than ``max_keys`` keys is an error: ``cascades``
    divides the list before.
    """
    inside = Stored(keys.filter(F.col("key").isNotNull()).distinct())
    n = inside.df.count()
    levels: list[Level] = []
    # The keys the next level encodes, and those that must not pass it.
    encode = inside
    others = Stored(universe.filter(F.col("key").isNotNull()).join(inside.df, "key", "left_anti"))
    rate = first_rate(n, others.df.count())
    while n:
        # passing keys scatter about their expected number
        if n > max_keys + 6 * math.isqrt(max_keys):
            raise ValueError(f"{n} keys are too many for level {len(levels)} of one cascade")
        if len(levels) == MAX_LEVELS:
            raise ValueError("the cascade does not end")
        levels.append(_filter(encode.df, n, NEXT_RATE if levels else rate, len(levels)))
        wrong = Stored(_passing(others.df, levels[-1]))
        others.delete()
        encode, others = wrong, encode
        n = encode.df.count()
    encode.delete()
    others.delete()
    return levels


def part_of(key: bytes, parts: int) -> int:
    return xxhash.xxh64_intdigest(key, 1) % parts if parts > 1 else 0


def _in_part(keys: DataFrame, part: int, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([part_of(k, parts) == part for k in batch.column(0).to_pylist()], pa.bool_()))

    return keys if parts == 1 else keys.mapInArrow(run, "key binary")


def host_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    rest = (url or "").partition("://")[2]
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    host = rest[: min(ends)] if ends else rest
    path = rest[len(host) :]
    stops = [i for i in map(path.find, "?#") if i >= 0]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, path[: min(stops)] if stops else path


def candidates(host: str, path: str, lengths: list[tuple[int, int]]) -> list[str]:
    """Keys of the rules that would fit, longest first: the host or a domain above it, and a beginning of the path."""
    found = []
    for h, p in lengths:
        whole = len(host) == h
        if (whole or len(host) > h and host[len(host) - h - 1] == ".") and len(path) >= p:
            found.append(host[len(host) - h :] + "\0" + path[:p])
    return found


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", page_id: str = "page_id", url: str = "url", max_keys: int = MAX_KEYS
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``rules`` has the columns host, path and verdict (``allow`` or ``block``); rules with a null are
    ignored, repeated ones count once, and a rule that is both allows. The longest rule that fits
    wins (of two equally long ones that with the longer host). Without one the cascades list nothing
    and ``default`` holds. Null and malformed urls have an empty host and path; an empty table gives none. Other
    columns are not read. Lists of more than ``max_keys`` rules take several cascades, each over its part of the
    keys; the pages go through these one after another, so that a task holds one pair of them at a time.
    """
    spark = pages.sparkSession
    kept = pick(pages, page_id=F.col(page_id).cast("bigint"), url=F.col(url).cast("string"))
    clean = rules.select("host", "path", "verdict").dropna().distinct()
    # One row for each pair of lengths among the rules.
    pairs = clean.groupBy(F.length("host").alias("h"), F.length("path").alias("p")).count().collect()
    lengths = sorted(((r["h"], r["p"]) for r in pairs), key=lambda x: (-x[0] - x[1], -x[0]))
    most = clean.groupBy("verdict").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    # parts are uneven by the square root of their size
    parts = 1 if most <= max_keys else math.ceil(1.25 * most / max_keys)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            found = {k for u in batch.column(0).to_pylist() for k in candidates(*host_path(u), lengths)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.encode("utf-8", "surrogatepass") for k in found], pa.binary())], names=["key"]
            )

    universe = Stored(kept.select("url").mapInArrow(keys, "key binary").distinct())
    named = clean.select(F.encode(F.concat_ws("\0", "host", "path"), "utf-8").alias("key"), "verdict")

    def cascades(part: int) -> dict[str, list[Level]]:
        there = _in_part(universe.df, part, parts)
        listed_keys = {v: _in_part(named.filter(F.col("verdict") == v).select("key"), part, parts) for v in ("allow", "block")}
        return {v: build(found, there, max_keys) for v, found in listed_keys.items()}

    # the place of the best rule so far among the candidates of a url, and its verdict
    state = kept.withColumns({"place": F.lit(None).cast("int"), "verdict": F.lit(None).cast("string")})
    for part in range(parts):
        shared = spark.sparkContext.broadcast(cascades(part))
        state = state.mapInArrow(_pass(shared, lengths, part, parts), "page_id bigint, url string, place int, verdict string")
        if part + 1 < parts:
            state = Stored(state).df
    universe.delete()

    def named_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            out = []
            for u, place, verdict in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                host, path = host_path(u)
                rule = None if place is None else candidates(host, path, lengths)[place].replace("\0", "")
                out.append((host, path, rule, verdict or default))
            columns = [pa.array([x[i] for x in out], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["page_id", "host", "path", "rule", "verdict"]
            )

    return state.mapInArrow(named_rules, "page_id bigint, host string, path string, rule string, verdict string")


def _pass(shared, lengths: list[tuple[int, int]], part: int, parts: int):
    """Judge urls by the cascades of one part of the keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for batch in rows_of(batches):
            places, verdicts = [], []
            for u, place, verdict in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                for i, key in enumerate(candidates(*host_path(u), lengths)[:place]):
                    raw = key.encode("utf-8", "surrogatepass")
                    if part_of(raw, parts) == part and (found := next((v for v, made in levels.items() if listed(made, raw)), None)):
                        place, verdict = i, found
                        break
                places.append(place)
                verdicts.append(verdict)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(places, pa.int32()), pa.array(verdicts, pa.string())],
                names=["page_id", "url", "place", "verdict"],
            )

    return run


def rule(host: str, path: str, verdict: str) -> Row:
    return Row(host=host, path=path, verdict=verdict)
