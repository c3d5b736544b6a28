"""Packing, Merkle manifests and periodic runs, against brute force and round trips."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import CLASHES, documents, made_up
from wardline.llm import merkle, packing, periodic, queries

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "A b", "x " * 30, "ab cd ef " * 40, made_up(3, 50), made_up(3, 50), "line\nline\n" * 9, "é漢 " * 12]


# packing


def check_plan(counts):
    capacity, used = len(counts) - 1, np.zeros_like(counts)
    patterns = packing.plan(counts)
    for times, lengths in patterns:
        assert times > 0 and sum(n * copies for n, copies in lengths) <= capacity
        for n, copies in lengths:
            used[n] += times * copies
    assert (used == counts).all()
    return sum(times for times, _ in patterns)


def best_fit(counts):
    """Sequences that plain best-fit decreasing takes, piece by piece."""
    gaps = []
    for n in range(len(counts) - 1, 0, -1):
        for _ in range(counts[n]):
            fits = [i for i, g in enumerate(gaps) if g >= n]
            if fits:
                i = min(fits, key=gaps.__getitem__)
                gaps[i] -= n
            else:
                gaps.append(len(counts) - 1 - n)
    return len(gaps)


def test_plan_uses_every_piece_once_and_fills_gaps():
    rng = np.random.default_rng(4)
    for trial in range(60):
        capacity = int(rng.integers(1, 40))
        counts = np.r_[0, rng.integers(0, 6, capacity) * (rng.random(capacity) < 0.6)].astype(np.int64)
        made = check_plan(counts)
        least = -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
        assert least <= made <= best_fit(counts) + 1, trial


def test_plan_finds_exact_single_pair_and_triple():
    counts = np.zeros(101, np.int64)
    for n in (70, 30, 60, 25, 15, 50, 20, 18, 12):
        counts[n] += 3
    assert check_plan(counts) == 9
    counts[:] = 0
    counts[50] = 5
    assert check_plan(counts) == 3
    assert check_plan(np.array([0, 7, 0, 0])) == 3
    assert packing.plan(np.zeros(9, np.int64)) == []


def test_plan_of_many_pieces_is_near_the_bound():
    rng = np.random.default_rng(1)
    counts = np.bincount(rng.geometric(1 / 300, 400_000).clip(1, 2048), minlength=2049)
    made = check_plan(counts)
    assert made <= 1.0001 * -(-int((counts * np.arange(2049)).sum()) // 2048) + 1


def test_places_are_one_to_one():
    counts = np.array([0, 9, 4, 3, 0, 2, 1])
    places = packing.Places.of(packing.plan(counts))
    length = np.repeat(np.arange(7), counts)
    number = np.concatenate([np.arange(c) for c in counts])
    sequence, offset = places.find(length, number)
    taken = sorted((s, o + i) for s, o, n in zip(sequence, offset, length) for i in range(n))
    assert len(set(taken)) == len(taken)
    for s in set(sequence):
        assert [o for x, o in taken if x == s] == list(range(sum(x == s for x, _ in taken)))


@pytest.mark.parametrize("capacity", [5, 64, 2048])
def test_packed_documents(spark, capacity):
    texts = [*TEXTS, made_up(9, 3000)]
    docs = documents(spark, texts, CLASHES)
    docs = docs.unionByName(docs.filter("doc_id = 6")).withColumn("doc_id", F.when(F.col("doc_id") != 8, F.col("doc_id")))
    packed = packing.pack(docs, TOKENIZER, capacity, with_ids=True).cache()
    rows = packed.collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = collections.Counter()
    for i, text in [*enumerate(texts), (6, texts[6])]:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        cuts = packing.cut(len(ids), capacity)
        assert cuts[-1] == len(ids) and all(b - a == capacity for a, b in zip(cuts[1:], cuts[2:]))
        assert 0 < cuts[1] - cuts[0] <= capacity
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[None if i == 8 else i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    assert whole.keys() == by_sequence.keys()
    for s, parts in by_sequence.items():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0, *(r.length for r in parts[:-1])]).tolist()
        assert whole[s].n_tokens == sum(r.length for r in parts) <= capacity
        assert whole[s].ids == b"".join(r.ids for r in parts)
    packed.unpersist()


def test_packing_an_empty_table(spark):
    assert packing.pack(documents(spark, []), TOKENIZER).collect() == []


def test_packing_query(spark, small):
    rows = queries.QUERIES["op11_best_fit_packing"](spark, small).collect()
    assert len({r.doc_id for r in rows}) == spark.read.parquet(f"{small}/documents.parquet").count()
    sequences = collections.Counter()
    for r in rows:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 2048
    assert len(sequences) <= -(-sum(sequences.values()) // 2048) + 3


# Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout):
    """Root and, for each leaf, the siblings by level, by plain recursion."""
    proofs, levels = [[] for _ in nodes], [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        for i, proof in enumerate(proofs):
            at = i // fanout ** (len(levels) - 1)
            first = at - at % fanout
            proof.append((below[first:at], below[at + 1 : first + fanout]))
        levels.append([h(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return levels[-1][0], proofs


def brute_manifest(rows, fanout):
    """doc_id, leaf, subroot, root, siblings for rows (doc_id, source, lang, n_chars, text)."""
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r[1]].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    low = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])], fanout) for s in order}
    root, upper = tree([low[s][0] for s in order], fanout)
    out = []
    for s, above in zip(order, upper):
        for x, proof in zip(sorted(by_source[s], key=lambda x: x[:3]), low[s][1]):
            out.append((x[3][0], x[2], low[s][0], root, [(h_ for side in level for h_ in side) for level in [*proof, *above]]))
    return [(a, b, c, d, h(*(x for level in e for x in level))) for a, b, c, d, e in out]


def leaf_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars int, text string")


@pytest.mark.parametrize("fanout,levels", [(2, 1), (2, 3), (3, 1), (16, 2)])
def test_manifest_against_plain_trees(spark, fanout, levels):
    rng = random.Random(fanout * 10 + levels)
    rows = []
    for source, n in [("b", 61), ("a", 1), (None, 7), ("", 2), ("Z", 16), ("é", 17), ("c" * 40, 8)]:
        for _ in range(n):
            rows.append((rng.choice([None, *range(200)]), source, rng.choice([None, "en"]), rng.choice([None, 5]), rng.choice([None, "", "Text É " * 3])))
    rows += rows[:4]
    expected = brute_manifest(rows, fanout)
    made = merkle.manifest(leaf_table(spark, rows).withColumn("key", F.lit(1)).withColumn("leaf", F.lit("x")), fanout=fanout, levels=levels)
    found = made.withColumn("p", merkle.proof_digest(F.col("proof"))).withColumn("again", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.p) for r in found) == sorted((str(e[0]), *e[1:]) for e in expected)
    assert all(r.again == r.root for r in found)


def test_manifest_shows_what_was_changed(spark):
    rows = [(i, "s", "en", 3, t) for i, t in enumerate(["Abc", "abc", None, "", "É"] * 8)]
    made = merkle.manifest(leaf_table(spark, rows), F.col("id") % 2 == 0, fanout=4, levels=1)
    folded = {r[0]: r[1] for r in made.select("doc_id", merkle.fold(F.col("seen"), F.col("proof")) == F.col("root")).collect()}
    assert folded == {i: not (i % 2 == 0 and t == "Abc") for i, _, _, _, t in rows}


def test_manifest_of_little(spark):
    assert merkle.manifest(leaf_table(spark, [])).collect() == []
    (row,) = merkle.manifest(leaf_table(spark, [(1, None, None, None, None)])).collect()
    assert row.leaf == row.subroot == row.root == leaf(1, None, None, None, None) and row.proof == []


@pytest.mark.parametrize("n,fanout", [(1, 2), (2, 2), (5, 2), (9, 3), (17, 4), (33, 16)])
def test_every_block_learns_its_proof(spark, n, fanout):
    nodes = [h(str(i)) for i in range(n)]
    frame = spark.createDataFrame([("k", i, n, x) for i, x in enumerate(nodes)], "key string, at bigint, n bigint, node string")
    root, proofs = tree(nodes, fanout)
    found = {r["at"]: r for r in merkle.butterfly(frame, n, fanout).collect()}
    assert found.keys() == set(range(n))
    for i, proof in enumerate(proofs):
        assert found[i].root == root
        assert [(u.left, u.right) for u in found[i].upper] == [("".join(a), "".join(b)) for a, b in proof]


def test_manifest_query_equals_its_sql(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small}/documents.parquet')")
    result = con.execute(queries.ORACLES["op12_merkle_manifest"])
    names = [c[0] for c in result.description]
    expected = sorted(tuple(r) for r in result.fetchall())
    found = queries.QUERIES["op12_merkle_manifest"](spark, small).select(*names).collect()
    assert sorted(map(tuple, found)) == expected and expected
    tampered = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.verified for r in found if r not in tampered) and not all(r.verified for r in tampered)


# periodic runs


def brute_runs(words, least=6, repeats=4):
    """Every period, every maximal stretch; a stretch counts if no divisor of its period is one of its periods."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        at = 0
        while at < n - q:
            end = at
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            whole = words[at : at + length]
            if length >= max(least, repeats * q) and not any(whole[p:] == whole[:-p] for p in range(1, q)):
                out.append((at, length, q))
            at = max(end, at + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeated_texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        size, letters = rng.choice([0, 1, 5, 6, 7, 20, 60, 300]), rng.choice([1, 2, 3, 60])
        text = [rng.randint(1, letters) for _ in range(size)]
        for _ in range(rng.randint(0, 3) if size > 10 else 0):
            a, p = rng.randrange(size - 1), rng.randint(1, 1 + size // 4)
            b = min(size, a + p * rng.randint(2, 7) + rng.randint(0, p))
            text[a:b] = [text[a + (i - a) % min(p, size - a)] for i in range(a, b)]
        yield np.array(text, np.int64)


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    texts = list(repeated_texts(seed, 60))
    for together in (texts, *([t] for t in texts[:20])):
        for text, found in zip(together, periodic.find_runs(together), strict=True):
            assert found == brute_runs(text.tolist())


def test_runs_with_large_numbers_and_small_chunks(monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK", 16)
    monkeypatch.setattr(periodic, "TOGETHER", 1)
    texts = [t * 40_000_019 for t in repeated_texts(11, 60)]
    for text, found in zip(texts, periodic.find_runs(texts), strict=True):
        assert found == brute_runs(text.tolist())


@pytest.mark.parametrize("scale", [1, 2, 8, 32])
def test_occurrences_are_the_zero_sums(scale):
    rng = np.random.default_rng(scale)
    x = np.r_[rng.integers(1, 3, 150), np.full(8 * scale, 9)].astype(np.int64)
    at, d = periodic.occurrences(x, 150, scale)
    found = {(int(a), int(b)) for a, b in zip(at, d) if a + b + scale <= 150}
    assert found == {
        (a, b)
        for a in range(0, 150, scale)
        for b in range(scale, 2 * scale)
        if a + b + scale <= 150 and ((x[a : a + scale] - x[a + b : a + b + scale]) ** 2).sum() == 0
    }


def planted(doc_id, words):
    hashed = zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    g, n = hashed // 10, len(words)
    if hashed % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_run_query_columns(spark, small, monkeypatch):
    texts = [*TEXTS, "a b " * 11 + "c " * 9, " ".join(made_up(5, 400).split() * 2), "y\x0bz z " * 9, "one two three four " * 700]
    ids = [None, *range(1, len(texts) - 1), 3]
    docs = spark.createDataFrame([(i, t, "s", "x") for i, t in zip(ids, texts)], "doc_id bigint, text string, source string, row string")
    many = spark.createDataFrame([(i, made_up(i % 40, 5 + i % 90), "s", "x") for i in range(100, 500)], docs.schema)
    monkeypatch.setattr(queries, "table", lambda *_: docs.unionByName(many))
    rows = queries.QUERIES["op13_periodic_runs"](spark, small).collect()
    expected = []
    for i, text in [*zip(ids, texts), *((i, made_up(i % 40, 5 + i % 90)) for i in range(100, 500))]:
        words = planted(i, [w.decode() for w in (text or "").encode().split()])
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        keep = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs)]
        head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        expected.append((i, len(runs), *head, h("".join(f"{s},{n},{q}\n" for s, n, q in runs)), h(" ".join(keep))))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
    assert sum(r.n_runs > 0 for r in rows) > 20


def test_runs_of_an_empty_table(spark):
    assert periodic.periodic_runs(documents(spark, [], CLASHES)).collect() == []
