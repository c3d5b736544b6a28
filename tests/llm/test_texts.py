"""Repeated strings, near-duplicates, line frequency and decontamination against brute force."""

import collections
import hashlib
import random
import re
import tempfile

import numpy as np
import pytest

from tests.llm.helpers import CLASHES, documents, made_up
from wardline.llm import decontaminate, lines, neardup, suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# repeated strings


def without_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def stitched(seed, n=70):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(40)]

    def some(k):
        return " ".join(rng.choice(words) for _ in range(k))

    shared = [some(rng.randint(15, 60)) for _ in range(5)]
    texts = [None, "", "a" * 300, "ab" * 90, "a" * 63]
    while len(texts) < n:
        parts = []
        for _ in range(rng.randint(1, 4)):
            passage = rng.choice(shared)
            start = rng.randint(0, len(passage) // 2)
            parts.append(passage[start : rng.randint(start, len(passage))] if rng.random() < 0.5 else some(rng.randint(1, 40)))
        texts.append(rng.choice(["", " "]).join(parts))
        if rng.random() < 0.2:
            texts.append(texts[-1])
    return texts


@pytest.mark.parametrize("length, window", [(64, 24), (100, 50)])
def test_repeated_strings(spark, length, window):
    texts = stitched(length)
    found = suffixes.repeated_strings(documents(spark, texts).repartition(3), length, window).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found}
    assert got == dict(enumerate(without_repeats(texts, length)))
    for r in found:
        assert sum(b - a for a, b in zip(r["starts"], r["stops"])) == r["n_removed"]


def test_repeated_strings_of_repeated_rows_and_long_texts(spark):
    long = made_up(3, 30_000)
    texts = [long, "x" + long[5000:9000] + "y", made_up(4, 200)]
    rows = [(1, texts[0]), (2, texts[1]), (3, texts[2]), (3, texts[2]), (None, None)]
    found = suffixes.repeated_strings(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    expected = without_repeats([t for _, t in rows], 400)
    got = collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert got == collections.Counter((i, *e) for (i, _), e in zip(rows, expected))


def test_no_texts_for_repeated_strings(spark):
    assert suffixes.repeated_strings(documents(spark, [])).count() == 0


# near-duplicates


def shingle_set(text):
    words = WORD.findall(lower(text))
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(words)


def groups(texts):
    sets = [shingle_set(t) for t in texts]
    lowest = list(range(len(texts)))

    def top(i):
        while lowest[i] != i:
            i = lowest[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((top(i), top(j)))
                lowest[y] = x
    return [(i, len(s), top(i), top(i) == i) for i, s in enumerate(sets)]


def near_copies(seed, n=120):
    rng = random.Random(seed)
    texts = [None, "", " \n", "one", "One", "one two", "one two"]
    base = made_up(seed, 80).split()
    while len(texts) < n:
        kind = rng.random()
        words = list(base) if kind < 0.7 else made_up(rng.random(), rng.randint(2, 60)).split()
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 999)}"
        texts.append(" ".join(words))
        if rng.random() < 0.1:
            texts.append(texts[-1].upper())
    return texts


@pytest.mark.parametrize("block", [neardup.BLOCK_SHINGLES, 700])
def test_groups_of_near_duplicates(spark, block):
    texts = near_copies(5)
    found = neardup.near_duplicates(documents(spark, texts).repartition(4), block_shingles=block).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["doc_id"] == r["component_id"]) for r in found)
    assert got == groups(texts)


def test_large_clusters_are_neither_loaded_whole_nor_copied_per_block(spark, monkeypatch, tmp_path):
    block, tables, measured = 3000, str(tmp_path), neardup._link_units

    def noted(table):
        with tempfile.NamedTemporaryFile("w", dir=tables, delete=False) as f:
            f.write(str(sum(len(x.as_py()) for x in table.column("elements")) // 8))
        return measured(table)

    monkeypatch.setattr(neardup, "_link_units", noted)
    rng, base, texts = random.Random(6), made_up(6, 80).split(), []
    for i in range(900):
        words = list(base)
        words[rng.randrange(80)] = f"w{i}"
        texts.append(" ".join(words))
    # a member that only one other holds, in which block ever that is
    texts += [" ".join(base[:74] + made_up(7 + i, 2 + i).split()) for i in range(5)]
    found = neardup.near_duplicates(documents(spark, texts).repartition(4), block_shingles=block).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["doc_id"] == r["component_id"]) for r in found) == groups(texts)
    held = [int(f.read_text()) for f in tmp_path.iterdir()]
    whole = sum(len(shingle_set(t)) for t in texts)
    assert whole > 20 * block and max(held) < 3 * block and sum(held) < 4 * whole


def test_one_of_each_group_stays(spark):
    a, b = made_up(1, 50), made_up(2, 50)
    rows = [(5, a, 1), (3, a, 2), (3, b, 3), (7, b, 4), (7, b, 4), (9, "", 5), (9, "", 5), (None, made_up(3, 50), 6), (None, None, 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, __id int")
    kept = neardup.drop_near_duplicates(df)
    assert kept.schema == df.schema
    assert sorted((r[0] or 0, r[2]) for r in kept.collect()) == [(0, 6), (0, 7), (3, 2), (3, 3), (9, 5), (9, 5)]
    assert neardup.drop_near_duplicates(documents(spark, [])).count() == 0


def test_one_of_each_group_by_shingles_of_five_words(spark):
    rng, base = random.Random(12), made_up(12, 100).split()
    texts = ["", "one two three", "One two three", "one two four"]
    for i in range(60):
        words = list(base) if i % 3 else made_up(100 + i // 6, 30).split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 999)}"
        texts.append(" ".join(words))
    sets = []
    for t in texts:
        words = WORD.findall(lower(t))
        size = min(5, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    lowest = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((lowest[i], lowest[j]))
                lowest = [x if k == y else k for k in lowest]
    kept = [i for i, k in enumerate(lowest) if i == k]
    assert kept != [i for i, _, _, k in groups(texts) if k]
    found = neardup.drop_near_duplicates(documents(spark, texts).repartition(3), size=5)
    assert sorted(r["doc_id"] for r in found.collect()) == kept


def test_rank_agreement_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**64 - 1, 900, np.uint64)
    errors = []
    for i in range(40):
        common, own = 20 + 10 * i, 30
        a, b = pool[:common], np.append(pool[:common], rng.integers(0, 2**64 - 1, own, np.uint64))
        ranks = neardup.super_minhash([a, b])
        errors.append((ranks[0] == ranks[1]).mean() - common / (common + own))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04
    # every component is met once by every element
    assert (neardup.super_minhash([pool[:1]]) >> np.uint64(32)).ravel().tolist() != [0] * neardup.COMPONENTS
    assert sorted((neardup.super_minhash([pool[:1]]) >> np.uint64(32)).ravel().tolist()) == list(range(neardup.COMPONENTS))


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7)]
    found = neardup.components(spark.createDataFrame(links, "a bigint, b bigint")).df.collect()
    assert {r["a"]: r["b"] for r in found} == {i: 1 for i in range(2, 41)} | {101: 100, 102: 100}


# line frequency


def line_numbers(rows, limit, percent):
    norm = lambda x: " ".join(lower(x).split())
    held = collections.Counter()
    for host, text in rows:
        held.update({(host, norm(x)) for x in (text or "").split("\n") if WORD.search(x)})
    out = []
    for host, text in rows:
        words, split = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
        grams = collections.Counter(zip(words, words[1:], words[2:]))
        again = {p for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for p in range(i, i + 3)}
        lost = sum(len(WORD.findall(x)) for x in split if held[host, norm(x)] > limit)
        out.append(
            (
                len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(split) - len(set(split)),
                len(again), lost, 100 * (len(words) - lost) < percent * len(words),
            )
        )
    return out


def test_line_frequency(spark):
    rng = random.Random(8)
    common = [f"Shared  line number {i} of the site" for i in range(6)]
    rows = [("a", None), ("a", ""), (None, " \n\t"), ("a", "x"), ("a", "a b c a b c a b c"), ("b", "# * <$>|&%")]
    for _ in range(90):
        own = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(0, 5))]
        parts = own + [rng.choice(common) for _ in range(rng.randint(0, 3))]
        rng.shuffle(parts)
        rows.append((rng.choice(["a", "b", None]), "\n".join(parts).replace("site", rng.choice(["site", "SITE", "site "]))))
    rows += rows[-3:]
    df = spark.createDataFrame([(i, h, t, "x") for i, (h, t) in enumerate(rows)], "doc_id bigint, source string, text string, host string")
    found = lines.judge_lines(df.repartition(3), max_docs=5)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "depleted"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in found.collect()}
    assert got == dict(enumerate(line_numbers(rows, 5, lines.KEEP_PERCENT)))
    cleaned = found.join(df.select("doc_id", "text"), "doc_id").select("doc_id", lines.strip_lines("text", "removed").alias("t"))
    left = {r["doc_id"]: r["t"] for r in cleaned.collect() if r["t"] is not None}
    assert all(len(WORD.findall(left[i])) == g[0] - g[5] for i, g in got.items() if i in left)


def test_many_repeated_windows(spark):
    text = "p q r s " * 3000 + made_up(9, 500)
    got = lines.judge_lines(documents(spark, [text])).first()["n_repeat_words"]
    assert got == line_numbers([("s", text)], 20, 50)[0][4]
    assert lines.judge_lines(documents(spark, [])).count() == 0


# decontamination

BENCHMARK_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits(text, items):
    words, hit, ids = BENCHMARK_WORD.findall(lower(text)), set(), set()
    for item_id, item in items:
        pattern = BENCHMARK_WORD.findall(lower(item))
        size = min(10, len(pattern))
        for a in range(len(pattern) - size + 1 if size else 0):
            for b in range(len(words) - size + 1):
                if words[b : b + size] == pattern[a : a + size]:
                    hit.update(range(b, b + size))
                    ids.add(item_id)
    return len(words), len(hit), sorted(x for x in ids if x is not None)


def test_contamination(spark):
    rng = random.Random(4)
    words = "der die das Straße 42 naïve x yes no".split()
    items = [(1, " ".join(rng.choice(words) for _ in range(25))), (2, "Yes, NO!"), (2, "yes no"), (3, None), (4, "..."), (None, "x x x")]
    texts = [None, "", "...", "yes-no", "yesno", "YES no"]
    for _ in range(60):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        at = rng.randint(0, 20)
        texts.append(rng.choice([" ", ", ", "\n"]).join(parts + items[0][1].split()[at : at + rng.randint(5, 15)]))
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    docs = documents(spark, texts)
    found = {r["doc_id"]: r for r in decontaminate.contamination(docs, benchmark).collect()}
    assert {i: (r["n_words"], r["n_hit"], r["items"]) for i, r in found.items()} == {i: hits(t, items) for i, t in enumerate(texts)}
    for i, r in found.items():
        spans = [texts[i][s["start"] : s["stop"]] for s in r["spans"]]
        assert sum(len(BENCHMARK_WORD.findall(lower(s))) for s in spans) == r["n_hit"]
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in enumerate(texts) if not hits(t, items)[1]}


@pytest.mark.parametrize("limit", [60, 400])
def test_large_benchmarks_take_several_automata(spark, limit):
    rng = random.Random(5)
    words = "a b c d e f g h".split()
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(6)] + [(6, "z " * 200), (None, "a b c")]
    texts = [" ".join(rng.choice(words) for _ in range(40)) + " " + items[i % 6][1][:30] for i in range(30)] + [None, "", "z " * 30]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(decontaminate.pattern_parts(benchmark, max_bytes=limit)) > 3
    docs = documents(spark, texts, ["hits", "items", "c0"])
    one = sorted(map(repr, decontaminate.contamination(docs, benchmark).collect()))
    assert sorted(map(repr, decontaminate.contamination(docs, benchmark, max_bytes=limit).collect())) == one
    kept = [decontaminate.drop_contaminated(docs, benchmark, max_bytes=n).collect() for n in (limit, 1 << 20)]
    assert sorted(kept[0], key=repr) == sorted(kept[1], key=repr)


def test_windows_that_share_their_bits_are_all_compared(spark, monkeypatch):
    """All hashes equal: every window is in one run, and equal ones are seldom neighbours."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (3, 4, 9, 20, 40)] + ["a b c x a b c y a b d z a b c"]
    monkeypatch.setattr(lines.F, "xxhash64", lambda *c: lines.F.lit(1 << 62))
    got = documents(spark, texts).select("doc_id", lines.repeated_words(lines.word_array(lines.F.col("text"))).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {i: line_numbers([("s", t)], 20, 50)[0][4] for i, t in enumerate(texts)}


def test_empty_benchmark_and_size_limit(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(documents(spark, ["a b"]), none).first()["n_hit"] == 0
    assert decontaminate.contamination(documents(spark, []), none).count() == 0
    with pytest.raises(ValueError, match="too large"):
        decontaminate.shared_patterns(spark.createDataFrame([(1, "x" * 100)], "item_id bigint, text string"), max_bytes=100)


def test_clashing_columns_are_left_alone(spark):
    texts = ["a b c d", "a b c d", "other words"]
    df = documents(spark, texts, CLASHES)
    assert suffixes.repeated_strings(df).count() == 3
    assert neardup.near_duplicates(df).filter("component_id = 0").count() == 2
    assert neardup.drop_near_duplicates(df).columns == df.columns
    assert lines.judge_lines(df).count() == 3
