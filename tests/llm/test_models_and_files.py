"""Language model, toxicity, token files, main text, mixing, url rules, and the pipeline."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import CLASHES, documents, made_up
from wardline.llm import decontaminate, hmm, html, mixing, neardup, queries, tokens, toxicity, urls
from wardline.llm.common import work_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# hidden Markov model


def random_model(seed):
    rng = np.random.default_rng(seed)
    start, move = rng.random(hmm.STATES), rng.random((hmm.STATES, hmm.STATES))
    emit = rng.random((hmm.CLASSES, hmm.STATES))
    return hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def test_recursions_against_all_paths():
    model = random_model(1)
    texts = [np.array(t, np.uint16) for t in ([3, 1, hmm.END_CLASS], [hmm.END_CLASS], [3, 3], [5, 1, 3])]
    logs, (start, move, emit) = hmm.forward_backward(model, texts)
    e_start, e_move, e_emit = np.zeros_like(start), np.zeros_like(move), np.zeros_like(emit)
    for text, log in zip(texts, logs):
        weights = {}
        for path in itertools.product(range(hmm.STATES), repeat=len(text)):
            p = model.start[path[0]] * math.prod(model.move[a, b] for a, b in zip(path, path[1:]))
            weights[path] = p * math.prod(model.emit[c, s] for c, s in zip(text, path))
        total = sum(weights.values())
        assert log == pytest.approx(math.log10(total))
        for path, p in weights.items():
            e_start[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                e_move[a, b] += p / total
            for c, s in zip(text, path):
                e_emit[c, s] += p / total
    np.testing.assert_allclose(start, e_start)
    np.testing.assert_allclose(move, e_move)
    np.testing.assert_allclose(emit, e_emit, atol=1e-12)
    assert hmm.forward_backward(model, texts, learn=False)[0] == pytest.approx(logs)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(5)
    texts = [np.array(rng.integers(0, 20, 30) + 40 * (i % 2), np.uint16) for i in range(60)]
    share = np.bincount(np.concatenate(texts), minlength=hmm.CLASSES) + 0.01
    share = share / share.sum()
    model, last = hmm.Model.fresh(share), -np.inf
    for _ in range(6):
        logs, counts = hmm.forward_backward(model, texts)
        assert logs.sum() > last
        last, model = logs.sum(), hmm.Model.from_counts(*counts, share)


def test_first_iteration_reads_every_text(monkeypatch):
    """Long texts and many texts count too, and the counts by turns are a better start than those of chance alone."""
    monkeypatch.setattr(hmm, "FIRST_TOKENS", 500)
    rng = np.random.default_rng(4)
    texts = [np.append(np.where(np.arange(n) % 2, 1, 0) + 2 * rng.integers(0, 4, n), hmm.END_CLASS).astype(np.uint16) for n in [3000, *[20] * 1600]]
    share = np.bincount(np.concatenate(texts), minlength=hmm.CLASSES) + 0.01
    share, fresh = share / share.sum(), hmm.Model.fresh(share / share.sum())
    total = hmm._counts_by_turns(fresh, texts, share)
    assert total[: hmm.CLASSES].sum() == pytest.approx(sum(map(len, texts))) and total[hmm.CLASSES].sum() == pytest.approx(len(texts))
    once = hmm.Model.from_counts(*hmm.forward_backward(fresh, texts)[1], share)
    turns = hmm.Model.from_counts(total[hmm.CLASSES], total[hmm.CLASSES + 1 :], total[: hmm.CLASSES], share)
    likely = lambda m: hmm.forward_backward(m, texts, learn=False)[0].sum()
    assert likely(turns) > likely(once)


def test_language_model_scores(spark):
    texts = [made_up(i % 7, 30) + " Extra" for i in range(40)] + [None, "", " \n", "unseen", "UNSEEN words", "x\x0by"]
    df = documents(spark, texts, CLASSES_CLASH).repartition(3)
    learns = F.col("doc_id") % 10 != 0
    found = {r["doc_id"]: r for r in hmm.learn_and_score(df, learns).collect()}
    words = [[w.lower() for w in (t or "").replace("\x0b", " ").split()] + [None] for t in texts]
    counts = collections.Counter(w for i, ws in enumerate(words) if i % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in enumerate(words):
        r = found[i]
        assert (r["learned"], r["n_tokens"], r["n_known"]) == (i % 10 != 0, len(ws), sum(counts[w] > 0 for w in ws))
        assert r["train_tokens"] == n
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert r["score"] < 0
    # the sum of the probabilities of all one-word texts is no more than one
    assert found[40]["score"] == found[41]["score"] == found[42]["score"]


CLASSES_CLASH = ["train", "block", "classes", "word"]


def test_language_model_without_learning_or_rows(spark):
    none = hmm.learn_and_score(documents(spark, ["a b", None]), F.lit(False)).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in none] == [(0, 0), (0, 0)]
    assert all(math.isfinite(r["score"]) for r in none)
    assert hmm.learn_and_score(documents(spark, []), F.lit(True)).count() == 0


# toxicity


def test_gradients_of_the_network():
    network = toxicity.Network({k: v.astype(np.float64) for k, v in toxicity.Network.fresh(3).p.items()})
    words = [b"abc", b"de", b"x", "é".encode()]
    features = toxicity.word_features(words)
    ids = np.zeros((3, toxicity.WINDOW), np.int32)
    ids[0, :4], ids[1, :2], ids[2, :] = [1, 2, 3, 4], [3, 3], 2
    labels = np.array([1.0, 0.0, 1.0], np.float32)
    _, g = network.gradients(features, ids, labels)
    hashed, trigrams, _ = features
    for name, place in [("uf", (2, 5)), ("wb", (3, 20)), ("cf", (9,)), ("attend", (4,)), ("out", (12,)), ("bias", (0,)), ("word", (hashed[1], 2)), ("char", (trigrams[0], 3))]:
        value, losses = network.p[name][place], []
        for step in (1e-3, -1e-3):
            network.p[name][place] = value + step
            losses.append(network.gradients(features, ids, labels)[0])
        network.p[name][place] = value
        assert g[name][place] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=0.02, abs=2e-5), name


def test_windows_cover_every_word_twice_but_the_ends():
    for n in (1, 31, 32, 33, 48, 200):
        windows = toxicity.windows_of(np.arange(1, n + 1))
        assert set(windows.ravel()) - {0} == set(range(1, n + 1))
        assert n <= toxicity.WINDOW or len(windows) > 1


VOCABULARY = made_up(0, 400).split()


def from_vocabulary(seed, n):
    rng = random.Random(seed)
    return [rng.choice(VOCABULARY) for _ in range(n)]


@pytest.fixture(scope="module")
def network():
    rng = random.Random(2)
    rows = []
    for i in range(240):
        words = from_vocabulary(i, rng.randint(5, 120))
        for _ in range(rng.randint(1, 5) if i % 4 == 0 else 0):
            words.insert(rng.randint(0, len(words)), "zukw" + rng.choice(["al", "er", "ing", "os", "um"]))
        rows.append((" ".join(words), int(i % 4 == 0)))
    return toxicity.train(rows)


def test_toxicity_is_learned_and_whole_texts_are_scored(spark, network):
    clean = [from_vocabulary(1000 + i, 150) for i in range(20)]
    toxic = [t + from_vocabulary(i, 5000 if i == 0 else 50) + ["Zukwal", "x", "zukwos"] + from_vocabulary(i + 50, 40) for i, t in enumerate(clean)]
    texts = [*map(" ".join, clean + toxic), None, "", " \n", "zukwer", " ".join(from_vocabulary(7, 60_000)), "q" * 200_000]
    df = documents(spark, texts, CLASHES)
    scores = [r["score"] for r in toxicity.score(df, network).orderBy("doc_id").collect()]
    assert sum(s >= toxicity.THRESHOLD for s in scores[:20]) <= 1
    assert sum(s >= toxicity.THRESHOLD for s in scores[20:40]) >= 19
    assert scores[40:43] == [0, 0, 0] and scores[43] > toxicity.THRESHOLD
    kept = toxicity.drop_toxic(df, network)
    assert kept.schema == df.schema
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in enumerate(scores) if s < toxicity.THRESHOLD}
    assert toxicity.score(documents(spark, []), network).count() == 0


def test_sample_of_labels(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 5)
    docs = documents(spark, [None if i == 3 else "" if i == 4 else f"t {i}" for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(5, 1), (None, 1), (6, None), (99, 1)], "doc_id bigint, toxic int")
    rows = toxicity.sample(docs, labels)
    assert 11 <= len(rows) <= 15 and rows == toxicity.sample(docs.repartition(3), labels.repartition(2))
    assert toxicity.train([]).p.keys() == toxicity.Network.fresh().p.keys()


# token files

TEXTS = [
    None, "", " ", "a", "Hello, world!\nNext line", "  two  blanks ", "tab\t tab", "ümlaut Straße 日本語", "it's 42nd <|endoftext|> x",
    "nbsp\u00a0 x", "end. ", "\n\nA\n b", made_up(1, 3000), made_up(2, 40) + "\U0001f600",
]


def test_token_files_hold_what_the_tokenizer_says(spark):
    path, texts = work_folder(spark), TEXTS * 3
    rows = [(None if i == 20 else i // 2, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, ids string").repartition(5)
    tokens.write_token_files(df, path, TOKENIZER, file_bytes=2000)
    plain = Tokenizer.from_file(TOKENIZER)
    expected = collections.Counter((k, *plain.encode(t or "", add_special_tokens=False).ids, 0) for k, t in rows)
    found = tokens.read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    assert collections.Counter((r["doc_id"], *r["ids"]) for r in found) == expected
    start, last = 0, -1
    for r in found:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert (-1 if r["doc_id"] is None else r["doc_id"]) >= last
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start, last = start + r["n_tokens"], -1 if r["doc_id"] is None else r["doc_id"]
    for key in (0, 3, 12):
        wanted = sorted([*plain.encode(t or "", add_special_tokens=False).ids, 0] for k, t in rows if k == key)
        assert sorted(a.tolist() for a in tokens.read_document(spark, path, key)) == wanted
    assert tokens.read_document(spark, path, 10_000) == []


def test_a_small_memory_of_words_gives_the_same_ids():
    plain, rng = Tokenizer.from_file(TOKENIZER), random.Random(3)
    small = tokens.Encoder(TOKENIZER, 2, max_words=20)
    for _ in range(50):
        text = " ".join(rng.choice(["tree", "Baum,", "a\nb", "x9", "\u00e9t\u00e9."]) + str(rng.randrange(60)) * rng.randrange(2) for _ in range(30))
        assert np.frombuffer(small.ids(text), "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(small.words) <= 21 and len(small.words.pieces) <= 3


def test_token_file_knows_its_dictionary():
    content = tokens.pack([1, None], [1, 0], [tokens._compressor(b"").compress(b"\1\0"), tokens._compressor(b"").compress(b"")], 2, tokens.hashlib.sha256(b"").digest())
    file = tokens.TokenFile(content, b"")
    assert file.doc_ids == [1, None] and file.ids(0).tolist() == [1] and file.ids(1).tolist() == []
    with pytest.raises(ValueError, match="another dictionary"):
        tokens.TokenFile(content, b"other")


def test_dictionary_does_not_depend_on_the_order_of_rows(spark, monkeypatch):
    monkeypatch.setattr(tokens, "SAMPLE_DOCS", 40)
    monkeypatch.setattr(tokens, "SAMPLE_CHARS", 300)
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["wolf", "river", "stone", "Mühle", "of", "the", "ÿ"], k=rng.choice([0, 5, 400]))) for _ in range(200)]
    rows = [(i if i % 3 else None, t if i % 11 else None) for i, t in enumerate(texts)] + [(7, "twice")] * 3
    kind = "doc_id bigint, text string"
    one = tokens.train_dictionary(spark.createDataFrame(rows, kind).coalesce(1), TOKENIZER, 2)
    two = tokens.train_dictionary(spark.createDataFrame(rows[::-1], kind).repartition(5), TOKENIZER, 2)
    assert one == two and one


def test_no_documents_give_no_tokens(spark):
    path = work_folder(spark)
    tokens.write_token_files(documents(spark, []), path, TOKENIZER)
    assert tokens.read_token_files(spark, path).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_words_encoded_alone_equal_whole_texts(seed):
    rng, made = random.Random(seed), tokens.encoder(TOKENIZER, 2)
    chars = [chr(c) for c in [*range(127), *range(0x80, 0x2B0), 0x2003, 0x200B, 0x4E00, 0x1F600]]
    for _ in range(800):
        pool = ["ab", "é.", "b.\n", "The", "dog,", " ", " ", "'s", *rng.sample(chars, rng.choice([3, 20]))]
        text = "".join(rng.choice(pool) for _ in range(rng.choice([1, 5, 30])))
        assert np.frombuffer(made.ids(text), "<u2").tolist() == made.tokenizer.encode(text, add_special_tokens=False).ids


# main text

BODY = "A sentence of the article, long enough to be one. " * 3


def test_article_between_boilerplate():
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x='<p>no</p>';</script></head><body>"
        "<header><h2>Site</h2></header><nav><ul><li><a href=/x>Menu</a></li></ul></nav><!-- <p>no</p> --><div class='ad'>Buy</div>"
        f"<article><h1>Title &amp; more</h1><p><b>{BODY}<br>next<p>Short.</p><aside>no</aside><form><p>no</p></form>"
        "<p>a<i>b</i>&nbsp;c\n d</p></article>"
        "<div class='comments'><article class='comment'><p>no reader comment</p></article></div><footer>&copy; no</footer></body></html>"
    )
    assert html.main_text(page) == "\n".join(["Title & more", BODY.strip() + " next", "Short.", "ab c d"])


def test_article_without_its_element():
    links = "".join(f"<li><a href=/{i}>A menu entry {i}</a></li>" for i in range(8))
    page = f"<body><ul>{links}</ul><div><p>{BODY}</p><p>{BODY}x</p><p>Tiny.</p><p>{BODY}</p></div><ul>{links}</ul><p>End</p>"
    assert html.main_text(page) == "\n".join([BODY.strip(), BODY + "x", "Tiny.", BODY.strip()])


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<html><nav>a</nav>", "<script>x", "<!--", "<p></p>"])
def test_pages_without_text(page):
    assert html.main_text(page) == "" or page in ("<", "<p")


def test_open_navigation_ends_at_the_article():
    assert html.main_text(f"<nav><ul><li>Menu<article><p>{BODY}</p></article>") == BODY.strip()
    assert html.main_text("just text & <b>more</b>") == "just text & more"


def test_an_element_is_a_weight_and_no_switch():
    body = "\n".join(f"{BODY}{i}" for i in range(4))
    paragraphs = "".join(f"<p>{x}</p>" for x in body.split("\n"))
    teaser = "<article><p>A teaser of another story.</p></article>"
    menu = "".join(f"<li><a href=/{i}>A menu entry {i}</a></li>" for i in range(8))
    for holder in ("div", "main"):
        assert html.main_text(f"<body><{holder}>{paragraphs}</{holder}><ul>{menu}</ul>{teaser}</body>").startswith(body)
    # text next to an article with half of it stays if it surges, a thin line does not
    page = f"<article>{paragraphs}</article><ul>{menu}</ul><div><p>{BODY}x</p><p>{BODY}y</p><p>{BODY}z</p></div><ul>{menu}</ul><p>A thin line.</p>"
    assert html.main_text(page) == "\n".join([body, *(BODY + x for x in "xyz")])
    # on pages without elements a short run with enough text for a surge stays
    page = f"<body>{paragraphs * 5}<ul>{menu}</ul><p>{BODY}end</p></body>"
    assert html.main_text(page).endswith(f"{BODY}end")


def test_extract(spark):
    rows = [(1, "u", f"<article><p>é{BODY}</p></article>", "x"), (2, None, None, "x"), (2, None, None, "x"), (None, "v", "<p>" + "word " * 50_000, "x")]
    found = html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert [r["n_chars"] for r in found] == [len(BODY), 0, 0, 249_999]
    assert html.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


# mixing


def reshared(sizes, weights, total, cap):
    """Targets by resharing the excess until nothing is above its cap."""
    targets, open_ = {}, dict(sizes)
    while open_:
        left = total - sum(targets.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return targets | share
        for s in over:
            targets[s] = cap * sizes[s]
            del open_[s]
    return targets


@pytest.mark.parametrize("seed", range(4))
def test_mixture(spark, seed):
    rng = random.Random(seed)
    names = ["é", "a", "B", "", None, "zero"][: 2 + seed]
    rows = [(i, rng.choice(names), made_up(i, int(rng.paretovariate(0.8)) % 300)) for i in range(300)]
    rows = [(i, s, None if s == "zero" else t) for i, s, t in rows] + [(0, *rows[0][1:]), (None, "a", "x y")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, source string, text string, copies string")
    plan = mixing.mixing_plan(df.repartition(5)).collect()
    sizes = collections.Counter()
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    expected = reshared(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    source = {r[0]: r[1] for r in rows}
    taken = collections.Counter()
    for r in plan:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(expected[s])
        assert 0 <= r["copies"] <= 2
        taken[s] += r["size"] * r["copies"]
    for s in sizes:  # in the order of size, the error is that of one document at most
        assert abs(taken[s] - expected[s]) <= max(len((t or "").split()) for _, x, t in rows if x == s)
    again = mixing.mixing_plan(df.coalesce(1)).collect()
    assert collections.Counter(plan) == collections.Counter(again)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r["copies"] for r in plan)


def test_mixture_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [None, ""], CLASHES)).count() == 0


# url rules


def test_cascade_is_exact_over_its_universe(spark):
    universe = [f"key{i}".encode() for i in range(6000)]
    inside = set(universe[::3])
    frame = lambda ks: spark.createDataFrame([(bytearray(k),) for k in ks], "key binary")
    levels = urls.build(frame([*inside, *list(inside)[:50]]), frame(universe + universe[:9]))
    assert len(levels) > 1
    assert all(urls.listed(levels, k) == (k in inside) for k in universe)
    assert not urls.listed(urls.build(frame([]), frame(universe)), b"key1")
    with pytest.raises(ValueError, match="too many"):
        urls.build(frame(universe), frame(universe), max_keys=10)


PAGES = [
    None, "", "example.org/es/1", "http://example.org/es/1", "HTTP://WWW.EXAMPLE.ORG/es/", "http://notexample.org/es/", "x://a.org",
    "x://a.org?x=/es/", "http://a.org/#f", "http://b.example.org/en/12", "http://b.example.org/en/2", "http://s.com/de/x?y", "http://s.com/fr",
    "http://s.com:80/de/", "http://É.com/de/", "http:///de/", "http://com/de/", "http://s.net/de/", "http://x.com/DE/", "a://b://com/de/",
]


def judged(url):
    rest = (url or "").partition("://")[2]
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


LONG = "A long paragraph of plain text that goes on for well over a hundred characters, so that it surges by itself as articles do."


@pytest.mark.parametrize("opening", ["<div class='post related-stories'>", "<section class='share-holders report'>", "<form id=aspnet>", "<div class=widget>"])
def test_a_name_does_not_lose_the_article(opening):
    closing = f"</{opening[1:].split()[0]}>"
    page = f"<body><nav><p>{LONG} menu</p></nav>{opening}<p>{LONG}</p><p>{LONG} 2</p>{closing}<footer>{LONG}</footer></body>"
    assert html.main_text(page) == f"{LONG}\n{LONG} 2"
    assert html.main_text(f"<div><p>{LONG} a</p><p>{LONG} b</p></div>{opening}<p>{LONG}</p>{closing}") == f"{LONG} a\n{LONG} b"
    assert html.main_text(f"<article><p>Short.</p></article>{opening}<p>{LONG}</p>{closing}") == "Short."


def test_comments_are_never_the_article_of_a_page_with_text():
    assert html.main_text(f"<div><p>{LONG}</p></div><div class=comments>" + f"<p>{LONG} no</p>" * 9 + "</div>") == LONG
    inner = f"<div class=widget><p>{LONG}</p><div class=comments><p>{LONG} no</p></div><p>{LONG} 2</p></div>"
    assert html.main_text(inner) == f"{LONG}\n{LONG} 2"


def test_a_linked_paragraph_between_others_stays():
    link = f"<p><a href=x>{LONG}</a></p>"
    assert html.main_text(f"<div><p>{LONG} a</p>{link}<p>{LONG} b</p>{link * 3}</div>") == f"{LONG} a\n{LONG}\n{LONG} b"


def test_window_sums_decide_by_themselves():
    """Plain lines without any element or name: an independent sum over windows finds the same runs."""
    rng = random.Random(6)
    for _ in range(300):
        sizes = [rng.choice([0, 0, 0, 5, 30, 90, 200]) for _ in range(rng.randint(1, 25))]
        # a line of size 0 is one link
        texts = [f"{i:03d}" + "x" * max(0, n - 3) for i, n in enumerate(sizes)]
        page = "".join(f"<p>{t}</p>" if n else f"<p><a href=y>{t}</a></p>" for t, n in zip(texts, sizes))
        sums = [sum(sizes[i : i + html.WINDOW]) for i in range(len(sizes))]
        surge, runs, open_ = min(html.SURGE_CHARS, html.SURGE_SHARE * max(sums)), [], False
        for i, total in enumerate(sums):
            if total and not open_ and total >= surge:
                runs.append([])
                open_ = True
            open_ = open_ and total > 0
            if open_:
                runs[-1].append(i)
        trimmed = []
        for run in runs:
            with_text = [i for i in run if sizes[i]]
            if with_text:
                trimmed.append(range(with_text[0], with_text[-1] + 1))
        most = max((sum(sizes[i] for i in r) for r in trimmed), default=0)
        expected = [texts[i] for r in trimmed if sum(sizes[j] for j in r) >= min(html.SURGE_CHARS, html.RUN_SHARE * most) for i in r]
        assert html.main_text(page) == "\n".join(expected)


def judged_by(rules, u):
    host, path, _, _ = judged(u)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host)), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


def test_long_lists_take_several_cascades(spark):
    rng = random.Random(2)
    listed = [urls.rule(f"h{i % 40}.org", f"/{i}/", rng.choice(["allow", "block"])) for i in range(300)]
    listed += [urls.rule("org", "/", "block")]
    pages = [f"http://{rng.choice(['', 'www.'])}h{rng.randint(0, 60)}.org/{rng.randint(0, 400)}/{rng.randint(0, 9)}?q" for _ in range(400)] + [None, "x"]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, url string")
    found = {r["page_id"]: tuple(r)[1:] for r in urls.judge(df, spark.createDataFrame(listed), max_keys=60).collect()}
    assert found == {i: judged_by(listed, u) for i, u in enumerate(pages)}


def test_second_level_is_no_larger_than_the_first(spark):
    """A universe a thousand times the list: the first rate follows from both, and membership stays exact."""
    key = F.encode(F.concat(F.lit("k"), F.col("id").cast("string")), "utf-8").alias("key")
    made = urls.build(spark.range(100).select(key), spark.range(100_000).select(key))
    assert urls.first_rate(100, 99_900) < 0.0011 and len(made) >= 1
    if len(made) > 1:
        assert made[1].bits.size <= made[0].bits.size
    assert [i for i in range(100_000) if urls.listed(made, f"k{i}".encode())] == list(range(100))
    with pytest.raises(ValueError, match="too many"):
        urls.build(spark.range(100).select(key), spark.range(200).select(key), max_keys=10)


def test_bits_of_a_filter_over_many_blocks(spark):
    key = F.encode(F.col("id").cast("string"), "utf-8").alias("key")
    level = urls._filter(spark.range(50_000).select(key), 50_000, 0.01, 3)
    assert level.bits.size > 2 * urls._BLOCK and all(level.passes(str(i).encode()) for i in range(0, 50_000, 97))
    wrong = sum(level.passes(f"n{i}".encode()) for i in range(5000))
    assert wrong < 110


def test_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(PAGES)] + [(3, PAGES[3], "y"), (None, PAGES[11], "z")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    rules = spark.createDataFrame([*queries.RULES, queries.RULES[0]]).union(spark.createDataFrame([(None, "/", "block")], "host string, path string, verdict string"))
    found = collections.Counter(urls.judge(df, rules).collect())
    assert found == collections.Counter((i, *judged(u)) for i, u, _ in rows)
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in urls.judge(df, none, default="block").collect()} == {"block"}
    assert urls.judge(df.limit(0), rules).count() == 0


# pipeline


def linked_groups(texts, size, share=80):
    """Smallest number reachable over links of equal or similar shingle sets, by comparing all pairs."""
    sets = []
    for t in texts:
        w = [x.lower() for x in (t or "").encode().split()]
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
            a, b = sorted((top(i), top(j)))
            up[b] = a
    return [top(i) for i in range(len(texts))]


def test_stage_of_near_duplicates_takes_five_words(spark, small):
    rng = random.Random(9)
    texts = []
    for k in range(12):
        base = made_up(k, 150).split()
        for changes in (0, 0, 1, 2, 3, 4, 6, 8):
            words = list(base)
            for at in rng.sample(range(150), changes):
                words[at] = f"new{rng.randint(0, 9**6)}"
            texts.append(" ".join(words))
    texts += ["one", "one", "a b", None, "", "a b c d e", "a b c d e f"]
    docs = documents(spark, texts, ["toxic", "key"])
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, small).collect())
    five = linked_groups(texts, 5)
    assert kept == [i for i in range(len(texts)) if five[i] == i]
    assert kept != [i for i, g in enumerate(linked_groups(texts, 2)) if g == i]


def test_equal_ids_and_texts_leave_the_same_row_each_time(spark):
    rows = [(5, "a b c", f"s{i}") for i in range(6)] + [(None, "a b c", "s")]
    kept = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(1 + seed)
        kept.add(tuple(tuple(r) for r in neardup.drop_near_duplicates(docs).collect()))
    assert len(kept) == 1 and len(next(iter(kept))) == 1


def test_documents_without_id_do_not_meet_all_members(spark):
    """A thousand texts without id, in pairs: each is joined with its own class alone."""
    texts = [made_up(i // 2, 40) + (" more" if i % 2 else "") for i in range(1000)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string")
    found = neardup.near_duplicates(docs).collect()
    assert len(found) == 1000 and len({r["root"] for r in found}) == 500
    assert {r["component_id"] for r in found} == {None}


def test_stages_take_any_table(spark, small):
    schema = "doc_id bigint, text string, source string, toxic int, key string, lang string, n_chars int"
    rows = [(None, None, None, None, None, None, None), (1, "", None, 1, "k", "en", 0), (1, "some words here", "a", 0, None, None, 3)]
    rows += rows[2:] + [(2, "w " * 9000, "a", 1, "k", "en", 5), (None, "other words", None, 0, "k", None, 1)]
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, small)
            if name != "token_files":
                assert made.columns == docs.columns
                docs = made.cache()
        n = made.count()
        assert n == docs.count() and (n > 0) == (len(table.take(1)) > 0)


def test_untrained_network_rejects_nothing(spark):
    docs = documents(spark, ["a b", "c " * 500, None])
    assert toxicity.drop_toxic(docs, toxicity.train([("only one class", 0)])).count() == 3


def test_sample_reads_its_own_columns(spark):
    docs = documents(spark, ["good text", "bad text"], ["toxic", "quality"])
    labels = spark.createDataFrame([(0, 0, "x"), (1, 1, "y")], "doc_id bigint, toxic int, text string")
    assert toxicity.sample(docs, labels) == [("good text", 0), ("bad text", 1)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_other_tokenizer_files(spark, name):
    path = public_tokenizers.path(name)
    texts = ["Some Words, and  blanks\n", "", None, "x" * 50, "naïve é"]
    folder = work_folder(spark)
    tokens.write_token_files(documents(spark, texts), folder, path)
    found = {r["doc_id"]: list(r["ids"]) for r in tokens.read_token_files(spark, folder, with_ids=True).collect()}
    plain = Tokenizer.from_file(path)
    assert found == {i: plain.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}


def test_ids_above_two_bytes_take_four(spark):
    assert tokens.id_width(TOKENIZER, 0) == 2 and tokens.id_width(TOKENIZER, 70_000) == 4


def test_stages_one_by_one(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    network = queries.train_toxicity(spark, docs, small)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxic_documents", "near_duplicates", "decontamination", "mixing_sources", "token_files"]
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(stage(spark, made[-1], small).cache())
    ids = [sorted(r["doc_id"] for r in df.collect()) for df in made]
    assert all(df.columns == docs.columns for df in made[:-1])
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, network).collect()}
    assert ids[1] == [i for i in ids[0] if scores[i] < toxicity.THRESHOLD]
    groups = neardup.near_duplicates(made[1], size=5).collect()
    assert ids[2] == sorted(r["doc_id"] for r in groups if r["doc_id"] == r["component_id"])
    hit = {r["doc_id"] for r in decontaminate.contamination(made[2], benchmark).collect() if r["n_hit"]}
    assert hit and ids[3] == [i for i in ids[2] if i not in hit]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixing_plan(made[3]).collect()}
    assert collections.Counter(ids[4]) == collections.Counter({i: n for i, n in copies.items() if n})
    assert ids[5] == ids[4]
    last = made[5].orderBy("start").collect()
    assert [r["start"] for r in last] == list(itertools.accumulate([0, *(r["n_tokens"] for r in last[:-1])]))
    assert collections.Counter(corpus_pipeline.run(spark, small).collect()) == collections.Counter(last)
