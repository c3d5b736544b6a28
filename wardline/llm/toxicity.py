"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of the hashed embeddings of its character trigrams next to a hashed
embedding of the word. Two gated recurrent layers read a window of words forwards and backwards,
attention pools their states, and a logistic unit scores the window. Windows of 32 words are scored at
every 16th word of a text, so passages of up to 17 words lie whole in one; the text's score is that of
its worst window.

The network is trained on a bounded sample of labelled documents; every document is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import pick, rows_of, utf8

WINDOW, STRIDE = 32, 16
HIDDEN = 8
WORD_SIZE, CHAR_SIZE = 8, 12
WORD_ROWS, CHAR_ROWS = 1 << 13, 1 << 14
# The bound of the training sample: toxic documents (of the others twice as many), and characters of one document.
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 20_000
STEPS, BATCH, RATE = 600, 48, 0.01
# Steps at which the hardest documents that are not toxic are looked up.
MINING = {200, 300, 400, 500}
THRESHOLD = 0.3
CHUNK = 8192

_LOWER = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(_LOWER).split()


class Numbers(dict):
    """Words numbered from 1 as they come; 0 is padding."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word numbers, hashed trigrams of all words one after the other, and each word's first trigram."""
    lengths = np.array([len(w) for w in words], np.int64)
    # every word stands between < and > and has as many trigrams as bytes
    data = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(np.uint64)
    rolled = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
    ends = np.cumsum(lengths + 2)
    inside = np.ones(len(data), bool)
    inside[ends - 1] = inside[ends - 2] = False
    trigrams = (rolled[inside[:-2]] * _MIX >> np.uint64(40)) % np.uint64(CHAR_ROWS)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    # a word's number mixes its trigrams with their places
    place = np.arange(len(trigrams)) - np.repeat(starts, lengths)
    mixed = (rolled[inside[:-2]] + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _MIX
    mixed = (mixed ^ mixed >> np.uint64(29)) * _MIX
    hashed = (np.add.reduceat(mixed, starts) >> np.uint64(40)) % np.uint64(WORD_ROWS)
    return hashed.astype(np.int64), trigrams.astype(np.int64), starts


def windows_of(numbers: np.ndarray) -> np.ndarray:
    """All windows of one text, each overlapping the next by half; the last is padded with 0."""
    n = len(numbers)
    count = 1 + max(0, -(-(n - WINDOW) // STRIDE))
    padded = np.zeros((count - 1) * STRIDE + WINDOW, np.int32)
    padded[:n] = numbers
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name; ``f`` and ``b`` are the two directions."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        size = WORD_SIZE + CHAR_SIZE

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        # unseen words and trigrams say next to nothing
        p = {"word": normal(WORD_ROWS, WORD_SIZE, scale=0.01), "char": normal(CHAR_ROWS, CHAR_SIZE, scale=0.01)}
        for side in "fb":
            p[f"w{side}"] = normal(size, 3 * HIDDEN, scale=size**-0.5)
            p[f"u{side}"] = normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5)
            p[f"c{side}"] = np.zeros(3 * HIDDEN, np.float32)
        return cls(p | {"attend": normal(2 * HIDDEN, scale=0.1), "out": normal(2 * HIDDEN, scale=0.5), "bias": np.full(1, -1, np.float32)})

    def inputs(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Vectors of the words, with a row of zeros for the padding in front."""
        hashed, trigrams, starts = features
        out = np.zeros((len(hashed) + 1, WORD_SIZE + CHAR_SIZE), np.float32)
        out[1:, :WORD_SIZE] = self.p["word"][hashed]
        for at in range(0, len(starts), 1 << 15):  # in pieces, as a word has many trigrams
            a, b = starts[at], starts[at + (1 << 15)] if at + (1 << 15) < len(starts) else len(trigrams)
            out[1 + at : 1 + at + (1 << 15), WORD_SIZE:] = np.add.reduceat(
                self.p["char"][trigrams[a:b]], starts[at : at + (1 << 15)] - a, axis=0
            )
        return out

    def _read(self, side: str, projected: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States of one direction, (windows, places, hidden)."""
        n, places = ids.shape
        u, h = self.p[f"u{side}"], np.zeros((n, HIDDEN), np.float32)
        states = np.empty((places, n, HIDDEN), np.float32)
        for t in range(places) if side == "f" else range(places - 1, -1, -1):
            g, hu = projected[ids[:, t]], h @ u
            gates = _sigmoid(g[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(g[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, new, hu[:, 2 * HIDDEN :]))
            h = (new + z * (h - new)) * mask[:, t : t + 1]
            states[t] = h
        return states

    def logits(self, vectors: np.ndarray, ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Log-odds of every window."""
        mask = (ids > 0).astype(np.float32)
        kept = {"f": None, "b": None} if keep is None else {"f": [], "b": []}
        projected = {s: vectors @ self.p[f"w{s}"] + self.p[f"c{s}"] for s in "fb"}
        states = np.concatenate([self._read(s, projected[s], ids, mask, kept[s]) for s in "fb"], axis=2)
        e = states @ self.p["attend"] + (mask.T - 1) * 1e9
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        if keep is not None:
            keep.update(mask=mask, states=states, a=a, pooled=pooled, **kept)
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gradients(
        self, features, ids: np.ndarray, labels: np.ndarray, known: np.ndarray | None = None
    ) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of windows and its gradient, back through time.

        Words that are not ``known`` enter by their characters only.
        """
        vectors, k = self.inputs(features), {}
        if known is not None:
            vectors[1:, :WORD_SIZE] *= known[:, None]
        scores = _sigmoid(self.logits(vectors, ids, k))
        loss = -np.log(np.where(labels > 0, scores, 1 - scores) + 1e-7).mean()
        d = ((scores - labels) / len(labels)).astype(np.float32)
        g = {"out": d @ k["pooled"], "bias": d.sum(keepdims=True)}
        d_pooled = d[:, None] * self.p["out"]
        inner = np.einsum("tnh,nh->tn", k["states"], d_pooled)
        d_e = k["a"] * (inner - (k["a"] * inner).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", d_e, k["states"])
        d_states = k["a"][:, :, None] * d_pooled[None] + d_e[:, :, None] * self.p["attend"]
        d_vectors = np.zeros_like(vectors)
        for i, side in enumerate("fb"):
            d_side = d_states[:, :, i * HIDDEN : (i + 1) * HIDDEN]
            u, w = self.p[f"u{side}"], self.p[f"w{side}"]
            d_u, d_g, back = np.zeros_like(u), np.zeros((len(vectors), 3 * HIDDEN), np.float32), 0.0
            for t, h, z, r, new, hu in reversed(k[side]):
                d_h = (d_side[t] + back) * k["mask"][:, t : t + 1]
                d_new = d_h * (1 - z) * (1 - new**2)
                d_z = d_h * (h - new) * z * (1 - z)
                d_r = d_new * hu * r * (1 - r)
                d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_u += h.T @ d_hu
                back = d_h * z + d_hu @ u.T
                np.add.at(d_g, ids[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
            d_g[0] *= 0
            g |= {f"u{side}": d_u, f"w{side}": vectors.T @ d_g, f"c{side}": d_g.sum(axis=0)}
            d_vectors += d_g @ w.T
        hashed, trigrams, starts = features
        if known is not None:
            d_vectors[1:, :WORD_SIZE] *= known[:, None]
        g["word"], g["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
        np.add.at(g["word"], hashed, d_vectors[1:, :WORD_SIZE])
        lengths = np.diff(np.append(starts, len(trigrams)))
        np.add.at(g["char"], trigrams, np.repeat(d_vectors[1:, WORD_SIZE:], lengths, axis=0))
        return float(loss), g


def _batch(texts: list[np.ndarray], vocabulary: list[bytes]) -> tuple[tuple, np.ndarray, np.ndarray]:
    """Features of the words of some texts, their windows, and the text of each window."""
    windows = [windows_of(t) for t in texts]
    used, ids = np.unique(np.concatenate(windows), return_inverse=True)
    ids = ids.reshape(-1, WINDOW)
    words = [vocabulary[i - 1] for i in used if i]
    shift = 0 if used[0] == 0 else 1
    owner = np.repeat(np.arange(len(texts)), [len(w) for w in windows])
    return word_features(words), (ids + shift).astype(np.int32), owner


def _text_logits(network: Network, texts: list[np.ndarray], vocabulary: list[bytes]) -> np.ndarray:
    """Log-odds of each text's worst window."""
    features, ids, owner = _batch(texts, vocabulary)
    vectors, out = network.inputs(features), np.full(len(texts), -np.inf)
    for at in range(0, len(ids), CHUNK):
        np.maximum.at(out, owner[at : at + CHUNK], network.logits(vectors, ids[at : at + CHUNK]))
    return out


def train(rows: list[tuple[str | None, int]], seed: int = 7) -> Network:
    """Fit by Adam for a fixed number of steps, the rate falling to nothing.

    A third of each batch is toxic. First random windows carry their document's label, then the
    window that scores highest now does; half of the other documents then come from those that score
    highest. Most words of a step are shown by their characters only, so that these are learned too.
    Without both classes the network stays untrained and scores every text next to 0.
    """
    network, rng = Network.fresh(seed), np.random.default_rng(seed)
    numbers = Numbers()
    texts = [(np.array([numbers[w] for w in words_of(t)], np.int32), y) for t, y in rows]
    classes = [[t for t, y in texts if y == label and len(t)] for label in (0, 1)]
    if not all(classes):
        network.p["bias"] = np.full(1, -50, np.float32)
        return network
    vocabulary = list(numbers)
    first = {k: np.zeros_like(v) for k, v in network.p.items()}
    second = {k: np.zeros_like(v) for k, v in network.p.items()}
    hard: list[np.ndarray] = []
    for step in range(1, STEPS + 1):
        if step in MINING:
            scores = np.concatenate([_text_logits(network, classes[0][i : i + 200], vocabulary) for i in range(0, len(classes[0]), 200)])
            hard = [classes[0][i] for i in np.argsort(-scores, kind="stable")[: BATCH * 2]]
        labels = np.arange(BATCH) % 3 == 0
        pools = [classes[1] if y else hard if hard and i % 3 == 1 else classes[0] for i, y in enumerate(labels)]
        chosen = [pool[rng.integers(len(pool))] for pool in pools]
        features, ids, owner = _batch(chosen, vocabulary)
        if step < min(MINING):
            picked = rng.permutation(len(ids))[: 8 * BATCH]
        else:
            scores = network.logits(network.inputs(features), ids)
            order = np.lexsort((-scores, owner))
            picked = order[np.concatenate(([True], np.diff(owner[order]) > 0))]
        used, ids = np.unique(np.append(ids[picked], 0), return_inverse=True)
        hashed, trigrams, starts = features
        ends = np.append(starts[1:], len(trigrams))
        words = used[1:] - 1
        parts = [trigrams[starts[w] : ends[w]] for w in words]
        small = np.concatenate(parts), np.cumsum([0, *map(len, parts)])[:-1]
        ids = ids[:-1].reshape(-1, WINDOW)
        _, g = network.gradients((hashed[words], *small), ids, labels[owner[picked]].astype(np.float32), rng.random(len(words)) < 0.3)
        rate = RATE * min(1, step / 20) * (1 - step / (STEPS + 1))
        norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
        for k, v in g.items():
            v = v * min(1.0, 1.0 / (norm + 1e-9))
            first[k] += 0.1 * (v - first[k])
            second[k] += 0.01 * (v * v - second[k])
            network.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return network


def score_texts(network: Network, texts: list[str | None]) -> np.ndarray:
    """Score of every text: the highest probability of its windows; 0 without words."""
    numbers = Numbers()
    arrays = [np.fromiter(map(numbers.__getitem__, words_of(t)), np.int32) for t in texts]
    out = np.zeros(len(texts))
    filled = [i for i, a in enumerate(arrays) if len(a)]
    if not filled:
        return out
    vectors = network.inputs(word_features(list(numbers)))
    windows = [windows_of(arrays[i]) for i in filled]
    owner = np.repeat(filled, [len(w) for w in windows])
    ids = np.concatenate(windows)
    for at in range(0, len(ids), CHUNK):
        scores = _sigmoid(network.logits(vectors, ids[at : at + CHUNK]).astype(np.float64))
        np.maximum.at(out, owner[at : at + CHUNK], scores)
    return out


def sample(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> list[tuple[str | None, int]]:
    """At most ``SAMPLE_DOCS`` toxic and twice as many other documents, those with the smallest hashes.

    Rows with a null id or label are left out; a document labelled both ways is in both classes.
    Documents over ``SAMPLE_CHARS`` characters are not trained on. Other columns are not read.
    """
    told = pick(labels, doc_id=F.col(f"`{doc_id}`"), toxic=F.col(f"`{label}`"))
    known = told.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = known.filter("toxic = 1").orderBy(*order).limit(SAMPLE_DOCS)
    chosen = chosen.union(known.filter("toxic = 0").orderBy(*order).limit(2 * SAMPLE_DOCS))
    # at most three times SAMPLE_DOCS rows of two numbers are broadcast
    narrow = pick(docs, doc_id=F.col(f"`{doc_id}`"), text=F.col(f"`{text}`").cast("string"))
    texts = narrow.filter(F.length("text").between(1, SAMPLE_CHARS)).join(F.broadcast(chosen), "doc_id")
    found = texts.select("doc_id", "text", "toxic").distinct().collect()
    return [(r["text"], r["toxic"]) for r in sorted(found, key=lambda r: (r["doc_id"], r["toxic"], r["text"]))]


def _scores(docs: DataFrame, network: Network, text: str, schema: str, keep_below: float | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(network.p)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(shared.value)
        for batch in rows_of(batches):
            scores = score_texts(network, batch.column(at).to_pylist())
            if keep_below is None:
                others = [c for i, c in enumerate(batch.columns) if i != at]
                names = [n for i, n in enumerate(batch.schema.names) if i != at]
                yield pa.RecordBatch.from_arrays([*others, pa.array(scores)], names=[*names, "score"])
            else:
                yield batch.filter(pa.array(scores < keep_below))

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, network: Network, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` of every row; null, empty and blank texts score 0. Other columns are not read."""
    kept = pick(docs, doc_id=F.col(doc_id).cast("bigint"), text=F.col(text).cast("string"))
    return _scores(kept, network, "text", "doc_id bigint, score double", None)


def drop_toxic(docs: DataFrame, network: Network, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents that score below the threshold, all columns as they were."""
    return _scores(docs, network, text, docs.schema, threshold)
