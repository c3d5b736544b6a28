"""Hidden Markov language model.

Latent states emit word classes, and a class emits its words by their counts in the training
corpus, so the states stay small while every word of the corpus has its own probability. A class
is one of the most frequent words, the end, or the rarer and unknown words with the same ending.

* Texts are cut once into blocks of a few MB, which hold their words as numbers of a vocabulary of
  their own. Words and counts of all blocks are summed into the corpus counts by a shuffle, and the
  counts a block needs come back to it by its number.
* Baum-Welch: every task runs the scaled forward and backward recursions over its blocks and adds
  up expected counts; these are summed over the tasks. Every iteration runs over all training texts. In
  the first, which starts from states that differ by chance only, a block takes its texts in small turns, and
  each turn is judged by what the turns before it have taught.
* The score is the exact likelihood: scaled forward recursion over a whole text, in log10.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import Stored, pick, rows_of, utf8

STATES = 8
# Classes of the model: the most frequent words, the end, and the endings of all other words.
TOP_WORDS = 8192
TAIL_CLASSES = 4096
END_CLASS = TOP_WORDS + TAIL_CLASSES
CLASSES = END_CLASS + 1
# Iterations after the first one, which goes by turns.
ITERATIONS = 2
BLOCK_BYTES = 20 << 20
# Tokens of the texts that go through the recursions together, unless one text has more.
TURN_TOKENS = 1 << 19
# The same in the first iteration, in which a block has so many turns or more, unless these get very short.
FIRST_TOKENS, FIRST_TURNS, LEAST_TOKENS = 1 << 18, 16, 1 << 12
# Weight of the corpus-wide class shares in the emissions of a state.
PRIOR = 20.0
END = b"\n"  # no word holds it

_LOWER = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))

BLOCKS = (
    "block bigint, doc_ids array<bigint>, train array<boolean>, lengths array<int>, ids binary, tails binary, "
    "words array<binary>, counts array<bigint>"
)
CODED = (
    "block bigint, doc_ids array<bigint>, train array<boolean>, lengths array<int>, classes binary, known array<int>, "
    "base array<double>, inner array<double>"
)


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(_LOWER).split()


class Numbers(dict):
    """Words numbered from 0 as they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def tail_class(word: bytes) -> int:
    """Class of a word that is not frequent, by its last three bytes; of the end, its own."""
    if word == END:
        return END_CLASS
    value = int.from_bytes(word[-3:], "little") + 1
    return TOP_WORDS + value * 2654435761 % (1 << 32) % TAIL_CLASSES


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts; the number of the task and of the block within it make its key."""
    task, made = TaskContext.get().partitionId(), 0
    numbers, ids, lengths, doc_ids, train, size = Numbers(), [], [], [], [], 0

    def flush() -> pa.RecordBatch:
        flat, flags = np.concatenate(ids), np.repeat(train, lengths)
        counts = np.bincount(flat[flags], minlength=len(numbers))
        tails = np.fromiter(map(tail_class, numbers), np.uint16, len(numbers)).tobytes()
        packed = zstandard.ZstdCompressor(level=1).compress(flat.tobytes())
        values = [task << 32 | made, doc_ids, train, lengths, packed, tails, list(numbers), counts]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
        names = ["block", "doc_ids", "train", "lengths", "ids", "tails", "words", "counts"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    for batch in rows_of(batches):
        for doc_id, learns, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = words_of(text)
            words.append(END)
            ids.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            lengths.append(len(words))
            doc_ids.append(doc_id)
            train.append(learns)
            size += len(text or "")
            if size >= BLOCK_BYTES:
                yield flush()
                numbers, ids, lengths, doc_ids, train, size = Numbers(), [], [], [], [], 0
                made += 1
    if ids:
        yield flush()


@dataclass
class Model:
    """Probabilities of the first state, of the next state, and of the classes by state (classes, states)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @classmethod
    def fresh(cls, share: np.ndarray, seed: int = 11) -> Model:
        """States that differ by chance only."""
        rng = np.random.default_rng(seed)
        emit = share[:, None] * np.exp(rng.standard_normal((CLASSES, STATES)))
        move = np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Model:
        start, move = start + 0.1, move + 0.1
        emit = emit + PRIOR * share[:, None]
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def forward_backward(model: Model, texts: list[np.ndarray], learn: bool = True) -> tuple[np.ndarray, tuple]:
    """Log10 likelihood of every text, and the expected counts (start, moves, emissions) of all.

    The texts, longest first, advance together; those that have ended drop out at the end.
    """
    lengths = np.array([len(t) for t in texts])
    if not len(texts) or not lengths.max():
        return np.zeros(len(texts)), (np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES)))
    order = np.argsort(-lengths, kind="stable")
    most = int(lengths.max())
    # places of one time step lie together: those of the texts longer than t, longest first
    active = np.searchsorted(-lengths[order], -np.arange(most), side="left")
    first = np.concatenate(([0], np.cumsum(active)))
    flat = np.empty(first[-1], np.int32)
    for rank, i in enumerate(order):
        flat[first[: lengths[i]] + rank] = texts[i]
    emit, move = model.emit, model.move
    log = np.zeros(len(texts))
    alphas, scales = (np.empty((len(flat), STATES)), np.empty(len(flat))) if learn else (None, None)
    state = np.broadcast_to(model.start, (active[0], STATES))
    for t in range(most):
        a, b = first[t], first[t + 1]
        state = (state[: b - a] @ move if t else state) * emit[flat[a:b]]
        scale = state.sum(axis=1)
        state = state / scale[:, None]
        log[: b - a] += np.log10(scale)
        if learn:
            alphas[a:b], scales[a:b] = state, scale
    out = np.empty(len(texts))
    out[order] = log
    if not learn:
        return out, ()
    moves, gammas = np.zeros((STATES, STATES)), np.empty((len(flat), STATES))
    back = np.ones((active[-1], STATES))
    for t in range(most - 1, -1, -1):
        a, b = first[t], first[t + 1]
        if t + 1 < most:
            c = first[t + 2]
            onward = emit[flat[b:c]] * back / scales[b:c, None]
            moves += alphas[a : a + c - b].T @ onward
            back = np.ones((b - a, STATES))
            back[: c - b] = onward @ move.T
        gammas[a:b] = alphas[a:b] * back
    counts = np.stack([np.bincount(flat, gammas[:, k], CLASSES) for k in range(STATES)], axis=1)
    return out, (gammas[: active[0]].sum(axis=0), moves * move, counts)


def _texts(classes: bytes, lengths: list[int]) -> list[np.ndarray]:
    return np.split(np.frombuffer(classes, np.uint16), np.cumsum(lengths)[:-1])


def _turns(texts: list[np.ndarray], tokens: int = TURN_TOKENS) -> Iterator[np.ndarray]:
    """The texts' numbers in parts of like lengths, so that few steps run for a few texts only."""
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    turn = np.cumsum(lengths[order]) // tokens
    yield from np.split(order, np.flatnonzero(np.diff(turn)) + 1)


def _counts_by_turns(model: Model, texts: list[np.ndarray], share: np.ndarray) -> np.ndarray:
    """Expected counts over texts in small turns, every turn by a model of the counts so far."""
    total = np.zeros((CLASSES + 1 + STATES, STATES))
    tokens = min(FIRST_TOKENS, max(LEAST_TOKENS, sum(map(len, texts)) // FIRST_TURNS))
    for part in _turns(texts, tokens) if texts else ():
        start, move, emit = forward_backward(model, [texts[i] for i in part])[1]
        total += np.concatenate([emit, start[None], move])
        model = Model.from_counts(total[CLASSES], total[CLASSES + 1 :], total[:CLASSES], share)
    return total


def _expected(model: Model, coded: DataFrame, share: np.ndarray, by_turns: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts over all training texts; the result has a row per class, start state and state."""
    shared = coded.sparkSession.sparkContext.broadcast((model, share))
    names = [f"s{k}" for k in range(STATES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES + 1 + STATES, STATES))
        for batch in batches:
            for row in batch.to_pylist():
                texts = [t for t, learns in zip(_texts(row["classes"], row["lengths"]), row["train"], strict=True) if learns]
                if by_turns:
                    total += _counts_by_turns(shared.value[0], texts, shared.value[1])
                    continue
                for part in _turns(texts) if texts else ():
                    start, move, emit = forward_backward(shared.value[0], [texts[i] for i in part])[1]
                    total += np.concatenate([emit, start[None], move])
        used = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(used.astype(np.int32)), *(pa.array(total[used, k]) for k in range(STATES))]
        yield pa.RecordBatch.from_arrays(columns, names=["place", *names])

    parts = coded.select("train", "lengths", "classes").mapInArrow(run, "place int, " + ", ".join(f"{n} double" for n in names))
    summed = parts.groupBy("place").agg(*[F.sum(n).alias(n) for n in names])
    total = np.zeros((CLASSES + 1 + STATES, STATES))
    for row in summed.collect():  # as many rows at most as the model has
        total[row["place"]] = [row[n] for n in names]
    return total[CLASSES], total[CLASSES + 1 :], total[:CLASSES]


def learn_and_score(docs: DataFrame, learns, iterations: int = ITERATIONS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows for which ``learns`` (a column of the two columns doc_id and text) is true; score all.

    One row per row: ``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score``. Null
    and empty texts are an end alone. With nothing to learn from, or an empty table, every token is
    unknown and scores follow the starting values. Other columns are not read.
    """
    spark = docs.sparkSession
    kept = pick(docs, doc_id=F.col(doc_id).cast("bigint"), text=F.col(text).cast("string"))
    kept = kept.select("doc_id", F.coalesce(learns, F.lit(False)).alias("train"), "text")
    blocks = Stored(kept.mapInArrow(_to_blocks, BLOCKS))

    def words() -> DataFrame:
        """The vocabularies of the blocks, a row per block and word."""
        entries = blocks.df.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "w"))
        return entries.select("block", "number", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))

    counts = Stored(words().groupBy("word").agg(F.sum("n").alias("c")).filter(F.col("c") > 0))
    n, v = counts.df.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    whole = n + 0.1 * (v + 1)

    end = F.col("word") == F.lit(END)
    ranked = counts.df.filter(~end).orderBy(F.desc("c"), "word").limit(TOP_WORDS).select("word").collect()
    known = spark.sparkContext.broadcast({bytes(r[0]): i for i, r in enumerate(ranked)})

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for batch in batches:
            ws = batch.column(0).to_pylist()
            found = [c if (c := get(w)) is not None else tail_class(w) for w in ws]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int32())], names=["word", "c", "class"])

    classes = Stored(counts.df.mapInArrow(classify, "word binary, c bigint, class int"))
    counts.delete()
    # A class holds its words with their smoothed counts, and room for one unknown word.
    mass = np.full(CLASSES, 0.1)
    for row in classes.df.groupBy("class").agg(F.sum(F.col("c") + 0.1).alias("m")).collect():
        mass[row["class"]] += row["m"]
    share = mass / mass.sum()
    model_mass = spark.sparkContext.broadcast(mass)

    def encode(key, block: pa.Table, dictionary: pa.Table) -> pa.Table:
        """Classes, known tokens and the parts of the score that need no states, from the counts of the block's words."""
        row = block.to_pylist()[0]
        cls = np.frombuffer(row["tails"], np.uint16).copy()
        c = np.zeros(len(cls))
        packed = dictionary.column("packed").to_numpy()
        at = packed >> 16
        c[at], cls[at] = dictionary.column("c").to_numpy(), packed & 0xFFFF
        ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["ids"]), np.uint32)
        starts = np.concatenate(([0], np.cumsum(row["lengths"])[:-1]))
        base = np.add.reduceat(np.log10((c + 0.1) / whole)[ids], starts)
        inner = np.add.reduceat(np.log10((c + 0.1) / model_mass.value[cls])[ids], starts)
        seen = np.add.reduceat((c > 0)[ids].astype(np.int32), starts)
        values = [row["block"], row["doc_ids"], row["train"], row["lengths"], cls[ids].tobytes(), seen, base, inner]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64())]
        names = ["block", "doc_ids", "train", "lengths", "classes", "known", "base", "inner"]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    # a word's number in its block and its class share one column
    packed = F.shiftleft(F.col("number").cast("bigint"), 16).bitwiseOR(F.col("class").cast("bigint")).alias("packed")
    numbered = words().select("block", "number", "word").join(classes.df, "word").select("block", packed, "c")
    joined = blocks.df.drop("counts", "words").groupBy("block").cogroup(numbered.groupBy("block"))
    coded = Stored(joined.applyInArrow(encode, CODED))
    blocks.delete()
    classes.delete()

    model = Model.fresh(share)
    for i in range(iterations + 1 if n else 0):
        model = Model.from_counts(*_expected(model, coded.df, share, by_turns=i == 0), share)
    fitted = spark.sparkContext.broadcast(model)
    schema = "doc_id bigint, learned boolean, n_tokens bigint, n_known bigint, base_score double, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = _texts(row["classes"], row["lengths"])
                log = np.zeros(len(texts))
                for part in _turns(texts):
                    log[part] = forward_backward(fitted.value, [texts[i] for i in part], learn=False)[0]
                values = [row["doc_ids"], row["train"], row["lengths"], row["known"], row["base"], log + row["inner"]]
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                names = ["doc_id", "learned", "n_tokens", "n_known", "base_score", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

    return coded.df.mapInArrow(score, schema).withColumn("train_tokens", F.lit(n).cast("bigint"))
