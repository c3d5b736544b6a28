"""Token ids in binary files with a shared zstandard dictionary.

A dictionary is trained on a bounded sample of serialised id arrays. Every document is one
zstandard frame made with that dictionary, so that a single short document can be read alone. A
file is one binary value of bounded size::

    magic "WLTK1" | id width u8 | documents u32 | SHA-256 of the dictionary
    null flags u8[n] | doc_id i64[n] | ids per document u32[n] | frame offsets u64[n + 1] | frames

Numbers are little-endian. Files are the rows of a Parquet table (``part``, ``seq`` give the order
of doc_id), which every Spark executor can read and write, wherever the table is stored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardline.llm.common import pick, rows_of

MAGIC = b"WLTK1"
END_ID = 0
FILE_BYTES = 8 << 20
# The dictionary is fitted on so many documents, and on so many characters of a longer one.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 8192
DICTIONARY_BYTES = 64 << 10
# Words a worker remembers; a full memory is emptied.
MAX_WORDS = 1_000_000

FILE_SCHEMA = "part int, seq int, first_id bigint, n_docs int, n_tokens bigint, content binary"

_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", "[.,;:!?]+"
_SIMPLE = re.compile(rf"({_LETTERS})({_MARKS})?((?:\n{_LETTERS}(?:{_MARKS})?)*)")
_AFTER = re.compile(rf"\n|{_LETTERS}|{_MARKS}")
_BLANK = "\u0120"  # stands for a blank in a byte-level vocabulary
_WORKER: dict[tuple[str, int, int], "Encoder"] = {}


class Pieces(dict):
    """Serialised ids of pieces of the pre-tokenizer, straight from the merges."""

    def __init__(self, tokenizer, code: str, limit: int):
        super().__init__()
        self.merge, self.code, self.letters, self.limit = tokenizer.model.tokenize, code, _byte_letters(), limit

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        made = self[piece] = self.encode(piece)
        return made

    def encode(self, piece: str) -> bytes:
        tokens = self.merge(piece.encode().decode("latin-1").translate(self.letters))
        return array(self.code, [t.id for t in tokens]).tobytes()


class Words(dict):
    """Serialised ids of a blank with the word after it; what is not known yet is encoded and remembered.

    Most words are letters with marks after them, some followed by a new line and another word. The
    pre-tokenizer cuts these into pieces as ``_SIMPLE`` does. All others go through the tokenizer.
    """

    def __init__(self, tokenizer, code: str, limit: int):
        super().__init__()
        self.tokenizer, self.code, self.limit, self.pieces = tokenizer, code, limit, Pieces(tokenizer, code, limit // 10)

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise KeyError(word)  # white space next to a blank
        if len(self) >= self.limit:
            self.clear()
        if word.isascii() and word.isalpha():
            made = array(self.code, [t.id for t in self.pieces.merge(_BLANK + word)]).tobytes()
        elif word[:-1].isalpha() and word[-1] in ".,;:!?" and word.isascii():
            made = self[word[:-1]] + self.pieces[word[-1]]
        elif found := _SIMPLE.fullmatch(word):
            letters, marks, after = found.groups()
            if not marks and not after:
                made = self.pieces.encode(" " + letters)
            else:
                made = self[letters] + (self.pieces[marks] if marks else b"")
                for piece in _AFTER.findall(after or ""):
                    made += self.pieces[piece]
        else:
            made = array(self.code, self.tokenizer.encode(" " + word, add_special_tokens=False).ids).tobytes()
        self[word] = made
        return made


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def plain_bytes(tokenizer) -> bool:
    """Is it a byte-level vocabulary with merges alone: no normalizer, no blank put first, no special texts that span blanks."""
    told = json.loads(tokenizer.to_str())
    first, model = told.get("pre_tokenizer") or {}, told["model"]
    return (
        told.get("normalizer") is None
        and first.get("type") == "ByteLevel"
        and not first.get("add_prefix_space")
        and first.get("use_regex", True)
        and model.get("type", "BPE") == "BPE"
        and not model.get("dropout")
        and not model.get("continuing_subword_prefix")
        and not model.get("end_of_word_suffix")
        and not model.get("ignore_merges")
        and not any(" " in t["content"] or t["content"].isspace() for t in told.get("added_tokens", []))
    )


def id_width(tokenizer_path: str, end_id: int) -> int:
    """Bytes that hold the ids of a tokenizer file and the end id."""
    from tokenizers import Tokenizer

    highest = max([end_id, *Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values()])
    return 2 if highest < 1 << 16 else 4


class Encoder:
    """Texts to serialised ids by a byte-level tokenizer file of the tokenizers library.

    Its pre-tokenizer starts a new piece at every blank that stands between two characters that are
    not white space, and merges stay within a piece. So the ids of a blank with the word after it do
    not depend on the rest. Texts with white space next to a blank go through the library as a whole.
    """

    def __init__(self, path: str, width: int, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code = "H" if width == 2 else "I"
        # what is said above holds for this pre-tokenizer alone; other files go through the library text by text
        self.plain = plain_bytes(self.tokenizer)
        self.words = Words(self.tokenizer, self.code, max_words)

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.plain:
            return self._whole(text)
        first, *rest = text.split(" ")
        if rest and first[-1:].isspace():
            return self._whole(text)
        try:
            return self._whole(first) + b"".join(map(self.words.__getitem__, rest))
        except KeyError:
            return self._whole(text)


def encoder(path: str, width: int, max_words: int = MAX_WORDS) -> Encoder:
    """One per Python worker, tokenizer file and number of words to remember."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = (path, width, max_words)
    if key not in _WORKER:
        _WORKER[key] = Encoder(*key)
    return _WORKER[key]


def train_dictionary(docs: DataFrame, path: str, width: int, max_words: int = MAX_WORDS) -> bytes:
    """Dictionary for id arrays; a plain concatenation where there is too little to train on.

    The sample is the ``SAMPLE_DOCS`` documents of smallest hash among all, whatever the order of the rows, and of a
    text longer than ``SAMPLE_CHARS`` a passage of that length at a hashed place. It shapes the compression only;
    every document is written whole.
    """
    # rows below the bound are some three times the sample, so tasks neither cut nor send many more
    bound = min(2**63 - 1, round(3 * SAMPLE_DOCS / max(1, docs.count()) * 2**64) - 2**63)
    room = F.length("text") - SAMPLE_CHARS
    begin = F.when(room > 0, F.pmod(F.col("h"), room + 1)).otherwise(0).cast("int")
    hashed = docs.select(F.xxhash64("doc_id", "text").alias("h"), "text").filter((F.col("h") <= bound) & (F.length("text") > 0))
    passages = hashed.select("h", F.substring("text", begin + 1, F.lit(SAMPLE_CHARS)).alias("passage"))
    rows = passages.orderBy("h", "passage").limit(SAMPLE_DOCS).select("passage").collect()
    made = encoder(path, width, max_words)
    arrays = [made.ids(r[0]) for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:
        return b"".join(arrays)[:DICTIONARY_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    known = _dictionary(data)
    return zstandard.ZstdCompressor(level=3, dict_data=known) if known else zstandard.ZstdCompressor(level=3)


def _decompressor(data: bytes) -> zstandard.ZstdDecompressor:
    known = _dictionary(data)
    return zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()


def pack(doc_ids: list[int | None], counts: list[int], frames: list[bytes], width: int, dictionary_hash: bytes) -> bytes:
    offsets = np.cumsum([0, *map(len, frames)], dtype="<u8")
    return b"".join(
        [
            MAGIC, struct.pack("<BI", width, len(frames)), dictionary_hash,
            np.array([x is None for x in doc_ids], np.uint8).tobytes(),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array(counts, "<u4").tobytes(), offsets.tobytes(), *frames,
        ]
    )


class TokenFile:
    """Reader of one file; ``ids(i)`` decompresses a single document."""

    def __init__(self, content: bytes, dictionary: bytes):
        if content[:5] != MAGIC:
            raise ValueError("not a token file")
        self.width, n = struct.unpack_from("<BI", content, 5)
        if content[10:42] != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        at = 42
        null = np.frombuffer(content, np.uint8, n, at)
        values = np.frombuffer(content, "<i8", n, at + n)
        self.doc_ids = [None if x else int(v) for x, v in zip(null, values, strict=True)]
        self.counts = np.frombuffer(content, "<u4", n, at + 9 * n)
        self.offsets = np.frombuffer(content, "<u8", n + 1, at + 13 * n)
        self.start = at + 13 * n + 8 * (n + 1)
        self.content, self.reader = content, _decompressor(dictionary)

    def ids(self, i: int) -> np.ndarray:
        a, b = self.start + int(self.offsets[i]), self.start + int(self.offsets[i + 1])
        data = self.reader.decompress(self.content[a:b], max_output_size=max(1, int(self.counts[i]) * self.width))
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, vocabulary: int | None = None,
    file_bytes: int = FILE_BYTES, doc_id: str = "doc_id", text: str = "text",
    max_words: int = MAX_WORDS,
) -> None:
    """Encode every whole text, append ``end_id``, and write files in ascending order of doc_id.

    Null and empty texts give the end id alone. Rows of one doc_id stay next to each other, null ids
    come first; an empty table gives no file. Other columns are not read. The width of an id follows from the
    tokenizer file unless the size of the ``vocabulary`` is given. ``max_words`` bounds the words that a
    worker remembers (250 bytes each), which costs time, not rows.
    """
    width = id_width(tokenizer_path, end_id) if vocabulary is None else 2 if vocabulary <= 1 << 16 else 4
    narrow = pick(docs, doc_id=F.col(doc_id).cast("bigint"), text=F.col(text).cast("string"))
    dictionary = train_dictionary(narrow, tokenizer_path, width, max_words)
    digest, end = hashlib.sha256(dictionary).digest(), end_id.to_bytes(width, "little")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(dictionary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, squeeze, part = encoder(tokenizer_path, width, max_words), _compressor(shared.value), TaskContext.get().partitionId()
        ids, counts, frames, size, seq = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            row = [[part], [seq], [ids[0]], [len(ids)], [sum(counts)], [pack(ids, counts, frames, width, digest)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                names=["part", "seq", "first_id", "n_docs", "n_tokens", "content"],
            )

        for batch in rows_of(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                coded = made.ids(text) + end
                frame = squeeze.compress(coded)
                ids.append(key)
                counts.append(len(coded) // width)
                frames.append(frame)
                size += len(frame)
                if size >= file_bytes:
                    yield flush()
                    ids, counts, frames, size, seq = [], [], [], 0, seq + 1
        if ids:
            yield flush()

    # rows of one id, or without one, may be many: ranges of (id, hash) spread them over tasks
    order = ["doc_id", F.xxhash64("text")]
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(encode, FILE_SCHEMA).write.parquet(f"{path}/files")
    spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.schema("dictionary binary").parquet(f"{path}/dictionary").first()[0])


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the files alone: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``."""
    shared = spark.sparkContext.broadcast(read_dictionary(spark, path))
    files = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/files")
    kinds = [("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    kinds += [("ids", pa.list_(pa.int32()))] if with_ids else []

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file = TokenFile(content, shared.value)
                n = len(file.doc_ids)
                before = np.cumsum(file.counts, dtype=np.int64) - file.counts
                arrays = (file.ids(i) for i in range(n))
                made = [(zlib.crc32(a.tobytes()), a.astype(np.int32) if with_ids else None) for a in arrays]
                columns = [[part] * n, [seq] * n, file.doc_ids, before, file.counts.astype(np.int64), [c for c, _ in made]]
                columns += [[a for _, a in made]] if with_ids else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, (_, k) in zip(columns, kinds, strict=True)], names=[x for x, _ in kinds]
                )

    schema = "part int, seq int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    rows = files.select("part", "seq", "content").mapInArrow(decode, schema)
    # The number of parts is that of the writing tasks; files are summed within their part.
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    until = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(until), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "seq", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("file_start"))
    return (
        rows.join(starts.join(base, "part"), ["part", "seq"])
        .withColumn("start", F.col("part_start") + F.col("file_start") + F.col("before"))
        .select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
    )


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (of each row with that id), by the offset index of the files that can hold it."""
    dictionary = read_dictionary(spark, path)
    files = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/files")
    at_or_before = files.filter(F.col("first_id") < doc_id).agg(F.max("first_id")).first()[0]
    low = doc_id if at_or_before is None else at_or_before
    found = []
    holding = files.filter(F.coalesce("first_id", F.lit(low)).between(low, doc_id)).orderBy("part", "seq")
    for row in holding.select("content").toLocalIterator():
        file = TokenFile(bytes(row[0]), dictionary)
        found += [file.ids(i) for i, key in enumerate(file.doc_ids) if key == doc_id]
    return found
