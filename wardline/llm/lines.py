"""Quality rules by the frequency of lines across documents.

Lines are normalised (A-Z lower-cased, white space collapsed) and hashed. For every host the
documents that hold a line are counted; lines in more documents than the limit are boilerplate and
removed, and a document that loses too much of its words is rejected. Only DataFrame functions are
used; lines are counted by partial aggregation, and only hashes are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardline.llm.common import lower_ascii, pick, store, word_array

# Documents of one host a line may be in.
MAX_DOCS = 20
# Percentage of its words a document has to keep.
KEEP_PERCENT = 50

_BLANKS = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"


def let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def chars_without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(lower_ascii(line), r"[\x20\x09-\x0D]+", " "))


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that are in the text twice or more.

    A window is a number: the upper bits of its hash, the lower bits its place. Sorting the numbers
    brings equal upper bits together, and windows that share them are compared word by word: where a run of
    equal bits has one neighbour only that one, in a longer run all pairs of different windows.
    """
    n = F.size(words)
    bits = F.ceil(F.log2((n + 1).cast("double"))).cast("int")

    def in_text(w: Column) -> Column:
        def shifted(shift: Column) -> Column:
            def number(i: Column) -> Column:
                h = F.xxhash64(w[i], w[i + 1], w[i + 2])
                # shift() of the expression API takes column amounts
                high = F.call_function("shiftleft", F.call_function("shiftright", h, shift), shift)
                return high.bitwiseOR(i.cast("bigint"))

            def place(x: Column) -> Column:
                return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), shift) - 1).cast("int")

            def found(s: Column) -> Column:
                high = lambda j: F.call_function("shiftright", s[j], shift)
                near = F.filter(F.sequence(F.lit(0), F.size(s) - 2), lambda j: high(j) == high(j + 1))

                def equal(a: Column, b: Column) -> Column:
                    return (w[a] == w[b]) & (w[a + 1] == w[b + 1]) & (w[a + 2] == w[b + 2])

                pairs = F.transform(near, lambda j: F.array(place(s[j]), place(s[j + 1])))
                same = F.filter(pairs, lambda p: equal(p[0], p[1]))
                # neighbours with equal bits that differ: in their run equal windows need not be neighbours
                mixed = F.array_distinct(F.transform(F.filter(near, lambda j: ~equal(place(s[j]), place(s[j + 1]))), high))
                run = lambda m: F.transform(F.filter(s, lambda x: F.call_function("shiftright", x, shift) == m), place)
                again = lambda r: F.filter(r, lambda a: F.exists(r, lambda b: (a != b) & equal(a, b)))
                others = F.flatten(F.transform(mixed, lambda m: again(run(m))))
                starts = F.sort_array(F.array_distinct(F.concat(F.flatten(same), others)))
                return F.when(F.size(near) == 0, F.lit(0)).otherwise(let(starts, covered))

            numbers = F.transform(F.sequence(F.lit(0), F.size(w) - 3), number)
            return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(F.sort_array(numbers), found))

        return let(bits, shifted)

    def covered(starts: Column) -> Column:
        widths = F.transform(
            starts,
            lambda x, i: F.when(i + 1 < F.size(starts), F.least(F.lit(3), starts[i + 1] - x)).otherwise(F.lit(3)),
        )
        return F.aggregate(widths, F.lit(0), lambda a, x: a + x)

    return let(words, in_text)


def line_table(docs: DataFrame, host: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its numbers, and its lines with a word as ``lines array<struct<hash, n_words, copies>>``.

    ``row`` numbers the rows; each row counts as a document of its own. Null texts have no words;
    null hosts are one host. Other columns are not read.
    """
    kept = pick(docs, doc_id=F.col(doc_id), host=F.col(host), text=F.coalesce(F.col(text), F.lit("")))
    with_words = F.filter(F.split("text", "\n"), lambda x: chars_without(x, _BLANKS) > 0)
    narrow = kept.withColumns({"w": word_array(F.col("text")), "ls": with_words})
    hashes = F.transform("ls", lambda x: F.xxhash64(normal_line(x)))
    counts = F.transform("ls", lambda x: F.size(word_array(x)))
    return narrow.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "host",
        F.size("w").cast("bigint").alias("n_words"),
        chars_without(F.col("text"), _BLANKS).cast("bigint").alias("word_chars"),
        (F.char_length("text") - chars_without(F.col("text"), _SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("w")).cast("bigint").alias("n_repeat_words"),
        hashes.alias("hashes"),
        counts.alias("counts"),
    )


def judge_lines(
    docs: DataFrame, max_docs: int = MAX_DOCS, keep_percent: int = KEEP_PERCENT, host: str = "source",
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: its numbers, ``removed_words``, the hashes of the ``removed`` lines, and ``depleted``.

    A document without words is not depleted; one whose remaining words are less than
    ``keep_percent`` of its words is.
    """
    # Numbers of rows stay the same from here on, because the table is stored.
    rows = store(line_table(docs, host, doc_id, text))
    lines = rows.select("row", "host", F.explode(F.arrays_zip("hashes", "counts")).alias("l")).select(
        "row", F.coalesce("host", F.lit("")).alias("host"), F.col("host").isNull().alias("none"),
        F.col("l.hashes").alias("hash"), F.col("l.counts").alias("words"),
    )
    key = ["none", "host", "hash"]
    # A document's copies of a line become one row before documents are counted.
    held = rows.select("host", F.explode(F.array_distinct("hashes")).alias("hash")).select(
        F.col("host").isNull().alias("none"), F.coalesce("host", F.lit("")).alias("host"), "hash"
    )
    frequent = store(held.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_docs).select(*key))
    lost = (
        lines.join(frequent, key, "left_semi")
        .groupBy("row")
        .agg(F.sum("words").cast("bigint").alias("removed_words"), F.collect_set("hash").alias("removed"))
    )
    out = rows.drop("hashes", "counts").join(lost, "row", "left").drop("row")
    out = out.withColumns(
        {
            "removed_words": F.coalesce("removed_words", F.lit(0).cast("bigint")),
            "removed": F.coalesce("removed", F.array().cast("array<bigint>")),
        }
    )
    left = (F.col("n_words") - F.col("removed_words")) * 100
    return out.withColumn("depleted", left < F.col("n_words") * keep_percent)


def strip_lines(text: Column, removed: Column) -> Column:
    """The text without the lines of the given hashes; other lines stay as they are."""
    kept = F.filter(
        F.split(text, "\n"),
        lambda x: ~((chars_without(x, _BLANKS) > 0) & F.array_contains(removed, F.xxhash64(normal_line(x)))),
    )
    return F.array_join(kept, "\n")
