"""Made-up texts and tables for the tests of the operators."""

import random

# Names that the operators use themselves, as columns of a table they are given.
CLASHES = ["key", "node", "row", "size", "copies", "score", "__id", "__print", "name", "words", "c0", "d"]


def made_up(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9))) for _ in range(n))


def documents(spark, texts, extra=()):
    schema = "doc_id bigint, text string, source string" + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame([(i, t, "s", *("x" for _ in extra)) for i, t in enumerate(texts)], schema)
