"""The driver queries of the operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardline.llm import decontaminate, hmm, html, lines, merkle, mixing, neardup, packing, periodic, suffixes, tokens, toxicity, urls
from wardline.llm.common import ship, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# RE2 takes the first class for the blanks of the word pattern.
_WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(divisor: int):
    """crc32(doc_id as text) modulo a number; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


@query("op1_repeated_strings")
def op1_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_strings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op2_hidden_markov")
def op2_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hmm.learn_and_score(table(spark, sf_dir, "documents"), _remainder(10) != 0)
    return scored.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def train_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Network:
    """The network of the driver's labels; those with a remainder of 2 are held out."""
    labels = table(spark, sf_dir, "labels").filter(_remainder(4) != 2)
    return toxicity.train(toxicity.sample(docs, labels))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, train_toxicity(spark, docs, sf_dir))
    return scored.select(
        "doc_id", (_remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = work_folder(spark)
    tokens.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_token_files(spark, path)


_OP10 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER_SQL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER_SQL.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM (SELECT item_id, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0))),
grams AS (
  SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM wanted) WHERE len(w) >= k)),
found AS (SELECT doc_id, s, k, item_id FROM grams JOIN wanted USING (k, g)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM found) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op10_decontaminate", _OP10)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op5_main_text")
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


_BLANKS_SQL = r"[\x20\x09-\x0D]"
_OP6 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS text, {_WORDS_SQL} AS w FROM documents),
l AS (
  SELECT id, source, line, trim(regexp_replace({_LOWER_SQL.format("line")}, '{_BLANKS_SQL}+', ' ', 'g')) AS norm,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT id, source, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
frequent AS (SELECT source, norm FROM l GROUP BY 1, 2 HAVING count(DISTINCT id) > {lines.MAX_DOCS}),
lost AS (
  SELECT id, sum(words) AS lost FROM l SEMI JOIN frequent f
  ON l.norm = f.norm AND l.source IS NOT DISTINCT FROM f.source GROUP BY 1),
dups AS (SELECT id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY 1),
grams AS (
  SELECT id, s, array_to_string(w[s:s + 2], ' ') AS g
  FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS s FROM d WHERE len(w) > 2)),
again AS (SELECT id, s FROM grams QUALIFY count(*) OVER (PARTITION BY id, g) > 1),
repeats AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(s, s + 3)) AS p FROM again) GROUP BY 1),
base AS (
  SELECT id, doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '{_BLANKS_SQL}', '', 'g')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost
  FROM d LEFT JOIN dups USING (id) LEFT JOIN repeats USING (id) LEFT JOIN lost USING (id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * (n_words - lost) >= {lines.KEEP_PERCENT} * n_words AS kept, lost AS removed_words
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)"""


@query("op6_line_frequency", _OP6)
def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = lines.judge_lines(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.col("depleted")).alias("kept"),
        "removed_words",
    )


_OP8 = rf"""
WITH d AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS name, len({_WORDS_SQL})::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT none, name, sum(size)::BIGINT AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY none, name) - 1) % 3 + 1]::BIGINT AS w
  FROM d GROUP BY 1, 2),
o AS (
  SELECT *, row_number() OVER o AS place, sum(source_size) OVER () * 3 AS total3,
    coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 4 AS capped4,
    sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left
  FROM s WINDOW o AS (ORDER BY source_size / w, none, name)),
f AS (
  SELECT place AS fp, total3 - capped4 AS fl, w_left AS fw FROM o
  WHERE (total3 - capped4) * w <= source_size * 4 * w_left ORDER BY place LIMIT 1),
t AS (
  SELECT none, name, source_size,
    CASE WHEN place >= fp THEN (w * fl)::DOUBLE / (fw * 2)::DOUBLE ELSE (source_size * 2)::DOUBLE END AS target,
    ('0x' || substr(md5('mix/' || none || '/' || name), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS u
  FROM o LEFT JOIN f ON true),
r AS (
  SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY none, name ORDER BY size, h, doc_id) - 1 AS i
  FROM d JOIN t USING (none, name))
SELECT doc_id, size, source_size, target,
  (size * (floor(u + (i + 1) * rate) - floor(u + i * rate)))::BIGINT AS taken
FROM r"""


@query("op8_mix_sources", _OP8)
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


RULES = [
    urls.rule("org", "/", "allow"),
    urls.rule("example.org", "/es/", "block"),
    urls.rule("example.org", "/en/1", "block"),
    urls.rule("com", "/fr/", "allow"),
    urls.rule("com", "/de/", "block"),
]

_OP9 = f"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
h AS (SELECT page_id, {_LOWER_SQL.format("raw")} AS host, path FROM q),
rules(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (
  SELECT page_id, rh || rp AS rule, v FROM h JOIN rules
  ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)"""


@query("op9_url_rules", _OP9)
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES))


_OP7 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER_SQL.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS g FROM d),
c AS (SELECT g, min(doc_id) AS rep FROM s WHERE len(g) > 0 GROUP BY g),
x AS (SELECT rep, len(g) AS n, unnest(g) AS e FROM c),
p AS (
  SELECT a.rep AS a, b.rep AS b FROM x a JOIN x b ON a.e = b.e AND a.rep <> b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT rep AS a, rep AS b FROM c UNION SELECT reach.a, p.b FROM reach JOIN p ON reach.b = p.a),
m AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  coalesce(component_id, doc_id) = doc_id AS kept
FROM s LEFT JOIN c ON s.g = c.g AND len(s.g) > 0 LEFT JOIN m USING (rep)"""


@query("op7_near_duplicates", _OP7)
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op11_best_fit_packing")
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _field_sql(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _tree_sql(name: str, leaves: str, fanout: int) -> str:
    """Levels of the trees of ``leaves`` (k, i, h): level 0 are the leaves, a tree ends with its only node."""
    return f"""
{name} AS (
  SELECT k, 0 AS l, i, h, count(*) OVER (PARTITION BY k) AS n FROM {leaves}
  UNION ALL
  SELECT k, l + 1, i // {fanout}, sha256(string_agg(h, '' ORDER BY i)), (n + {fanout - 1}) // {fanout}
  FROM {name} WHERE n > 1 GROUP BY k, l, i // {fanout}, n)"""


def _path_sql(name: str, start: str, tree: str, fanout: int) -> str:
    """Rows of ``start`` (id, k, i, f) on their way up: the node recomputed and the siblings passed so far."""
    return f"""
{name} AS (
  SELECT id, k, 0 AS l, i, f, '' AS p FROM {start}
  UNION ALL
  SELECT a.id, a.k, a.l + 1, a.i // {fanout},
    sha256(string_agg(CASE WHEN t.i = a.i THEN a.f ELSE t.h END, '' ORDER BY t.i)),
    a.p || coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i <> a.i), '')
  FROM {name} a JOIN {tree} t ON t.k = a.k AND t.l = a.l AND t.i // {fanout} = a.i // {fanout} AND t.n > 1
  GROUP BY a.id, a.k, a.l, a.i, a.f, a.p)"""


_LEAF_SQL = "sha256(concat({}, {{}}))".format(", ".join(map(_field_sql, merkle.COLUMNS[:-1])))
_CRC_SQL = """list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)), lambda c, x:
  list_reduce([xor(c, x), 1, 2, 3, 4, 5, 6, 7, 8], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"""
_OP12 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS id, doc_id, source, {_LEAF_SQL.format(_field_sql("text"))} AS h,
    {_LEAF_SQL.format(_field_sql(_LOWER_SQL.format("text")))} AS changed,
    xor({_CRC_SQL.format("doc_id::VARCHAR")}, 4294967295) % 5 = 0 AS tampered FROM documents),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS k FROM (SELECT DISTINCT source FROM d)),
leaves AS (
  SELECT id, doc_id, k, h, CASE WHEN tampered THEN changed ELSE h END AS f,
    row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS i
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
{_tree_sql("low", "leaves", merkle.FANOUT)},
subroots AS (SELECT 0 AS k, k AS i, h FROM low WHERE n = 1),
{_tree_sql("high", "subroots", merkle.FANOUT)},
{_path_sql("up", "leaves", "low", merkle.FANOUT)},
at_subroot AS (
  SELECT id, 0 AS k, up.k AS i, f, p, h AS subroot FROM up JOIN low ON low.k = up.k AND low.l = up.l AND low.n = 1),
{_path_sql("over", "at_subroot", "high", merkle.FANOUT)},
at_root AS (SELECT id, f, p, h FROM over JOIN high ON high.l = over.l AND high.n = 1)
SELECT doc_id, leaves.h AS leaf, subroot, at_root.h AS root, sha256(at_subroot.p || at_root.p) AS proof_sha256,
  at_root.f AS folded_root, at_root.f = at_root.h AS verified
FROM leaves JOIN at_subroot USING (id) JOIN at_root USING (id)"""


@query("op12_merkle_manifest", _OP12)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    made = merkle.manifest(table(spark, sf_dir, "documents"), crc % 5 == 0)
    folded = made.withColumn("folded_root", merkle.fold(F.col("seen"), F.col("proof")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.plant_runs(table(spark, sf_dir, "documents")))
    best = periodic.longest_run(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
