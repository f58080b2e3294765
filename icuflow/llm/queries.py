"""The registered queries of the corpus operators: production parameters, whole tables, whole texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icuflow.llm import bpe, collocations, exact_dedup, licenses, line_dedup, minhash, neighbours, packing, quality, runs, secrets, token_count, topk
from icuflow.llm.common import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, folder) under its own name."""

    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql.strip()
        return build

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


@query()
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text and their decoding, as digests."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(documents(spark, folder).select("doc_id", "text"), path, pattern).drop("text")
    return bpe.decode(ids, path, pattern).select(
        "doc_id",
        bpe.token_count().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every whole text by the piece model."""
    docs = documents(spark, folder).select("doc_id", "text")
    counted = token_count.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query(
    """
WITH line AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
)
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that five documents or more share."""
    docs = documents(spark, folder).select("doc_id", "text")
    return line_dedup.drop_shared_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def _digest(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query()
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every whole text: counts and digest of the base kinds, all spans."""
    found = secrets.scan(documents(spark, folder).select("doc_id", "text"))
    base = [rule.kind for rule in secrets.BASE]
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(_digest(F.filter("secrets", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _digest(F.col("secrets")).alias("spans"),
    )


@query()
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in sequences of 1024 tokens."""
    docs = documents(spark, folder).select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query()
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every whole text, learnt from labels that are not held out."""
    docs = documents(spark, folder).select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return quality.classify(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


_FINITE = "len({v}) > 0 AND len(list_filter({v}, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


@query(
    f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND {_FINITE.format(v="embedding")} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (
  SELECT vec_id, row, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, x: a + x)) AS size FROM v
), pair AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    max(list_reduce(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]), lambda a, x: a + x) / (q.size * c.size)) AS score
  FROM n q JOIN n c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id, c.row
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pair
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""
)
def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest rows by cosine of every row whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return neighbours.nearest(vectors, F.col("vec_id") % 50 == 0)


@query(
    f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND {_FINITE.format(v="embedding")}
), pair AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id, c.row
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pair
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""
)
def op9_top_products(spark: SparkSession, folder: str) -> DataFrame:
    """The five rows of highest integer inner product of every row whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return topk.top(vectors, F.col("vec_id") % 50 == 0)


@query()
def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document: five-word shingles, similarity 0.8 or more."""
    return minhash.classes(documents(spark, folder).select("doc_id", "text"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = ", ".join(f"({k}, {_quoted(name)}, {_quoted(text)})" for k, (name, text) in enumerate(licenses.TEMPLATES))
_LOWER_WORDS = "list_transform(regexp_extract_all({}, '[A-Za-z0-9]+'), lambda x: lower(x))"


@query(
    f"""
WITH template(number, license, words) AS (
  SELECT number, license, {_LOWER_WORDS.format("text")} FROM (VALUES {_TEMPLATES}) AS t(number, license, text)
), parts AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), unit AS (
  SELECT doc_id, unnest(generate_series(0, len(lines) - 1)) AS line, unnest(lines) AS text FROM parts
  UNION ALL SELECT doc_id, -1, text FROM parts WHERE len(lines) > 1
), worded AS (
  SELECT doc_id, line, {_LOWER_WORDS.format("text")} AS words FROM unit
), sized AS (
  SELECT doc_id, line, words, len(words) - 1 AS size FROM worded
  WHERE len(words) - 1 BETWEEN 1 AND (SELECT max(len(words) - 1) * 1.5 FROM template)
), own AS (
  SELECT doc_id, line, size, words[i] || ' ' || words[i + 1] AS pair, count(*) AS n
  FROM (SELECT *, unnest(generate_series(1, size)) AS i FROM sized) GROUP BY ALL
), given AS (
  SELECT number, license, size, words[i] || ' ' || words[i + 1] AS pair, count(*) AS n
  FROM (SELECT *, len(words) - 1 AS size, unnest(generate_series(1, len(words) - 1)) AS i FROM template) GROUP BY ALL
), dice AS (
  SELECT o.doc_id, o.line, g.number, g.license, 2 * sum(least(o.n, g.n)) / CAST(o.size + g.size AS DOUBLE) AS dice
  FROM own o JOIN given g ON o.pair = g.pair GROUP BY o.doc_id, o.line, g.number, g.license, o.size, g.size
), best AS (
  SELECT * FROM dice WHERE dice >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, number) = 1
)
SELECT p.doc_id, count(b.line) AS n_notices,
  coalesce(string_agg(DISTINCT b.license, ',' ORDER BY b.license), '') AS licenses, coalesce(max(b.dice), 0.0) AS best_dice
FROM parts p LEFT JOIN best b ON p.doc_id = b.doc_id GROUP BY p.doc_id
"""
)
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences that every document's lines or its whole text name."""
    found = licenses.scan(documents(spark, folder).select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["license"]))), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("notices", lambda n: n["dice"])), F.lit(0.0)).alias("best_dice"),
    )


@query(
    r"""
WITH normal AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM normal
"""
)
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The row that stays for every document, of those equal but for white space."""
    found = exact_dedup.dedupe(documents(spark, folder).select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


#: CRC-32 of the decimal digits of doc_id: every byte is mixed in and then shifted out bit by bit.
_CRC32 = """xor(list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda d: list_concat([CAST(ascii(d) AS BIGINT)], [0, 0, 0, 0, 0, 0, 0]))),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)), CAST(4294967295 AS BIGINT)), 4294967295)"""


@query(
    rf"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, {_CRC32} AS h
  FROM documents
), placed AS (
  SELECT *, h // 10 AS g, len(w) AS n FROM split
), cut AS (
  SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM placed
), doc AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_concat(w[1:a], list_transform(range(a, n), lambda i: w[a + (i - a) % p + 1])) ELSE w END AS w FROM cut
), word AS (
  SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i, w FROM doc
), context AS (
  -- A run of period q holds the 16 words of some place again q words later.
  SELECT doc_id, n, i, hash(w[i + 1:i + 16]) AS h FROM word WHERE i + 16 <= n AND n >= 24
), proposed AS (
  SELECT DISTINCT x.doc_id, y.i - x.i AS q FROM context x JOIN context y ON x.doc_id = y.doc_id AND x.h = y.h
  WHERE y.i > x.i AND 3 * (y.i - x.i) <= x.n
), alike AS (
  SELECT p.doc_id, p.q, x.i, x.i - row_number() OVER (PARTITION BY p.doc_id, p.q ORDER BY x.i) AS island
  FROM proposed p JOIN word x ON p.doc_id = x.doc_id JOIN word y ON y.doc_id = x.doc_id AND y.i = x.i + p.q AND y.word = x.word
), stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM alike GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)
), run AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY doc_id, start, length
), best AS (
  SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id
    ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS all_runs
  FROM run GROUP BY doc_id
), gone AS (
  SELECT DISTINCT w.doc_id, w.i FROM run r JOIN word w ON r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length
), rest AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS kept FROM word w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i
  GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(l.all_runs, '')) AS runs_sha256, sha256(coalesce(r.kept, '')) AS collapsed_sha256
FROM doc d LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN best b ON d.doc_id = b.doc_id LEFT JOIN rest r ON d.doc_id = r.doc_id
"""
)
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every whole text, of which a tenth is first made periodic from a word on, as the contract says."""
    return run_digests(runs.detect(made_periodic(documents(spark, folder).select("doc_id", "text"))))


def made_periodic(docs: DataFrame) -> DataFrame:
    """Of documents whose hash h ends in 0 the words from a on are replaced by repetitions of the first p of them. Rows
    without an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    n, a, p, g = F.col("_n"), F.col("_a"), F.col("_p"), F.floor(h / 10)
    split = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    rows = docs.withColumn("_words", F.when(h % 10 == 0, split)).withColumn("_n", F.size("_words").cast("long"))
    rows = rows.withColumn("_a", F.when(n > 0, g % n)).withColumn("_p", 1 + F.floor((n - a) / (3 + g % 8)))
    tail = F.transform(F.sequence(a, n - 1), lambda i: F.get("_words", (a + (i - a) % p).cast("int")))
    words = F.concat(F.slice("_words", F.lit(1), a.cast("int")), tail)
    return rows.select("doc_id", F.when(n > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the one of greatest exponent (the first of equals), digests of all runs and of what is left."""
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.reduce("runs", none, lambda best, r: F.when(more(best, r), r).otherwise(best))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed").select(
        "doc_id",
        "n_runs",
        "best.*",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece
), gram AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM split, (VALUES (1), (2), (3)) AS s(size) WHERE len(w) >= size
), f AS (
  SELECT lang, size, phrase, count(*) AS a FROM gram GROUP BY ALL
), total AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), candidate AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 10
), cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS last
  FROM candidate, range(1, 3) AS r(k) WHERE k < size
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r,
    CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM cut c JOIN f l ON c.lang = l.lang AND c.first = l.phrase JOIN f r ON c.lang = r.lang AND c.last = r.phrase
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, array_to_string(w[j:j + 1], ' ') AS phrase, max(a) AS most
  FROM candidate, range(1, 3) AS r(j) WHERE size = 3 GROUP BY ALL
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
FROM lowest s JOIN total USING (lang) LEFT JOIN longer g ON s.lang = g.lang AND s.phrase = g.phrase
WHERE g.most IS NULL OR 100 * g.most < 50 * a
QUALIFY rank <= 2000
"""
)
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 strongest phrases of two or three words of each language."""
    return collocations.mine(documents(spark, folder).select("text", "lang"))
