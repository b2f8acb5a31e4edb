"""The operators as queries over the given tables, by name, and their equal SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kerbline.llm import alignment, conversations, langid, neardup, packing, pii, quality, sharding, substring, tokens, topk, toxicity, warc
from kerbline.scale import settle

QUERIES = {}
ORACLES = {}


def query(fn=None, *, sql: str | None = None):
    """Register a query under its function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register(fn) if fn is not None else register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.clean(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_chars")


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored: one pass over the texts serves the fit and the spans.
    found = settle(pii.marked(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    out = pii.accepted(found, pii.learn(found))
    counts = [f"n_{k}" for k in pii.KINDS]
    return out.select("doc_id", *counts, F.sha2(pii.listed("__base"), 256).alias("base_sha256"), pii.listed("__spans").alias("spans"))


@query
def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"))


@query
def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removed_words(read(spark, sf_dir, "documents"))


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_digests(read(spark, sf_dir, "documents"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query(sql=OP6_SQL)
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


@query
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = bucket(4) == 2
    model = langid.fit(docs.filter(~held))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = bucket(5) == 0
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held))
    out = toxicity.score(docs, model)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, h, upper(sha1(h)) AS x,
  min(page_id) OVER (PARTITION BY h) AS first FROM p),
f AS (SELECT *, list_transform(range(8), lambda g: list_sum(list_transform(range(5), lambda i:
  (instr('0123456789ABCDEF', substr(x, CAST(5 * g + i + 1 AS BIGINT), 1)) - 1) * CAST(power(16, 4 - i) AS BIGINT)))) AS v FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST(v[k // 4 + 1] AS BIGINT) // CAST(power(32, 3 - k % 4) AS BIGINT)) % 32 + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM f
"""


@query(sql=OP1_SQL)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archive(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_counts(read(spark, sf_dir, "documents"))


def _move(letter: str, to: str) -> str:
    """The option of giving a turn this initial: kept, or with a new role."""
    other = "far" if letter == "s" else f"{{'c': 3 + x + {to}.c, 'a': 'R' || {to}.a}}"
    kept = f"{{'c': x + {to}.c, 'a': 'K' || {to}.a}}"
    return f"CASE WHEN gone THEN far WHEN ini = '{letter}' THEN {kept} ELSE {other} END"


def _state(q: str, moves: dict[str, str]) -> str:
    options = [f"{{'c': 4 + {q}.c, 'a': 'D' || {q}.a}}", *[_move(letter, to) for letter, to in moves.items()]]
    return f"list_sort([{', '.join(options)}])[1]"


def _insert(q: str, to: str) -> str:
    return f"list_sort([{q}, {{'c': 3 + {to}.c, 'a': 'I' || {to}.a}}])[1]"


_FAR = "{'c': CAST(1000000000 AS BIGINT), 'a': '~'}"
_EMPTY = "{'c': CAST(0 AS BIGINT), 'a': ''}"
# The grammar's states from the last turn to the first: n0 start, n1 after s, n2 after u, n3 after a.
OP12_SQL = f"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 1, 2, 3, 4, 5, 6, 7],
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (SELECT src.*, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
  lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), CAST(4294967295 AS BIGINT)) % 20 AS f FROM src, tab),
hurt AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
  CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM hashed, range(CASE f WHEN 3 THEN 2 ELSE 1 END) WHERE f <> 0),
placed AS (SELECT *, dense_rank() OVER (ORDER BY conv_id) AS g,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS i FROM hurt),
facts AS (SELECT *, substr(role, 1, 1) AS ini, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
  row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again,
  lag(substr(role, 1, 1)) OVER (PARTITION BY g ORDER BY i) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au') AS odd FROM placed),
coded AS (SELECT *, last = '' AS blank, last <> '' AND again AS duplicate, last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated FROM facts),
total AS (SELECT g, any_value(conv_id) AS conv_id, count(*) AS n, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
  count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (odd) AS illegal FROM coded GROUP BY g),
ends AS (SELECT {_FAR} AS far, {_EMPTY} AS done),
steps AS (
  SELECT g, n AS i, {_insert('done', 'far')} AS n0, {{'c': CAST(6 AS BIGINT), 'a': 'II'}} AS n1, {{'c': CAST(3 AS BIGINT), 'a': 'I'}} AS n2, done AS n3 FROM total, ends
  UNION ALL
  SELECT g, i, {_insert('b0', 'f2')}, {_insert('b1', 'f2')}, f2, f3 FROM (
    SELECT *, {_insert('b2', 'b3')} AS f2, {_insert('b3', 'b2')} AS f3 FROM (
      SELECT s.g, s.i - 1 AS i, {_state('n0', {'s': 'n1', 'u': 'n2'})} AS b0, {_state('n1', {'u': 'n2'})} AS b1, {_state('n2', {'a': 'n3'})} AS b2, {_state('n3', {'u': 'n2'})} AS b3
      FROM steps s JOIN (SELECT g, i, ini, blank OR duplicate AS gone, CASE WHEN truncated THEN 3 ELSE 0 END AS x FROM coded) c ON s.g = c.g AND s.i = c.i, ends))),
best AS (SELECT g, n0.c AS cost, n0.a AS audit FROM steps WHERE i = 0),
edits AS (SELECT g, p, audit[p] AS e, length(replace(audit[1:p], 'I', '')) AS i, length(replace(audit[1:p], 'D', '')) AS j, length(replace(audit, 'D', '')) % 2 AS s
  FROM best, range(1, length(audit) + 1) r(p)),
lines AS (SELECT edits.g, p, CASE e WHEN 'K' THEN role WHEN 'R' THEN fit ELSE fit END || ':' || CASE e WHEN 'I' THEN '' ELSE text END AS line
  FROM (SELECT *, CASE (j - 1 - s) % 2 WHEN 0 THEN 'user' ELSE 'assistant' END AS fit FROM edits WHERE e <> 'D') edits LEFT JOIN coded ON edits.g = coded.g AND edits.i = coded.i),
texts AS (SELECT g, string_agg(line, chr(10) ORDER BY p) AS whole FROM lines GROUP BY g)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN total ON a.conv_id IS NOT DISTINCT FROM total.conv_id LEFT JOIN best USING (g) LEFT JOIN texts USING (g)
"""


@query(sql=OP12_SQL)
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digests(conversations.damage(read(spark, sf_dir, "conversations")))


@query
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    out = sharding.interleave(docs, 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
