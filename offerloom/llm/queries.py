"""The registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import bpe, fim, html_text, line_dedup, mixing, near_dups, quality, set_join, substrings, topk, urls, vector_codes, warc
from offerloom.llm.storage import bounded_batches, work_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a record a page, then reads the archives back by byte ranges."""
    bounded_batches(spark)
    path = work_path(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, sf_dir, "pages")), path)
    records = warc.read_warc(spark, path, split_bytes=8 << 20)
    stored = F.col("payload").isNotNull()
    return records.select(
        warc.page_number("record_id").alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        warc.page_number("refers_to").alias("refers_to"),
    )


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
k AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM k)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM f
"""


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return substrings.removed(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits", "hit_weight")


def _op3_sql() -> str:
    hit = lambda term: f"regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])')::INT"
    sum_of = lambda terms, weighed: " + ".join(f"{w} * {hit(t)}" if weighed else hit(t) for t, w in terms)
    rules = sorted(urls.RULES, key=lambda r: -len(r.host + r.path))
    fits = lambda r: f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH u AS (
  SELECT page_id, {lower.format("coalesce(url, '')")} AS low,
         {lower.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
h AS (SELECT *, ({sum_of(urls.DEFAULT.of(True), False)})::INT AS strict_hits, ({sum_of(urls.DEFAULT.of(False), False)})::INT AS soft_hits,
             ({sum_of(urls.DEFAULT.weights, True)})::INT AS hit_weight FROM u)
SELECT page_id, host, path,
       CASE {" ".join(f"{fits(r)} THEN '{r.host}{r.path}'" for r in rules)} END AS rule,
       CASE {" ".join(f"{fits(r)} THEN '{r.verdict}'" for r in rules)}
            WHEN hit_weight >= {urls.DEFAULT.limit} THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_hits, hit_weight
FROM h
"""


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_LIMITS = quality.Limits()
OP4_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source FROM documents),
w AS (SELECT doc_id, text, source, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (
  SELECT doc_id, text, source, words, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
  FROM w),
g AS (SELECT doc_id, unnest(range(1, n_words - 3)) AS i, words FROM m WHERE n_words >= 5),
gg AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram FROM g),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM gg),
r AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM c WHERE n >= 2) GROUP BY doc_id),
l AS (
  SELECT doc_id, text, coalesce('s' || source, '-') AS host, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (
  SELECT doc_id, text, host, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM l),
f AS (SELECT host, key, count(DISTINCT doc_id) AS n_docs FROM k WHERE n > 0 GROUP BY host, key),
h AS (SELECT coalesce('s' || source, '-') AS host, count(DISTINCT doc_id) AS host_docs FROM d GROUP BY 1),
o AS (SELECT f.host, f.key FROM f JOIN h USING (host) WHERE n_docs >= {_LIMITS.line_docs} AND n_docs > host_docs * {_LIMITS.line_share}),
x AS (SELECT doc_id, sum(n) AS n_lost FROM k JOIN o USING (host, key) GROUP BY doc_id),
a AS (
  SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_words - coalesce(n_lost, 0) AS left_words
  FROM m LEFT JOIN r USING (doc_id) LEFT JOIN x USING (doc_id)),
b AS (SELECT *, n_words < {_LIMITS.min_words} OR 100 * n_repeat_words > {_LIMITS.max_repeat_percent} * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND left_words >= {_LIMITS.min_words} AND left_words >= n_words * {_LIMITS.min_left} AS kept
FROM b
"""


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP5_SQL = """
WITH v AS (
  SELECT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM v) q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every whole text; the digests are made from the ids and the bytes."""
    import public_tokenizers

    bounded_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    both = bpe.decode(ids, path, public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a document, with the smallest doc_id of its class of near duplicates."""
    bounded_batches(spark)
    return near_dups.classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "class_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a document, with the words that the mix takes of it."""
    plan = mixing.mixed(table(spark, sf_dir, "documents"))
    rows = plan.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s' || source, '-') AS sk, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT sk, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY sk),
w AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (
  SELECT a.cap / a.weight AS ratio, (1.5::DOUBLE * sum(b.source_size) - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight), 0)) / sum(b.weight) FILTER (b.cap / b.weight >= a.cap / a.weight) AS level
  FROM w a, w b GROUP BY a.cap / a.weight),
t AS (SELECT sk, source_size, least(cap, weight * coalesce((SELECT min_by(level, ratio) FROM l WHERE level <= ratio), 'inf'::DOUBLE)) AS target FROM w),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (
  SELECT doc_id, sk, size, source_size, target, whole, target - whole * source_size AS part, ('0x' || substr(md5('20|' || doc_id || '|' || sk), 1, 15))::BIGINT AS h FROM d JOIN g USING (sk)),
c AS (SELECT *, sum(size) OVER (PARTITION BY sk ORDER BY h ROWS UNBOUNDED PRECEDING) <= part AS chosen FROM r),
m AS (SELECT sk, any_value(part) - coalesce(sum(size) FILTER (chosen), 0) AS missing FROM c GROUP BY sk),
f AS (SELECT sk, size, min(h) AS h FROM c WHERE NOT chosen AND size > 0 GROUP BY sk, size),
x AS (
  SELECT sk, missing, 9223372036854775807::BIGINT AS size, 0 AS n FROM m
  UNION ALL
  SELECT x.sk, x.missing - max(f.size), max(f.size), x.n + 1 FROM x JOIN f ON f.sk = x.sk AND f.size <= x.missing AND f.size < x.size WHERE x.n < 8 GROUP BY x.sk, x.missing, x.n),
e AS (SELECT sk, size, h FROM x JOIN f USING (sk, size))
SELECT doc_id, c.size, source_size, target, (c.size * (whole + (chosen OR e.h IS NOT NULL)::INT))::BIGINT AS taken
FROM c LEFT JOIN e ON e.sk = c.sk AND e.size = c.size AND e.h = c.h
"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line, len(lines) AS n_lines
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
c AS (SELECT key, max(doc_id) AS last_id FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last_id AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, max(n_lines)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, with the tokens that repeated runs and markup took."""
    bounded_batches(spark)
    return html_text.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars", "n_repeated", "n_marked")


def op11_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a document, with the smallest doc_id that links of similar sets reach."""
    bounded_batches(spark)
    found = set_join.join_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a vector, with its code and errors, and the digest of the codebooks."""
    bounded_batches(spark)
    found = vector_codes.train(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_errors(found.rows)
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(found.sha256).alias("codebooks_sha256"))


def _op12_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """A table of parts, of codebooks and of assignments a round; components are equal in number and divisible in these tables."""
    floor_of = "(s - (((s % n) + n) % n)) // n"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} AS (SELECT x.rid, x.p, min(list_sum(list_transform(list_zip(x.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {entries} + c.e) AS best FROM x JOIN c{i} c ON c.p = x.p GROUP BY x.rid, x.p)")
        if i < rounds:
            steps.append(f"s{i} AS (SELECT p, e, j, sum(y)::BIGINT AS s, count(*) AS n FROM (SELECT x.p, best % {entries} AS e, unnest(x.x) AS y, generate_subscripts(x.x, 1) AS j FROM x JOIN a{i} USING (rid, p)) GROUP BY p, e, j)")
            steps.append(f"m{i} AS (SELECT p, e, list(({floor_of})::BIGINT ORDER BY j) AS x FROM s{i} GROUP BY p, e)")
            steps.append(f"c{i + 1} AS (SELECT c.p, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.p = c.p AND m.e = c.e)")
    return f"""
WITH v AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS rid, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT rid, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x FROM v, range({parts}) r(p)),
c0 AS (SELECT p, rid - 1 AS e, x FROM x WHERE rid <= {entries}),
{", ".join(steps)},
b AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM c{rounds})),
f AS (SELECT rid, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM f JOIN v USING (rid), b
"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rearranges every whole text and rebuilds it; the digests are made from both."""
    bounded_batches(spark)
    both = fim.restore(fim.transform(table(spark, sf_dir, "documents")))
    return both.select(
        F.col("id").alias("doc_id"),
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("text", 256).alias("restored_sha256"),
    )


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
g AS (SELECT doc_id, text, length(text)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM g),
p AS (SELECT *, substring(text, 1, low) AS a, substring(text, low + 1, high - low) AS b, substring(text, high + 1) AS c FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_quality": op4_quality,
    "op5_topk": op5_topk,
    "op6_bpe": op6_bpe,
    "op7_near_dups": op7_near_dups,
    "op8_mixing": op8_mixing,
    "op9_line_dedup": op9_line_dedup,
    "op10_html_text": op10_html_text,
    "op11_set_join": op11_set_join,
    "op12_vector_codes": op12_vector_codes,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op3_url_filter": _op3_sql(),
    "op4_quality": OP4_SQL,
    "op5_topk": OP5_SQL,
    "op8_mixing": OP8_SQL,
    "op9_line_dedup": OP9_SQL,
    "op12_vector_codes": _op12_sql(),
    "op13_fill_in_middle": OP13_SQL,
}
