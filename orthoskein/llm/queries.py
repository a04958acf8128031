"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, fingerprint, langid, linededup, mixing, neardup, pii, sentencepiece, sufdedup, warc


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs, langid.fit(docs), ["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepiece.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return out.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), "tokens", "exact")


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archive(*warc.write_archive(read(spark, sf_dir, "pages").select("page_id", "url", "html")))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sufdedup.suffix_dedup(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_sentencepiece, op3_fingerprint, op4_warc, op5_near_dedup, op6_line_dedup, op7_mixing, op8_nearest, op9_suffix_dedup, op10_pii)}

ORACLES = {
    # Base32 of a SHA-1 in hex: its bits five at a time.
    "op4_warc": r"""
WITH bodies AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
known AS (SELECT html, max(page_id) AS last, count(*) AS c FROM bodies GROUP BY html),
digests AS (
    SELECT html, array_to_string(list_transform(string_split(sha1(html), ''), lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), '') AS bits FROM known
)
SELECT b.page_id, strlen(b.html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
           16 * substr(d.bits, 5 * i + 1, 1)::INT + 8 * substr(d.bits, 5 * i + 2, 1)::INT + 4 * substr(d.bits, 5 * i + 3, 1)::INT + 2 * substr(d.bits, 5 * i + 4, 1)::INT + substr(d.bits, 5 * i + 5, 1)::INT), 1)), '') AS payload_digest,
       CASE WHEN b.page_id = k.last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN b.page_id <> k.last THEN k.last END AS refers_to
FROM bodies b JOIN known k USING (html) JOIN digests d USING (html)
""",
    "op5_near_dedup": r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), placed AS (
    SELECT doc_id, words, unnest(range(1, CASE WHEN len(words) >= 5 THEN len(words) - 3 WHEN len(words) > 0 THEN 2 ELSE 1 END)) AS i FROM split
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(words) >= 5 THEN words[i:i + 4] ELSE words END, ' ') AS s FROM placed
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT w.y, r.root FROM reach r JOIN ways w ON w.x = r.doc_id),
least AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d LEFT JOIN sizes n USING (doc_id) JOIN least l USING (doc_id)
""",
    "op6_line_dedup": r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT doc_id, i, lines[i] AS line,
           translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM split)
), first AS (
    SELECT key, min(doc_id) AS doc FROM lines WHERE length(key) >= 10 GROUP BY key
), judged AS (
    SELECT l.doc_id, l.i, l.line, coalesce(f.doc < l.doc_id, false) AS gone
    FROM lines l LEFT JOIN first f ON length(l.key) >= 10 AND f.key = l.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
    "op7_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)
), weighed AS (
    SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(rank % 3 + 1)::BIGINT] AS weight, source_size::DOUBLE * 2 AS lim FROM ranked
), levelled AS (
    SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - (sum(lim) OVER fill - lim))
              / (sum(weight) OVER () - sum(weight) OVER fill + weight) AS level
    FROM weighed WINDOW fill AS (ORDER BY lim / weight, rank)
), chosen AS (
    SELECT arg_min(level, (lim / weight, rank)) AS level FROM levelled WHERE level * weight < lim
), targets AS (
    SELECT source, source_size, coalesce(least(c.level * weight, lim), lim) AS target FROM levelled CROSS JOIN chosen c
), rated AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
           ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS u
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM rated
""",
}
