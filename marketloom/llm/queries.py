"""The operators registered on the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import id_residue, read_table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.mixing import mix, taken_words

    return taken_words(mix(read_table(spark, sf_dir, "documents")))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.sharding import shard

    return shard(read_table(spark, sf_dir, "documents"), SHARD_BYTES)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.language_id import fit, identify

    docs = read_table(spark, sf_dir, "documents")
    profiles = fit(docs.where(id_residue("doc_id", 3) != 1))
    held_out = F.coalesce(id_residue("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", held_out, "text"), profiles).drop("text")


def op8_gru_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.gru_model import score

    return score(read_table(spark, sf_dir, "documents"))


def op9_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.multiset_hash import fingerprint_edits

    return fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.html_text import extract

    return extract(read_table(spark, sf_dir, "pages"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.url_filter import judge

    return judge(read_table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from marketloom.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.shingle_join import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents"))


SHARD_BYTES = 1 << 20  # byte limit of a shard of texts


def op2_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.cap_filters import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op11_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.permuterm import corpus_words, spelling_groups

    return spelling_groups(corpus_words(read_table(spark, sf_dir, "documents")))


def op12_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.lempel_ziv import remove_repeats

    kept = remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketloom.llm.angular_negatives import hard_negatives

    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_cap_filters": op2_cap_filters,
    "op3_sharding": op3_sharding,
    "op4_html_text": op4_html_text,
    "op5_url_filter": op5_url_filter,
    "op6_packing": op6_packing,
    "op7_language_id": op7_language_id,
    "op8_gru_model": op8_gru_model,
    "op9_multiset_hash": op9_multiset_hash,
    "op10_shingle_join": op10_shingle_join,
    "op11_permuterm": op11_permuterm,
    "op12_lempel_ziv": op12_lempel_ziv,
    "op13_angular_negatives": op13_angular_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op3_sharding": f"""
WITH r AS (
  SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash,
         coalesce(octet_length(encode(text)), 0)::BIGINT AS bytes FROM documents),
d AS (SELECT unnest(range(0, 61))::INTEGER AS depth),
start AS (SELECT greatest(0, ceil(log2(greatest(1, sum(bytes) / {SHARD_BYTES}.0))))::INTEGER AS least FROM r),
b AS (
  SELECT depth, hash >> (60 - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes, min(hash) = max(hash) AS one
  FROM r, d, start WHERE depth >= least GROUP BY 1, 2),
f AS (
  SELECT r.doc_id, r.hash, r.bytes, b.depth, b.prefix, b.shard_bytes,
         row_number() OVER (PARTITION BY r.doc_id, r.hash, b.depth ORDER BY r.bytes) AS copy,
         min(b.depth) OVER (PARTITION BY r.hash) AS own
  FROM r, b WHERE r.hash >> (60 - b.depth) = b.prefix AND (b.shard_bytes <= {SHARD_BYTES} OR b.one))
SELECT doc_id, hash, bytes, CASE WHEN depth > 0 THEN lpad(format('{{:b}}', prefix), depth, '0') ELSE '' END AS shard,
       depth, shard_bytes, shard_bytes > {SHARD_BYTES} AS oversized
FROM f WHERE depth = own
""",
    # crc32 is linear: the exclusive or, over the bytes, of what a byte gives when so many bytes follow it.
    "op11_permuterm": """
WITH RECURSIVE bits AS (
  SELECT b::BIGINT AS b, b::BIGINT AS r, 0 AS step FROM range(256) AS t(b)
  UNION ALL SELECT b, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, step + 1 FROM bits WHERE step < 8),
lookup AS (SELECT b, r FROM bits WHERE step = 8),
runs AS (
  SELECT id, run, hex(encode(id || ':' || run)) AS h, count(*) AS c
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
        FROM documents) AS u
  WHERE length(run) >= 6 GROUP BY 1, 2, 3),
longest AS (SELECT max(length(h) // 2) AS n FROM runs),
follow AS (
  SELECT 0::BIGINT AS k, b, r FROM lookup
  UNION ALL SELECT k + 1, f.b, xor(f.r >> 8, l.r) FROM follow f JOIN lookup l ON l.b = f.r & 255, longest WHERE k + 1 < longest.n),
start AS (
  SELECT 0::BIGINT AS k, 4294967295::BIGINT AS r
  UNION ALL SELECT k + 1, xor(s.r >> 8, l.r) FROM start s JOIN lookup l ON l.b = s.r & 255, longest WHERE k < longest.n),
bytes AS (
  SELECT id, run, c, length(h) // 2 AS n, i, CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT) AS b
  FROM (SELECT *, unnest(range(0, length(h) // 2)) AS i FROM runs) AS u),
hashed AS (
  SELECT id, run, any_value(c) AS c, xor(xor(bit_xor(f.r), any_value(s.r)), 4294967295) AS h
  FROM bytes JOIN follow f ON f.b = bytes.b AND f.k = n - 1 - i JOIN start s ON s.k = n GROUP BY id, run),
vocabulary AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) + 2 AS BIGINT)) ELSE run END AS word
        FROM hashed) AS w
  WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
places AS (SELECT word, n, unnest(range(0, length(word))) AS i FROM vocabulary),
holes AS (SELECT word, n, substr(word, 1, i) || '*' || substr(word, i + 2) AS k, substr(word, 1, i) || substr(word, i + 2) AS less FROM places),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.k = b.k AND a.word <> b.word
  UNION SELECT h.word, v.word, v.n FROM holes h JOIN vocabulary v ON h.less = v.word
  UNION SELECT v.word, h.word, h.n FROM holes h JOIN vocabulary v ON h.less = v.word),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, near_n
  FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
listed AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS place, 0 AS step FROM listed
  UNION ALL SELECT w.word, r.form, step + 1 FROM walk w JOIN listed r ON r.word = w.place WHERE r.form IS NOT NULL)
SELECT listed.*, place AS root FROM listed JOIN (SELECT word, place FROM walk QUALIFY row_number() OVER (PARTITION BY word ORDER BY step DESC) = 1) AS e USING (word)
""",
    "op12_lempel_ziv": r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT r, len(ws) AS n, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM texts),
windows AS (
  SELECT r, i, n, md5(string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) AS h FROM words),
again AS (SELECT h FROM windows WHERE i + 34 <= n GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM windows SEMI JOIN again USING (h) WHERE i + 34 <= n),
left_over AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (r)
""",
    "op13_angular_negatives": """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
""",
}
