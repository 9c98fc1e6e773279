"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from wardhouse.llm import (
    compression,
    covertree,
    masked_lm,
    neardup,
    packing,
    pieces,
    pii,
    quality_rules,
    spelling,
    token_files,
    toxicity,
    vector_codes,
    warc,
)
from wardhouse.llm.common import fold, table
from wardhouse.llm.token_ids import tokenizer_path
from wardhouse.session import work_path


#: The key of the registered queries; a real run takes its own from a secret store.
PII_KEY = "fixed key of the registered queries"


def _scored(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, model).drop("text")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = compression.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(compression.compression_quality(docs, model))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = tokenizer_path("piece_bpe_32k.model")
    rows = pieces.decode(pieces.encode(docs, model, merges=True), model, text_col="decoded")
    return rows.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_pieces"),
        "score",
        F.crc32("ids").alias("ids_crc32"),
        F.coalesce(F.col("decoded") == F.coalesce("text", F.lit("")), F.lit(False)).alias("round_trip"),
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_pii(docs, key=PII_KEY)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, size=4, percent=80)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed_documents(docs, tokenizer_path())


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return masked_lm.pseudo_likelihood(docs, masked_lm.fit(docs)).drop("text")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    rows = token_files.read_token_files(spark, path)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _scored(toxicity.toxicity(docs, model))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(table(spark, sf_dir, "embeddings"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_variants(docs, slip=97)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    captures = warc.read_archives(spark, path, payloads=False)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_pii": op4_pii,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_packing": op6_packing,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_exact_topk": op10_exact_topk,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_warc": op12_warc,
    "op13_vector_codes": op13_vector_codes,
}

_NEAR = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id,
    unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: w[i:i + 3])) AS shingle
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT met.a, met.b FROM met JOIN sizes x ON x.doc_id = met.a JOIN sizes y ON y.doc_id = met.b
  WHERE 100 * met.n >= 80 * (x.n + y.n - met.n)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, component_id,
  doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

_TOP = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""

# The checksum's table is built bit by bit; words of one edit apart meet by what is left of them
# without one code point.
_SPELLING = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), met AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents)
  GROUP BY ALL
), bytes AS (
  SELECT run, n, hex(encode(concat(doc_id, ':', run))) AS h FROM met WHERE length(run) >= 5
), coded AS (
  SELECT run, n, xor(list_reduce(
    list_transform(range(0, length(h) // 2), lambda i: CAST(concat('0x', h[2 * i + 1 : 2 * i + 2]) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS code
  FROM bytes, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN code % 97 = 0
      THEN concat(run[1 : code % length(run)], run[code % length(run) + 2 :]) ELSE run END AS word
    FROM coded)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), holes AS (
  SELECT word, n, length(word) AS size, i, concat(word[1 : i - 1], word[i + 1 :]) AS rest
  FROM words, unnest(range(1, length(word) + 1)) u(i)
), pairs AS (
  SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn
  FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT w.word, w.n, h.word, h.n FROM words w JOIN holes h ON h.rest = w.word
  UNION
  SELECT h.word, h.n, w.word, w.n FROM words w JOIN holes h ON h.rest = w.word
), near AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-bn, encode(b))) AS best, max(bn) AS best_n
  FROM pairs GROUP BY a
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word)
), path(word, spot) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT path.word, forms.form FROM path JOIN forms ON forms.word = path.spot WHERE forms.form IS NOT NULL
), roots AS (
  SELECT path.word, path.spot AS root FROM path JOIN forms ON forms.word = path.spot WHERE forms.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN size >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""

_CODES = """
WITH v AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS place,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, place, part, q[part * (len(q) // 16) + 1 : (part + 1) * (len(q) // 16)] AS x
  FROM v, range(16) r(part)
), c0 AS (
  SELECT part, place AS entry, x FROM parts WHERE place < 64
), a1 AS (
  SELECT vec_id, part, any_value(x) AS x, min(d * 64 + entry) AS best FROM (
    SELECT p.vec_id, p.part, p.x, c.entry, CAST(list_sum(list_transform(
      range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i]))) AS BIGINT) AS d
    FROM parts p JOIN c0 c USING (part))
  GROUP BY vec_id, part
), c1 AS (
  SELECT part, entry, coalesce(m.x, c.x) AS x FROM c0 c LEFT JOIN (
    SELECT part, entry, list(CAST((total - ((total % n) + n) % n) / n AS BIGINT) ORDER BY pos) AS x
    FROM (
      SELECT part, best % 64 AS entry, pos, CAST(sum(x[pos]) AS BIGINT) AS total, count(*) AS n
      FROM a1, unnest(range(1, len(x) + 1)) u(pos) GROUP BY ALL)
    GROUP BY part, entry) m USING (part, entry)
), a2 AS (
  SELECT vec_id, part, any_value(x) AS x, min(d * 64 + entry) AS best FROM (
    SELECT p.vec_id, p.part, p.x, c.entry, CAST(list_sum(list_transform(
      range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i]))) AS BIGINT) AS d
    FROM parts p JOIN c1 c USING (part))
  GROUP BY vec_id, part
), c2 AS (
  SELECT part, entry, coalesce(m.x, c.x) AS x FROM c1 c LEFT JOIN (
    SELECT part, entry, list(CAST((total - ((total % n) + n) % n) / n AS BIGINT) ORDER BY pos) AS x
    FROM (
      SELECT part, best % 64 AS entry, pos, CAST(sum(x[pos]) AS BIGINT) AS total, count(*) AS n
      FROM a2, unnest(range(1, len(x) + 1)) u(pos) GROUP BY ALL)
    GROUP BY part, entry) m USING (part, entry)
), a3 AS (
  SELECT vec_id, part, any_value(x) AS x, min(d * 64 + entry) AS best FROM (
    SELECT p.vec_id, p.part, p.x, c.entry, CAST(list_sum(list_transform(
      range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i]))) AS BIGINT) AS d
    FROM parts p JOIN c2 c USING (part))
  GROUP BY vec_id, part
), coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', best % 64)), '' ORDER BY part) AS code,
    CAST(sum(best // 64) AS BIGINT) AS error
  FROM a3 GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM c2) AS codebooks_sha256
FROM coded JOIN v USING (vec_id)
"""

ORACLE: dict[str, str] = {
    "op5_near_duplicates": _NEAR,
    "op10_exact_topk": _TOP,
    "op11_spelling_variants": _SPELLING,
    "op12_warc": _WARC,
    "op13_vector_codes": _CODES,
}
