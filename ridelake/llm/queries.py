"""Registered queries of the operators, with production parameters, each over
its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, editcount, htmltext, kdtree, langid, licenses, minhash, packing, piece, prefixtrie,
               quality, simhash, wavelet)
from .common import table, written


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return minhash.edit_report(table(spark, sf_dir, "documents"))


def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op4_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    return quality.quality(table(spark, sf_dir, "documents"))


def op5_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to pieces and decoded again."""
    out = piece.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def _three_edits(text: Column) -> Column:
    """Stand-in edits of a document: a passage replaced by its first
    characters, its last ones inserted in the middle, its start deleted."""
    n = F.length(text)
    third, half = (n / 3).cast("long"), (n / 2).cast("long")

    def change(start: Column, stop: Column, replacement: Column) -> Column:
        return F.struct(start.alias("start"), stop.alias("stop"), replacement.alias("replacement"))

    return F.array(change(third, third + 7, F.left(text, F.lit(11))),
                   change(half, half, F.right(text, F.lit(5))),
                   change(F.lit(0).cast("long"), F.lit(3).cast("long"), F.lit("")))


def op8_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits."""
    path = vocabulary("byte_bpe_50k.json")
    kept = written(editcount.trees(table(spark, sf_dir, "documents"), path), "trees")
    return editcount.recount(kept, _three_edits(F.coalesce("text", F.lit(""))), path)


def op9_wavelet_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read back from their wavelet token files."""
    files = wavelet.write_token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return wavelet.read_documents(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt on the heads of
    their hundreds."""
    return prefixtrie.shared_prefixes(table(spark, sf_dir, "conversations"))


def op12_kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten rows of greatest inner product with every hundredth vector."""
    found = kdtree.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 100 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two to four words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_minhash_fingerprints": op2_minhash_fingerprints,
    "op3_pack_sequences": op3_pack_sequences,
    "op4_quality_outliers": op4_quality_outliers,
    "op5_piece_round_trip": op5_piece_round_trip,
    "op6_license_scan": op6_license_scan,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_edit_token_counts": op8_edit_token_counts,
    "op9_wavelet_token_files": op9_wavelet_token_files,
    "op10_html_blocks": op10_html_blocks,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_kd_tree_top_k": op12_kd_tree_top_k,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLE: dict[str, str] = {
    "op11_prefix_trie": """
WITH RECURSIVE turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS step
  FROM conversations WHERE conv_id IS NOT NULL),
digits AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM turns),
crc(conv_id, s, bit, v) AS (
  SELECT conv_id, s, 0, 4294967295::BIGINT FROM digits
  UNION ALL
  SELECT conv_id, s, bit + 1,
         CASE WHEN w % 2 = 1 THEN xor(w // 2, 3988292384) ELSE w // 2 END
  FROM (SELECT conv_id, s, bit, CASE WHEN bit % 8 = 0 THEN xor(v, ord(s[bit // 8 + 1])::BIGINT) ELSE v END AS w
        FROM crc WHERE bit < 8 * length(s))),
heads AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(v, 4294967295) % 6 AS h
          FROM crc WHERE bit = 8 * length(s)),
rebuilt AS (
  SELECT h.conv_id, 0 AS own, t.pos, t.step FROM heads h JOIN turns t ON t.conv_id = h.base AND t.pos <= h.h
  UNION ALL
  SELECT h.conv_id, 1, t.pos, t.step FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.pos > h.h),
whole AS (SELECT h.conv_id, coalesce(w.steps, []) AS steps FROM heads h LEFT JOIN (
  SELECT conv_id, list(step ORDER BY own, pos) AS steps FROM rebuilt GROUP BY conv_id) w USING (conv_id)),
member AS (
  SELECT conv_id, d, len(steps) AS depth, md5(steps[1:d]::JSON::VARCHAR) AS id, md5(steps[1:d - 1]::JSON::VARCHAR) AS parent,
         CASE WHEN d > 0 THEN length(steps[d].text) ELSE 0 END AS size
  FROM (SELECT *, unnest(range(0, len(steps) + 1)) AS d FROM whole)),
node AS (
  SELECT d, id, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = d), '')) AS ends_sha256
  FROM member GROUP BY d, id),
kids AS (SELECT d - 1 AS d, parent AS id, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
pairs AS (SELECT DISTINCT v.d AS vd, v.id AS vid, u.d, u.id FROM member v JOIN member u ON u.conv_id = v.conv_id AND u.d >= v.d),
below AS (
  SELECT vd AS d, vid AS id, sum((n.n_convs - 1) * n.size) AS saved_tokens,
         count(*) FILTER (k.n_children IS NULL) AS n_leaves
  FROM pairs p JOIN node n ON n.d = p.d AND n.id = p.id LEFT JOIN kids k ON k.d = p.d AND k.id = p.id GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM node n JOIN below b USING (d, id) LEFT JOIN kids k USING (d, id)
LEFT JOIN node p ON n.d > 0 AND p.d = n.d - 1 AND p.id = n.parent
""",
    "op12_kd_tree_top_k": """
WITH parts AS (
  SELECT vec_id, row_number() OVER () AS r, embedding, generate_subscripts(embedding, 1) AS i FROM embeddings),
whole AS (
  SELECT r, vec_id, list(floor(1024 * embedding[i]::DOUBLE) ORDER BY i) AS v FROM parts GROUP BY r, vec_id
  HAVING bool_and(embedding[i] IS NOT NULL AND isfinite(embedding[i]::DOUBLE))),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 10
""",
    "op13_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM worded, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k),
counted AS (
  SELECT lang, k AS words, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM placed GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE words = 1 GROUP BY lang),
cand AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE words >= 2 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
         (2000000::HUGEINT * c.f // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand) c
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_of AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, words - size + 2)) AS i
        FROM (SELECT *, unnest(range(2, words)) AS size FROM cand))
  GROUP BY ALL),
ranked AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score,
         row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM weakest s LEFT JOIN inner_of i USING (lang, phrase)
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * s.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""",
}
