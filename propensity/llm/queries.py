"""The registered query of each operator, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.registry import registry
from propensity.llm import alignment, decontaminate, fingerprint, language, lm_score, main_text, middle, mixing
from propensity.llm import ngram_join, pieces, pii, quality, token_counts
from propensity.llm.common import read, remainder

QUERIES, ORACLES, query = registry()


@query()
def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by the model and by the add-one unigram base; one seventh of the ids is held out."""
    return lm_score.score(read(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


@query()
def op2_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token counts of all documents under a 32,000-piece vocabulary, and where 4,096 tokens end."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(read(spark, sf_dir, "documents"), path, limit=4096)


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; its source is the host and its language the path."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality.score(docs, labels, F.col("source"), F.col("lang"))


@query()
def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(read(spark, sf_dir, "pages"))


@query()
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of benchmark items, the passage and its alignment score."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), threshold=0.5)


@query()
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the two thirds of labelled ids that are not held out."""
    docs, part = read(spark, sf_dir, "documents"), remainder("doc_id", 3)
    told = language.predict(docs, language.fit(docs.where(part != 1)))
    return told.select("doc_id", (part == 1).alias("held_out"), "lang_pred", "score", "accepted")


@query(
    r"""
    WITH RECURSIVE counted AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS n
      FROM documents),
    sums AS (SELECT source, CAST(sum(n) AS BIGINT) AS tokens FROM counted GROUP BY source HAVING sum(n) > 0),
    shares AS (SELECT *, tokens / (SELECT sum(tokens) FROM sums) AS share FROM sums),
    halves AS (
      SELECT 0 AS step, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high, (SELECT max(share) / min(share) FROM shares) AS spread
      UNION ALL
      SELECT step + 1, CASE WHEN pow(spread, 1 - (low + high) / 2) <= 4 THEN low ELSE (low + high) / 2 END,
        CASE WHEN pow(spread, 1 - (low + high) / 2) <= 4 THEN (low + high) / 2 ELSE high END, spread
      FROM halves WHERE step < 40),
    raised AS (SELECT *, pow(share, (SELECT round(high, 9) FROM halves WHERE step = 40)) AS power FROM shares),
    weighted AS (
      SELECT source, tokens, round(power / (SELECT sum(power) FROM raised), 9) AS weight,
        round(power / share / (SELECT min(power / share) FROM raised), 6) AS repeats
      FROM raised),
    blocks AS (SELECT CAST(ceil(sum(tokens * repeats) / 1048576) AS BIGINT) AS blocks FROM weighted),
    uses AS (
      SELECT c.doc_id, c.source, c.n, w.tokens, w.weight, w.repeats, unnest(range(CAST(ceil(w.repeats) AS BIGINT))) AS round
      FROM counted c JOIN weighted w ON c.source IS NOT DISTINCT FROM w.source WHERE c.n > 0),
    placed AS (
      SELECT *, round * tokens + coalesce(sum(n) OVER (
          PARTITION BY source, round ORDER BY md5('mix:' || round || ':' || doc_id), doc_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spot
      FROM uses)
    SELECT doc_id, source, CAST(round AS INT) AS round,
      CAST(least(floor(spot / (tokens * repeats) * blocks), blocks - 1) AS BIGINT) AS block,
      md5('mix:place:' || round || ':' || doc_id) AS place, n AS n_tokens, weight, repeats
    FROM placed, blocks WHERE spot < tokens * repeats
    UNION ALL
    SELECT doc_id, source, 0, 0, md5('mix:place:0:' || doc_id), n, NULL, NULL FROM counted WHERE n = 0
    """
)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt into blocks of about a million tokens, no source repeated over four times as often as another."""
    return mixing.mix(read(spark, sf_dir, "documents"), repeat=4.0, block_tokens=1 << 20)


@query()
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and spans of patterns, and spans of terms that disclose them."""
    return pii.digests(pii.spans(read(spark, sf_dir, "documents")))


@query()
def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses."""
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


@query(
    r"""
    WITH RECURSIVE cut AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) >= 5
          THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
      FROM cut),
    parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    links AS (
      SELECT x.doc_id AS a, y.doc_id AS b FROM parts x JOIN parts y ON x.g = y.g AND x.doc_id <> y.doc_id
      GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
    reach AS (
      SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
    FROM sets LEFT JOIN least ON doc_id = a
    """
)
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five-word shingles, Jaccard of 0.75 or more."""
    return ngram_join.linked_components(read(spark, sf_dir, "documents"), size=5, percent=75)


@query()
def op11_pieces(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """All documents encoded with begin and end ids under a 32,000-piece vocabulary, and decoded again."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(read(spark, sf_dir, "documents"), path)


@query(
    r"""
    WITH cut AS (
      SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
      FROM documents),
    drawn AS (
      SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS h1,
        CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4
      FROM cut),
    formed AS (
      SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 50 THEN 'plain'
          WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(u[1:least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
        array_to_string(u[greatest(h1, h2) + 1:], '') AS s
      FROM drawn)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
      sha256(t) AS restored_sha256
    FROM formed
    """
)
def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it is or with its middle moved to the end, and the text rebuilt from that."""
    return middle.digests(middle.transform(read(spark, sf_dir, "documents"), changed_percent=50, spm_percent=80, seed=42))


@query()
def op13_alignment(spark: SparkSession, sf_dir: str, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """Groups and links of the tokens of two vocabularies in every document, and how often the linked ids meet."""
    byte_path = byte_path or public_tokenizers.path("byte_bpe_50k.json")
    piece_path = piece_path or public_tokenizers.path("piece_bpe_32k.model")
    return alignment.link_scores(read(spark, sf_dir, "documents"), byte_path, piece_path).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
