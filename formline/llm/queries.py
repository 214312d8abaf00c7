"""Registered queries of this subpackage, one per operator, and their SQL twins where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from formline.llm import (
    bpe_count,
    decontaminate,
    filter_audit,
    html_text,
    kneser_ney,
    lang_id,
    mixture,
    periodic_runs,
    piece_codec,
    prefix_forest,
    simhash,
    suffix_dedup,
    url_filter,
)
from formline.llm.common import read_table


#: The rules of ``op8_url_filter``.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op1_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(read_table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_removed(read_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_count.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.train_and_score(read_table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(read_table(spark, sf_dir, "embeddings"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.predictions(read_table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixed_documents(read_table(spark, sf_dir, "documents"))


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.digests(piece_codec.round_trip(read_table(spark, sf_dir, "documents"), model))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(read_table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_groups,
        op2_html_text,
        op3_suffix_dedup,
        op4_token_counts,
        op5_decontamination,
        op6_kneser_ney,
        op7_nearest_neighbours,
        op8_url_filter,
        op9_language_id,
        op10_source_mix,
        op11_piece_codec,
        op12_filter_audit,
        op13_periodic_runs,
    )
}
ORACLES: dict[str, str] = {
    # every passage of every text against every item, from shared five-word shingles
    "op5_decontamination": r"""
WITH items AS (
  SELECT item_id, words, n, least(5, n) AS width, n - greatest(1, n // 3) AS question
  FROM (SELECT item_id, w AS words, len(w) AS n
        FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark))
  WHERE n > 0
), reach AS (
  SELECT CAST((max(n) + max(n) // 5 - 1 + 31) // 32 + 1 AS BIGINT) AS r FROM items
), item_shingles AS (
  SELECT item_id, width, p, array_to_string(words[p + 1 : p + width], ' ') AS sh
  FROM (SELECT *, unnest(range(0, n - width + 1)) AS p FROM items)
), sizes AS (
  SELECT item_id, count(DISTINCT sh) AS m FROM item_shingles GROUP BY item_id
), texts AS (
  SELECT doc_id, words, len(words) AS n
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents)
), text_shingles AS (
  SELECT doc_id, n, width, p, array_to_string(words[p + 1 : p + width], ' ') AS sh
  FROM (SELECT *, unnest(range(0, n - width + 1)) AS p
        FROM texts CROSS JOIN (SELECT DISTINCT width FROM items) WHERE n >= width)
), hits AS (
  SELECT doc_id, item_id, sh,
         unnest(range(greatest(0, (p + t.width + 31) // 32 - r),
                      least(p // 32, greatest((n + 31) // 32 - r, 0)) + 1)) AS k
  FROM text_shingles t JOIN (SELECT DISTINCT item_id, width, sh FROM item_shingles) i USING (width, sh)
       CROSS JOIN reach
), shares AS (
  SELECT doc_id, k, item_id, count(DISTINCT sh) / any_value(m) AS share
  FROM hits JOIN sizes USING (item_id) GROUP BY doc_id, k, item_id
), covered AS (
  SELECT DISTINCT doc_id, k, h.item_id, unnest(range(p, p + width)) AS place
  FROM hits h JOIN item_shingles s ON h.item_id = s.item_id AND h.sh = s.sh
), parts AS (
  SELECT doc_id, k, c.item_id,
         count(*) FILTER (place < question) AS q, any_value(question) AS nq,
         count(*) FILTER (place >= question) AS a, any_value(n - question) AS na
  FROM covered c JOIN items i ON c.item_id = i.item_id GROUP BY doc_id, k, c.item_id
)
SELECT doc_id, item_id, count(*) AS n_passages, max(share) AS similarity
FROM shares JOIN parts USING (doc_id, k, item_id)
WHERE share >= 0.8 - 1e-9 AND 2 * q >= nq AND 2 * a >= na
GROUP BY doc_id, item_id
""",
    # failure bits of every document, counted per part, then every step of every order over the counts
    "op12_filter_audit": r"""
WITH docs AS (
  SELECT doc_id, coalesce(CAST(lang AS VARCHAR), '') AS part, coalesce(text, '') AS t FROM documents
), worded AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs
), marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id
), bits AS (
  SELECT part, d.doc_id,
         CAST(len(w) < 100 AS INTEGER)
         + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INTEGER)
         + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS INTEGER)
         + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
         + 16 * CAST(coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS INTEGER) AS fails
  FROM worded d
), counted AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM bits LEFT JOIN marks ON bits.doc_id = marks.doc_id GROUP BY part, fails
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), taken AS (
  SELECT filter_order, step, bits[step] AS f, coalesce(list_sum(bits[1 : step - 1]), 0) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), sizes AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, f,
         CAST(sum(CASE WHEN fails & CAST(before + f AS INTEGER) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN fails & f > 0 AND fails & CAST(before AS INTEGER) = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN fails & f > 0 AND fails & CAST(before AS INTEGER) > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN fails = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN fails & f > 0 AND fails & CAST(before AS INTEGER) = 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN fails & f > 0 AND fails & CAST(before AS INTEGER) = 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM counted, taken GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM sizes
""",
}
