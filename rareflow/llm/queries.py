"""One query for each corpus operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.llm import (
    collocations,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    packing,
    prefix_trie,
    quality_nbsvm,
    quality_rules,
    sharding,
    simhash,
    toxicity,
    vantage,
)
from rareflow.llm.common import documents, held_out, labels


def toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs, labels(spark, sf_dir))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


def license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return license_scan.scan(docs, license_scan.train(docs))


def harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def exact_dedup_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    digest = F.sha2(exact_dedup.normalised(docs["text"]), 256).alias("text_sha256")
    return exact_dedup.exact_groups(docs, carry=[digest]).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def sharding_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir))


def quality_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_nbsvm.train(docs, labels(spark, sf_dir))
    return quality_nbsvm.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def mixing_golden_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def language_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.train_and_identify(documents(spark, sf_dir)).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score"
    )


def prefix_trie_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def collocations_setm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def neighbours_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity_crf": toxicity_crf,
    "op2_license_paragraphs": license_paragraphs,
    "op3_harmonic_packing": harmonic_packing,
    "op4_quality_cascade": quality_cascade,
    "op5_simhash_pivots": simhash_pivots,
    "op6_exact_dedup_refined": exact_dedup_refined,
    "op7_sharding_label_propagation": sharding_label_propagation,
    "op8_quality_nb_svm": quality_nb_svm,
    "op9_mixing_golden_ratio": mixing_golden_ratio,
    "op10_language_hyperdimensional": language_hyperdimensional,
    "op11_prefix_trie_skeleton": prefix_trie_skeleton,
    "op12_collocations_setm": collocations_setm,
    "op13_neighbours_vantage_trees": neighbours_vantage_trees,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op4_quality_cascade": rf"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text, {_WORDS} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS win
        FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 5)) AS o(k) GROUP BY r),
base AS (
    SELECT doc_id, text, w, lines, len(w) AS n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(covered.n, 0) AS n_repeat_words
    FROM d LEFT JOIN covered USING (r)),
judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           n_symbols * 4 > word_chars
           OR len(list_filter(w, lambda x: x IN ('|', '<', '>', '•', '-'))) * 4 > n_words
           OR length(regexp_replace(text, '[A-Z]', '', 'g')) * 2 < length(text)
           OR length(text) - length(replace(text, '!', '')) > n_words
           OR n_dup_lines * 2 > len(lines)
           OR word_chars < 2 * n_words OR word_chars > 25 * n_words AS rejected
    FROM base)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged""",
    "op6_exact_dedup_refined": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm)""",
    "op11_prefix_trie_skeleton": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, list({'k': md5(concat(length(role), ':', role, text)), 'z': length(text)}
                         ORDER BY turn NULLS FIRST) AS t
    FROM turns GROUP BY conv_id),
crc AS (
    SELECT conv_id, xor(list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                    lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x)
                            WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END), 4294967295) % 6 AS h
    FROM own),
convs AS (
    SELECT o.conv_id, list_concat(coalesce(b.t, [])[:h], o.t[h + 1:]) AS t
    FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
members AS (
    SELECT conv_id, len(t) AS turns, d, array_to_string(list_transform(t[:d], lambda x: x.k), '') AS path,
           coalesce(t[d].z, 0) AS z
    FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM convs)),
nodes AS (
    SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(z) AS z,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = d), '')) AS ends_sha256
    FROM members GROUP BY path),
kids AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
    SELECT left(n.path, 32 * u) AS path, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves,
           sum((n.n_convs - 1) * n.z) AS saved
    FROM (SELECT *, unnest(range(0, depth + 1)) AS u FROM nodes) n LEFT JOIN kids k ON k.path = n.path GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN kids k ON k.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, length(n.path) - 32)""",
    "op12_collocations_setm": r"""
WITH pieces AS MATERIALIZED (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
totals AS MATERIALIZED (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS MATERIALIZED (
    SELECT lang, m, w[i:i + m - 1] AS g
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 5) AS sizes(m))),
f AS MATERIALIZED (SELECT lang, m, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS a
      FROM grams GROUP BY lang, m, array_to_string(g, ' ') HAVING count(*) >= 30),
parts AS MATERIALIZED (
    SELECT lang, phrase, a, k, array_to_string(g[:k], ' ') AS head, array_to_string(g[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1)),
heads AS MATERIALIZED (SELECT p.*, f.a AS l FROM parts p JOIN f ON f.lang = p.lang AND f.phrase = p.head),
cuts AS MATERIALIZED (
    SELECT h.lang, h.phrase, h.a, h.k, h.l, f.a AS r, 2000000::HUGEINT * h.a // (h.l + f.a) AS score
    FROM heads h JOIN f ON f.lang = h.lang AND f.phrase = h.tail),
low AS MATERIALIZED (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS MATERIALIZED (
    SELECT lang, array_to_string(g[i:i + p - 1], ' ') AS phrase, max(a) AS most
    FROM (SELECT lang, g, a, p, unnest(range(1, m - p + 2)) AS i FROM f, range(2, 4) AS sizes(p) WHERE p < m)
    GROUP BY 1, 2),
kept AS MATERIALIZED (SELECT low.* FROM low LEFT JOIN inside USING (lang, phrase)
         WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
    "op13_neighbours_vantage_trees": """
WITH v AS (
    SELECT vec_id, embedding::DOUBLE[] AS x, len(embedding) AS d, row_number() OVER () AS r FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
      AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
pairs AS (
    SELECT q.vec_id AS query_id, q.r AS q, c.vec_id, c.r AS c, list_dot_product(q.x, c.x) AS score
    FROM v q JOIN v c ON c.r <> q.r AND c.d = q.d WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, c)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
}
