"""The queries of this package, and the DuckDB SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import bpe, counts, langid, mix, negatives, order, recipes, resample, rules, shards, simhash, trie, warc
from ledgermill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Query]:
    return {
        "op1_simhash_near_dedup": on_documents(simhash.near_duplicates),
        "op2_training_order": on_documents(order.training_order),
        "op3_hypergeometric_shards": on_documents(shards.shuffle),
        "op4_chunk_recipes": on_documents(recipes.duplicates),
        "op5_language_id": on_documents(langid.identify),
        "op6_quality_rules": on_documents(rules.judge),
        "op7_source_mixing": on_documents(mix.mix),
        "op8_importance_resampling": lambda spark, folder: resample.resample(
            table(spark, folder, "documents"), table(spark, folder, "labels")),
        "op9_bpe": on_documents(bpe.digests),
        "op10_warc_index": lambda spark, folder: warc.archive(table(spark, folder, "pages")),
        "op11_token_counts": on_documents(counts.token_counts),
        "op12_hard_negatives": lambda spark, folder: negatives.hard_negatives(
            table(spark, folder, "embeddings")),
        "op13_conversation_trie": lambda spark, folder: trie.prefix_trie(
            table(spark, folder, "conversations")),
        "pipeline": pipeline,
    }


_WORDS = r"'[^\x20\x09-\x0D]+'"
_STOP = "|".join(dict.fromkeys(rules.STOP_WORDS))


def _op4() -> str:
    return """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS n FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(n) AS text_sha256
FROM t WINDOW w AS (PARTITION BY n)"""


def _op6() -> str:
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, {_WORDS}) AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORDS})) AS lines FROM t),
windows AS (SELECT doc_id, i, words[i:i + 7] AS win
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
twice AS (SELECT doc_id, i FROM windows
          QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
            FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY 1),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
             len(list_filter(words, lambda x: regexp_full_match(x, '(?i)({_STOP})([.,].*)?')))::BIGINT AS n_stop_words
      FROM w LEFT JOIN covered c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words
       AND 100 * n_symbols <= 10 * n_words AND 100 * n_stop_words >= n_words
       AND 100 * n_dup_lines <= 50 * n_lines AS kept, n_lines, n_stop_words
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)"""


def mixing(docs: str) -> str:
    """CTEs from ``docs`` (doc_id, text, source) to ``mixed`` with what each row gives."""
    return rf"""
sized AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), {_WORDS}))::BIGINT AS size,
                 md5('{mix.SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS key
          FROM {docs}),
sources AS (SELECT source, sum(size)::BIGINT AS source_size,
                   ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {mix.WEIGHTS}) + 1 AS weight
            FROM sized GROUP BY source),
level AS (SELECT *, sum(source_size) OVER () - {mix.MOST} * coalesce(sum(source_size) OVER b, 0) AS rest,
                 sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS open_weight
          FROM sources
          WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, rest * weight > {mix.MOST} * source_size * open_weight AS limited FROM level),
target AS (SELECT source, source_size,
                  CASE WHEN limited THEN ({mix.MOST} * source_size)::DOUBLE
                       ELSE ((sum(source_size) OVER () - coalesce(sum(CASE WHEN limited THEN {mix.MOST} * source_size END) OVER (), 0))
                             * weight)::DOUBLE / (sum(CASE WHEN NOT limited THEN weight END) OVER ())::DOUBLE
                  END AS target FROM flagged),
budget AS (SELECT *, floor(target + 0.5)::BIGINT AS budget FROM target),
placed AS (SELECT s.*, b.source_size, b.target, b.budget,
                  CASE WHEN b.source_size > 0 THEN b.budget // b.source_size ELSE 0 END AS passes,
                  coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, size, doc_id
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
           FROM sized s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source),
mixed AS (SELECT *, (passes * size + greatest(0, least(size, budget - passes * source_size - before)))::BIGINT AS taken
          FROM placed)"""


def _op7() -> str:
    return f"WITH {mixing('documents')}\nSELECT doc_id, size, source_size, target, taken FROM mixed"


def _op10() -> str:
    return f"""
WITH t AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM t)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warc.LEAST_PAYLOAD} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {warc.LEAST_PAYLOAD} AND page_id <> first THEN first END AS refers_to
FROM f"""


def _op12() -> str:
    every, low, high = negatives.EVERY, negatives.LOW, negatives.HIGH
    return f"""
WITH t AS (SELECT row_number() OVER () AS uid, vec_id,
                  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.uid AS a, a.vec_id AS anchor_id, c.uid AS c, c.vec_id AS other, a.label = c.label AS same,
             coalesce(list_sum(list_transform(range(1, least(len(a.v), len(c.v)) + 1),
                                              lambda i: a.v[i] * c.v[i])), 0)::BIGINT AS score
      FROM t a JOIN t c ON a.vec_id % {every} = 0 AND a.uid <> c.uid),
p AS (SELECT a, anchor_id, other AS positive_id, score,
             row_number() OVER (PARTITION BY a ORDER BY score DESC, other NULLS LAST) AS slot
      FROM s WHERE same QUALIFY slot <= {negatives.POSITIVES})
SELECT p.anchor_id, p.positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
       (row_number() OVER (PARTITION BY p.a, p.slot ORDER BY s.score DESC, s.other NULLS LAST))::INTEGER AS rank
FROM p JOIN s ON p.a = s.a AND NOT s.same AND {low} * p.score <= 100 * s.score AND 100 * s.score <= {high} * p.score
QUALIFY rank <= {negatives.NEGATIVES}"""


def _crc32(text: str) -> str:
    """CRC-32 of a string of digits and signs, bit by bit."""
    bit = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)"
    byte = f"list_reduce(list_prepend(xor(a, b), [0::BIGINT FOR i IN range(8)]), lambda x, y: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {byte}), 4294967295::BIGINT)"


def _op13() -> str:
    heads, family = trie.HEADS, trie.FAMILY
    return rf"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, turn, len(regexp_extract_all(text, {_WORDS}))::BIGINT AS words,
             sha256('turn' || octet_length(encode(role)) || ' ' || role || text) AS name FROM t),
own AS (SELECT c, list(name ORDER BY turn NULLS FIRST, name) AS names,
               list(words ORDER BY turn NULLS FIRST, name) AS words FROM n GROUP BY c),
h AS (SELECT c, c - c % {family} AS base, {_crc32('c::VARCHAR')} % {heads} AS h FROM own),
r AS (SELECT h.c, coalesce(b.names[1:h.h], []) || o.names[h.h + 1:] AS names,
             coalesce(b.words[1:h.h], []) || o.words[h.h + 1:] AS words
      FROM h JOIN own o ON o.c = h.c LEFT JOIN own b ON b.c = h.base),
path AS (SELECT c, d, md5(array_to_string(names[1:d], ' ')) AS name,
                CASE WHEN d > 1 THEN md5(array_to_string(names[1:d - 1], ' ')) WHEN d = 1 THEN md5('') END AS parent,
                CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(names) AS ends
         FROM (SELECT *, unnest(range(0, len(names) + 1)) AS d FROM r)),
node AS (SELECT name, d, any_value(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
         FROM path GROUP BY name, d),
kids AS (SELECT parent AS name, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent),
sums AS (SELECT p.name, p.d, sum((k.n IS NULL)::BIGINT) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
         FROM node v LEFT JOIN kids k ON k.name = v.name JOIN path p ON p.c = v.conv_id AND p.d <= v.d GROUP BY 1, 2)
SELECT v.conv_id, v.d::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM node v JOIN sums s USING (name, d) LEFT JOIN kids k ON k.name = v.name LEFT JOIN node u ON u.name = v.parent"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others are tested against brute force."""
    return {"op4_chunk_recipes": _op4(), "op6_quality_rules": _op6(), "op7_source_mixing": _op7(),
            "op10_warc_index": _op10(), "op12_hard_negatives": _op12(),
            "op13_conversation_trie": _op13()}
