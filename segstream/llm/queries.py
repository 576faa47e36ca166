"""The operators over the driver's tables, each over all rows of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from segstream.llm.anchors import repeat_digests
from segstream.llm.ann import search
from segstream.llm.attention import score_texts
from segstream.llm.bpe import round_trip
from segstream.llm.common import table
from segstream.llm.divergence import divergence
from segstream.llm.neardup import near_duplicates
from segstream.llm.packing import pack_documents
from segstream.llm.quality import judged
from segstream.llm.repair import damage_and_repair
from segstream.llm.sharding import assign_shards
from segstream.llm.tokenfile import token_digests
from segstream.llm.toxicity import score_documents
from segstream.llm.urls import filter_urls

#: The rules of op1.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85).drop("row")


def op3_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged(table(spark, sf_dir, "documents")).select(*names)


def op6_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op7_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op8_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where("vec_id % 20 = 0"))


def op9_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def op11_fixed_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damage_and_repair(table(spark, sf_dir, "conversations"))


def op13_count_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_attention_scores": op3_attention_scores,
    "op4_token_files": op4_token_files,
    "op5_line_frequency": op5_line_frequency,
    "op6_bpe_transducer": op6_bpe_transducer,
    "op7_tier_packing": op7_tier_packing,
    "op8_kmeans_tree": op8_kmeans_tree,
    "op9_toxicity_grammar": op9_toxicity_grammar,
    "op10_ring_sharding": op10_ring_sharding,
    "op11_fixed_anchors": op11_fixed_anchors,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_count_cells": op13_count_cells,
}

ORACLE: dict[str, str] = {
    "op1_url_filter": """
        WITH rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
                ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
             parts AS (SELECT page_id,
                translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
        SELECT page_id, host, path,
            (SELECT rh || rp FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
             ORDER BY length(rh || rp) DESC, length(rh) DESC LIMIT 1) AS rule,
            coalesce((SELECT v FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
             ORDER BY length(rh || rp) DESC, length(rh) DESC LIMIT 1), 'allow') AS verdict
        FROM parts""",
    "op5_line_frequency": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS body,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
                FROM documents),
             grams AS (SELECT doc_id, body, i, array_to_string(words[i:i + 7], ' ') AS g
                FROM (SELECT doc_id, body, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
             twice AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt
                FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
             repeats AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n FROM twice GROUP BY doc_id),
             line AS (SELECT doc_id, host, body, x, n FROM (SELECT doc_id, host, body,
                    trim(CASE WHEN regexp_matches(l, '\p{L}') THEN regexp_replace(lower(l), '[\x20\x09-\x0D0-9]+', ' ', 'g')
                        ELSE regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g') END) AS x,
                    len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n
                FROM (SELECT doc_id, host, body, unnest(lines) AS l FROM d))),
             size AS (SELECT host, count(DISTINCT body) AS texts FROM d GROUP BY host),
             often AS (SELECT host, x, min(doc_id) AS keeper, count(DISTINCT body) AS docs, min(n) AS n FROM line GROUP BY host, x),
             frequent AS (SELECT host, x, keeper FROM often JOIN size USING (host)
                WHERE docs > 3 AND 100 * docs * greatest(n, 10) > 1 * 10 * texts),
             lost AS (SELECT doc_id, sum(n) AS n FROM line JOIN frequent USING (host, x) WHERE doc_id <> keeper GROUP BY doc_id),
             base AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
                length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0) AS n_lost
                FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN lost USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
            NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_lost >= 0.5 * n_words AS kept
        FROM base""",
    "op11_fixed_anchors": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
             runs AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS g
                FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)),
             later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM runs) WHERE doc_id > first),
             gone AS (SELECT DISTINCT doc_id, i + unnest(range(50)) AS pos FROM later),
             word AS (SELECT doc_id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS pos FROM d),
             kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS body FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
             lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)""",
    "op12_conversation_repair": r"""
        WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
             hit AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::BIGINT)),
                lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, n: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind FROM keyed),
             shaken AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM hit WHERE kind <> 0),
             placed AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM shaken),
             judged AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS r,
                CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                     WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
             counts AS (SELECT conv_id, CASE WHEN count(turn) > 0 THEN max(turn) - min(turn) + 1 - count(DISTINCT turn) ELSE 0 END AS gaps,
                count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM judged GROUP BY conv_id),
             edge(s, want, nxt) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
             keep(s, r, nxt) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
             walk AS (SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'c': 0, 'a': '', 'o': ''} AS best FROM counts
                UNION ALL
                SELECT conv_id, i, s, best FROM (
                    SELECT conv_id, i, s, min({'c': c, 'a': a, 'o': o}) AS best FROM (
                        SELECT conv_id, j.i, unnest(CASE WHEN fault IN ('b', 'd') THEN [{'s': w.s, 'c': w.c + 4, 'a': w.a || 'D', 'o': w.o}]
                            ELSE list_concat([{'s': w.s, 'c': w.c + 4, 'a': w.a || 'D', 'o': w.o},
                                    {'s': edge.nxt, 'c': w.c + 3 + (fault = 't')::INT * 3, 'a': w.a || 'R', 'o': w.o || chr(10) || edge.want || ':' || text}],
                                CASE WHEN keep.nxt IS NULL THEN [] ELSE [{'s': keep.nxt, 'c': w.c + (fault = 't')::INT * 3, 'a': w.a || 'K', 'o': w.o || chr(10) || role || ':' || text}] END)
                            END, recursive := true)
                        FROM (SELECT conv_id, i, s, best.c AS c, best.a AS a, best.o AS o FROM walk
                              UNION ALL SELECT conv_id, i, edge.nxt, best.c + 3, best.a || 'I', best.o || chr(10) || edge.want || ':' FROM walk JOIN edge USING (s)) w
                        JOIN judged j USING (conv_id) JOIN edge ON edge.s = w.s LEFT JOIN keep ON keep.s = w.s AND keep.r = j.r WHERE j.i = w.i + 1)
                    GROUP BY conv_id, i, s)),
             ended AS (SELECT conv_id, min(CASE s WHEN 1 THEN {'c': best.c + 6, 'a': best.a || 'II', 'o': best.o || chr(10) || 'user:' || chr(10) || 'assistant:'}
                    WHEN 2 THEN {'c': best.c + 3, 'a': best.a || 'I', 'o': best.o || chr(10) || 'assistant:'} ELSE best END) AS best
                FROM walk JOIN counts USING (conv_id) WHERE walk.i = counts.n GROUP BY conv_id)
        SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
            coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
            coalesce(best.a, '') AS audit, sha256(coalesce(best.o[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN counts USING (conv_id) LEFT JOIN ended USING (conv_id)""",
    "op13_count_cells": r"""
        WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
             t AS (SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
             kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
             held AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
             langs AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
             groups AS (SELECT g.lang, g.source, coalesce(v, 0) AS v, langs.n AS lang_n, coalesce(h.n, 0) AS n
                FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs USING (lang)
                LEFT JOIN (SELECT lang, source, sum(c) AS n FROM held GROUP BY lang, source) h ON h.lang = g.lang AND h.source = g.source),
             shares AS (SELECT g.lang, g.source, k.term, coalesce(h.c, 0) AS c,
                1 + 1000000000::HUGEINT * (coalesce(h.c, 0) + 1) // (g.n + g.v) AS p, 1 + 1000000000::HUGEINT * (k.c + 1) // (g.lang_n + g.v) AS q
                FROM groups g JOIN kept k USING (lang) LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
             summed AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p) - ((a.p - b.p) * (a.p - b.p)) % b.p) // b.p) AS value
                FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
             pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
                FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
                LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
             over AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares WHERE c > 0 AND p > q),
             lines AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM over)
        SELECT lang, source, part, item, value, rank::INT AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM lines) WHERE part = 'pair' OR rank <= 200""",
}
