"""The registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, langid, mixing, pieces, pii, prefixtrie, quality, simhash, sitetree, substring, topk, toxicity
from .common import table

TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sitetree.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template",
                        "n_marked")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def number(k: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")

    counts = [number(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.written(base), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, langid.remainder() != 1)
    predicted = langid.predict(docs, model)
    return predicted.select("doc_id", F.coalesce(langid.remainder() == 1, F.lit(False)).alias("held_out"),
                            "lang_pred", "score")


def op11_sentencepiece_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(table(spark, sf_dir, "documents"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash_near_dedup, op2_bpe_encode_decode, op3_exact_top_k, op4_main_text,
                            op5_quality_rules, op6_toxicity_severity, op7_substring_dedup, op8_personal_data,
                            op9_mix_sources, op10_language_id, op11_sentencepiece_encode_decode,
                            op12_phrase_collocations, op13_conversation_prefix_trie)}

ORACLES: dict[str, str] = {
    "op3_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 50 = 0),
        r AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op7_substring_dedup": r"""
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
        windows AS (
            SELECT doc_id, word, pos, list(word) OVER ahead AS win, count(*) OVER ahead = 20 AS whole
            FROM words
            WINDOW ahead AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
        judged AS (
            SELECT doc_id, word, pos, whole
                AND row_number() OVER (PARTITION BY whole, win ORDER BY doc_id, pos) > 1 AS later
            FROM windows),
        covered AS (
            SELECT doc_id, word, pos, bool_or(later) OVER (
                PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
            FROM judged),
        kept AS (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed,
                coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS words
            FROM covered GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(words, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)
    """,
    "op12_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
            FROM documents),
        starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
        counts AS (
            SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
            FROM starts, range(1, 5) s(size) WHERE i + size - 1 <= len(w) GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 30),
        cuts AS (
            SELECT c.lang, c.size, c.phrase, c.f AS a, l.f AS l, r.f AS r, k,
                CAST(2000000 * CAST(c.f AS HUGEINT) // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
            JOIN counts l ON l.lang = c.lang AND l.size = k AND l.phrase = array_to_string(c.w[1:k], ' ')
            JOIN counts r ON r.lang = c.lang AND r.size = c.size - k
                AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
        scored AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        covered AS (
            SELECT DISTINCT c.lang, c.phrase
            FROM candidates c JOIN (
                SELECT lang, f, size, unnest(range(2, size)) AS part, w FROM candidates) x
                ON x.lang = c.lang AND x.part = c.size
            WHERE 100 * x.f >= 80 * c.f
                AND list_contains(list_transform(range(1, x.size - c.size + 2),
                    lambda i: array_to_string(x.w[i:i + c.size - 1], ' ')), c.phrase)),
        ranked AS (
            SELECT s.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM scored s ANTI JOIN covered USING (lang, phrase))
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
    "op13_conversation_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns,
                xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
                        string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
                    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                        lambda v, bit: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)),
                    4294967295::UBIGINT) % 4 AS h
            FROM turns GROUP BY conv_id),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(g.turns, [])[1:CAST(c.h AS BIGINT)],
                c.turns[CAST(c.h AS BIGINT) + 1:]) AS turns
            FROM convs c LEFT JOIN convs g ON g.conv_id = c.conv_id - c.conv_id % 20),
        starts AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
        nodes AS (
            SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                    FILTER (depth = len(turns)), '')) AS ends_sha256
            FROM starts GROUP BY ALL),
        children AS (
            SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
        own AS (
            SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children,
                (n.n_convs - 1) * len(regexp_extract_all(coalesce(n.path[n.depth].text, ''), '[^ 	-
]+')) AS saved
            FROM nodes n LEFT JOIN children c USING (path)
            LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]),
        lines AS (SELECT path, unnest(range(0, depth + 1)) AS up, n_children, saved FROM own),
        totals AS (
            SELECT path[1:up] AS path, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves,
                CAST(sum(saved) AS BIGINT) AS saved_tokens
            FROM lines GROUP BY ALL)
        SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        FROM own JOIN totals USING (path)
    """,
}
