"""The registered query of every operator, over its whole table, and the SQL it is compared to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import (
    bpe,
    exact,
    jaccard,
    kdtree,
    langid,
    mixing,
    onebit,
    quality,
    secrets,
    sharding,
    spelling,
    trie,
    wavelet,
)
from eventlake.llm.tables import read_table


def op1_quality(spark: SparkSession, tables: str) -> DataFrame:
    return quality.quality_report(
        read_table(spark, tables, "documents"), read_table(spark, tables, "labels")
    )


def op2_top_products(spark: SparkSession, tables: str) -> DataFrame:
    return kdtree.top_products(read_table(spark, tables, "embeddings"))


def op3_wavelet(spark: SparkSession, tables: str) -> DataFrame:
    return wavelet.wavelet_report(
        read_table(spark, tables, "documents"), vocabulary_file("word_bpe_49k.json")
    )


def op4_secrets(spark: SparkSession, tables: str) -> DataFrame:
    return secrets.secret_report(read_table(spark, tables, "documents"))


def op5_jaccard(spark: SparkSession, tables: str) -> DataFrame:
    return jaccard.similar_groups(
        read_table(spark, tables, "documents"), jaccard.Settings(words=4, percent=85)
    )


def op6_shards(spark: SparkSession, tables: str) -> DataFrame:
    return sharding.shard_report(read_table(spark, tables, "documents"))


def op7_mix(spark: SparkSession, tables: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, tables, "documents"))


def vocabulary_file(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_bpe(spark: SparkSession, tables: str) -> DataFrame:
    return bpe.bpe_report(
        read_table(spark, tables, "documents"), vocabulary_file("byte_bpe_50k.json")
    )


def op9_language(spark: SparkSession, tables: str) -> DataFrame:
    return langid.language_report(read_table(spark, tables, "documents"))


def op10_nearest(spark: SparkSession, tables: str) -> DataFrame:
    return onebit.nearest(read_table(spark, tables, "embeddings"))


def op11_prefix_trie(spark: SparkSession, tables: str) -> DataFrame:
    return trie.trie_report(read_table(spark, tables, "conversations"))


def op12_exact_copies(spark: SparkSession, tables: str) -> DataFrame:
    return exact.duplicate_report(read_table(spark, tables, "documents"))


def op13_spelling(spark: SparkSession, tables: str) -> DataFrame:
    return spelling.spelling_report(read_table(spark, tables, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_top_products": op2_top_products,
    "op3_wavelet": op3_wavelet,
    "op4_secrets": op4_secrets,
    "op5_jaccard": op5_jaccard,
    "op6_shards": op6_shards,
    "op7_mix": op7_mix,
    "op8_bpe": op8_bpe,
    "op9_language": op9_language,
    "op10_nearest": op10_nearest,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_exact_copies": op12_exact_copies,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL: dict[str, str] = {
    "op2_top_products": """
        WITH rows AS (
            SELECT row_number() OVER () AS number, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.number, q.vec_id AS query_id, c.vec_id,
                   list_inner_product(q.v, c.v)::BIGINT AS score
            FROM rows q JOIN rows c ON q.number <> c.number AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   row_number() OVER (PARTITION BY number ORDER BY score DESC, vec_id)::INT AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op5_jaccard": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(
                string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda word: word <> '') AS words
            FROM documents
        ), shingles AS (
            SELECT doc_id, CASE
                WHEN words IS NULL OR len(words) = 0 THEN []::VARCHAR[]
                WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 2),
                                                  lambda i: array_to_string(words[i:i + 3], ' ')))
                END AS grams
            FROM split
        ), sizes AS (
            SELECT doc_id, len(grams)::BIGINT AS n_shingles FROM shingles
        ), spread AS (
            SELECT doc_id, unnest(grams) AS gram FROM shingles
        ), shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM spread a JOIN spread b ON a.gram = b.gram AND a.doc_id <> b.doc_id
            GROUP BY ALL
        ), links AS (
            SELECT shared.a, shared.b FROM shared
            JOIN sizes x ON x.doc_id = shared.a JOIN sizes y ON y.doc_id = shared.b
            WHERE 100 * n >= 85 * (x.n_shingles + y.n_shingles - n)
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
        )
        SELECT doc_id, n_shingles, min(other) AS component_id
        FROM reached JOIN sizes USING (doc_id) GROUP BY ALL
    """,
    "op11_prefix_trie": r"""
        WITH crc AS (
            SELECT list_transform(range(0, 256), lambda n: list_reduce(range(0, 8),
                lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), n)) AS t
        ), convs AS (
            SELECT conv_id, conv_id - conv_id % 20 AS stock,
                   xor(list_reduce(
                       list_transform(range(1, strlen(conv_id::VARCHAR) + 1),
                                      lambda i: ord(substr(conv_id::VARCHAR, i, 1))::BIGINT),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295
                   ), 4294967295) % 4 AS cut
            FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), crc
        ), turns AS (
            SELECT conv_id, row_number() OVER
                       (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                   struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS item
            FROM conversations WHERE conv_id IS NOT NULL
        ), rebuilt AS (
            SELECT c.conv_id, 0 AS own, t.i, item
            FROM convs c JOIN turns t ON t.conv_id = c.stock AND t.i <= c.cut
            UNION ALL
            SELECT c.conv_id, 1, t.i, item
            FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.cut
        ), paths AS (
            SELECT conv_id, list(item ORDER BY own, i) FILTER (item IS NOT NULL) AS items
            FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
        ), spread AS (
            SELECT conv_id, unnest(range(0, coalesce(len(items), 0) + 1)) AS depth,
                   coalesce(items, []) AS items
            FROM paths
        ), members AS (
            SELECT conv_id, depth, items[:depth] AS prefix, len(items) = depth AS ends FROM spread
        ), nodes AS (
            SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                                   FILTER (ends), '')) AS ends_sha256,
                   (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(list_filter(
                       string_split_regex(prefix[depth].text, '[\x20\x09-\x0D]+'),
                       lambda word: word <> '')) END AS saved
            FROM members GROUP BY prefix, depth
        ), children AS (
            SELECT prefix[:depth - 1] AS prefix, count(*) AS n_children
            FROM nodes WHERE depth > 0 GROUP BY ALL
        ), counted AS (
            SELECT nodes.*, coalesce(n_children, 0) AS n_children
            FROM nodes LEFT JOIN children USING (prefix)
        ), below AS (
            SELECT prefix[:d] AS prefix, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves,
                   sum(saved)::BIGINT AS saved_tokens
            FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY ALL
        )
        SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
               n_leaves, saved_tokens, c.ends_sha256
        FROM counted c JOIN below USING (prefix)
        LEFT JOIN nodes p ON c.depth > 0 AND p.prefix = c.prefix[:c.depth - 1]
    """,
    "op12_exact_copies": r"""
        WITH texts AS (
            SELECT doc_id, length(coalesce(text, '')) AS size,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
               count(*) OVER (PARTITION BY content) AS group_size,
               row_number() OVER best = 1 AS kept, sha256(content) AS text_sha256
        FROM texts
        WINDOW best AS (PARTITION BY content ORDER BY size DESC, doc_id NULLS LAST)
    """,
    "op13_spelling": r"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(0, 256), lambda n: list_reduce(range(0, 8),
                lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), n)) AS t
        ), runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run
                  FROM documents)
            GROUP BY ALL HAVING length(run) >= 6
        ), summed AS (
            SELECT run, n, xor(list_reduce(
                flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
                    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT]
                                   ELSE [195::BIGINT, ord(c)::BIGINT - 64] END)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT
            ), 4294967295) AS h
            FROM runs, crc
        ), spelled AS (
            SELECT CASE WHEN h % 199 = 0
                        THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                        ELSE run END AS word, n
            FROM summed
        ), words AS (
            SELECT word, total AS n
            FROM (SELECT word, sum(n)::BIGINT AS total FROM spelled GROUP BY word)
            WHERE length(word) >= 6 AND total >= 5
        ), shorter AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), near AS (
            SELECT a.word, b.word AS other, b.n AS other_n
            FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
            UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word
        ), best AS (
            SELECT word, count(*) AS n_near,
                   first(struct_pack(form := other, n := other_n) ORDER BY other_n DESC, other) AS b
            FROM near GROUP BY word
        ), formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN b.n >= 5 * w.n THEN b.form END AS form,
                   CASE WHEN b.n >= 5 * w.n THEN b.n END AS form_n
            FROM words w LEFT JOIN best USING (word)
        ), followed AS (
            SELECT word, word AS root FROM formed
            UNION ALL
            SELECT followed.word, formed.form
            FROM followed JOIN formed ON formed.word = followed.root
            WHERE formed.form IS NOT NULL
        ), ends AS (
            SELECT followed.word, followed.root
            FROM followed JOIN formed ON formed.word = followed.root WHERE formed.form IS NULL
        )
        SELECT word, n, n_near, form, form_n, root FROM formed JOIN ends USING (word)
    """,
}
