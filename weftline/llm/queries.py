"""Registered queries of the corpus operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bitslice, chat, langid, minhash, mixing, nndescent, pieces, prefixtrie, quality, secrets, spelling, superkmer, toxicity
from weftline.llm.common import fold
from weftline.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_mixing_sources")
def op1_mixing_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "text")))


@query("op2_exact_top_k", """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5""")
def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return bitslice.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


# Documents of this fold teach nothing.
HELD_OUT = 2


def is_held_out(docs: DataFrame):
    return fold(docs["doc_id"]) == HELD_OUT


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    model = quality.fit(docs, labels.where(~is_held_out(labels)))
    return quality.score(docs.withColumn("held_out", is_held_out(docs)), model).select(
        "doc_id", "held_out", "score", "predicted")


@query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    dictionaries = langid.learn_dictionaries(docs.where(~is_held_out(docs)))
    return langid.identify(docs.select("doc_id", "text", is_held_out(docs).alias("held_out")), dictionaries).select(
        "doc_id", "held_out", "lang_pred", "score", "narrow")


@query("op5_minhash_dedup")
def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), words=3, percent=85)


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.token_digests(pieces.encode_decode(table(spark, folder, "documents").select("doc_id", "text"), TOKENIZER))


@query("op7_secret_scans")
def op7_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.span_digests(secrets.scan(table(spark, folder, "documents").select("doc_id", "source", "text")))


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = superkmer.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# Stated with the contract: its control strings stand in the texts.
EXTRA_CHAT = r"""
SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(t AS BIGINT) AS turn, r AS role, '\\### Assistant: </turn> ok' AS text
FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)"""


@query("op9_chat_formatting", r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, regexp_matches(text, '</turn>\n') OR regexp_matches(text, '\\</turn>') OR ends_with(text, '</turn>') AS clash,
         regexp_replace(text, '(\\*</turn>)', '\\\1', 'g') AS escaped FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
       CAST(sum(14 + length(role) + length(CASE WHEN clash THEN escaped ELSE text END)) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id""")
def op9_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(chat.format_chats(turns.unionByName(spark.sql(EXTRA_CHAT))))


@query("op10_embedding_dedup")
def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return nndescent.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))


@query("op12_spelling_variants", """
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), r AS (SELECT doc_id, run, count(*) AS k FROM d WHERE length(run) >= 5 GROUP BY doc_id, run
), tab AS (SELECT list(c ORDER BY i) AS tab FROM (
  SELECT i, list_reduce(list_concat([i], range(8)), lambda x, j: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS c
  FROM range(256) AS g(i))
), b AS (SELECT doc_id, run, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx FROM r
), c AS (SELECT run, k, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], [CAST((16 * (strpos('0123456789ABCDEF', hx[2 * i - 1]) - 1) + strpos('0123456789ABCDEF', hx[2 * i]) - 1) AS BIGINT)
      FOR i IN range(1, length(hx) // 2 + 1)]),
    lambda crc, x: xor(crc // 256, tab[1 + xor(crc % 256, x)]))) AS h FROM b, tab
), s AS (SELECT CASE WHEN h % 97 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, k FROM c
), w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM s WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), p AS (SELECT a.word, a.n, b.word AS b, b.n AS b_n FROM w a JOIN w b
  ON length(b.word) BETWEEN length(a.word) - 1 AND length(a.word) + 1 AND a.word <> b.word
  AND (substr(a.word, 1, length(a.word) // 2) = substr(b.word, 1, length(a.word) // 2)
       OR right(a.word, length(a.word) - length(a.word) // 2 - 1) = right(b.word, length(a.word) - length(a.word) // 2 - 1))
  WHERE len([1 FOR i IN range(greatest(length(a.word), length(b.word))) IF substr(a.word, 1, i) = substr(b.word, 1, i)
    AND substr(a.word, i + 1 + (length(a.word) >= length(b.word))::INT) = substr(b.word, i + 1 + (length(b.word) >= length(a.word))::INT)]) > 0
), f AS (SELECT w.word, w.n, coalesce(x.n_near, 0) AS n_near, CASE WHEN x.b_n >= 2 * w.n THEN x.b END AS form, CASE WHEN x.b_n >= 2 * w.n THEN x.b_n END AS form_n
  FROM w LEFT JOIN (SELECT word, count(*) AS n_near, max(b_n) AS b_n, (list(b ORDER BY b_n DESC, b))[1] AS b FROM p GROUP BY word) x USING (word)
)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM f JOIN (
  WITH RECURSIVE walk AS (SELECT word, coalesce(form, word) AS here, form IS NULL AS done FROM f
    UNION ALL SELECT walk.word, coalesce(f.form, f.word), f.form IS NULL FROM walk JOIN f ON f.word = walk.here WHERE NOT done)
  SELECT word, here AS root FROM walk WHERE done) USING (word)""")
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, folder, "documents").select("doc_id", "text")))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where(~is_held_out(labels)))
    return toxicity.score(docs.withColumn("held_out", is_held_out(docs)), model).select(
        "doc_id", "held_out", "score", "predicted", "offending")


@query("op11_prefix_trie", """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), h AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 6 AS lead
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT h.conv_id, t.place, role, text FROM h JOIN t ON t.conv_id = h.base AND t.place <= h.lead
  UNION ALL SELECT h.conv_id, t.place, role, text FROM h JOIN t ON t.conv_id = h.conv_id AND t.place > h.lead
), c AS (
  SELECT h.conv_id, coalesce(s, []) AS s FROM h LEFT JOIN (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS s FROM r GROUP BY conv_id) USING (conv_id)
), m AS (SELECT conv_id, d, s[1:d] AS p, len(s) = d AS ends FROM c, LATERAL unnest(range(len(s) + 1)) AS u(d)
), n AS (
  SELECT p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256,
         CASE WHEN d > 0 THEN (count(*) - 1) * length(p[d]['text']) ELSE 0 END AS saved
  FROM m GROUP BY p, d
), k AS (
  SELECT n.*, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.p[1:n.depth] = n.p) AS n_children FROM n
)
SELECT a.conv_id, a.depth, (SELECT conv_id FROM n x WHERE x.depth = a.depth - 1 AND x.p = a.p[1:x.depth]) AS parent_conv_id,
       a.n_convs, a.n_children, CAST(sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
       CAST(sum(b.saved) AS BIGINT) AS saved_tokens, a.ends_sha256
FROM k a JOIN k b ON b.depth >= a.depth AND b.p[1:a.depth] = a.p
GROUP BY a.p, a.conv_id, a.depth, a.n_convs, a.n_children, a.ends_sha256""")
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefixtrie.numbered(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    # Conversation c begins with turns of the first conversation of its hundred, as many as its CRC-32 says.
    lead, base = F.crc32(F.col("conv_id").cast("string")) % 6, F.col("conv_id") - F.col("conv_id") % 100
    return prefixtrie.trie(prefixtrie.rebuilt(turns, lead, base, 5))
