"""The registered queries of this subpackage: each runs its operator over a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymart.llm import (
    bpe,
    chat,
    exact_dedup,
    kneser_ney,
    language_id,
    line_dedup,
    mixing,
    nearest,
    periodic,
    personal_data,
    shingle_join,
    spelling,
    token_counts,
)
from skymart.llm.arrow import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.remainder(F.col("doc_id"), 10) == 0
    scored = kneser_ney.score(docs, kneser_ney.train(docs, ~held_out))
    figures = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return scored.select("doc_id", held_out.alias("held_out"), *figures)


def op4_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), WORD_BPE)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs, ~held_out)
    predicted = language_id.predict(docs, model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_data.digests(personal_data.find(docs, personal_data.fit(docs)))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.runs(table(spark, sf_dir, "documents"))
    return spelling.variants(spelling.vocabulary(found))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(table(spark, sf_dir, "documents"))


#: A conversation whose texts consist of control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [(-1, turn, role, CONTROL_TEXT) for turn, role in enumerate(("user", "assistant"))]
    added = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    links, bodies = chat.messages(given.union(added))
    conversations = chat.formatted(chat.best_branches(links), bodies)
    return chat.digests(conversations).withColumnRenamed("tree", "conv_id")


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_mixing,
            op2_exact_dedup,
            op3_kneser_ney,
            op4_shingle_join,
            op5_line_dedup,
            op6_bpe,
            op7_language_id,
            op8_token_counts,
            op9_personal_data,
            op10_nearest,
            op11_spelling,
            op12_periodic_runs,
            op13_chat,
        )
    }


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_EXACT_DEDUP = f"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM (
    SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id,
        count(*) OVER (PARTITION BY body) AS group_size
    FROM (
        SELECT doc_id,
            translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}') AS body
        FROM documents
    )
)
"""


#: crc32 of a text of code points up to U+00FF, from its table of 256 entries.
_SPELLING = f"""
WITH RECURSIVE bits AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS entries
), found AS (
    SELECT doc_id, translate(run, '{_CAPITALS}', '{_CAPITALS.lower()}') AS run
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 7
), points AS (
    SELECT run, doc_id, list_transform(range(1, length(named) + 1), lambda i: unicode(substr(named, i, 1))::BIGINT) AS codes
    FROM (SELECT *, doc_id || ':' || run AS named FROM found)
), sums AS (
    SELECT run, xor(4294967295, list_reduce(
        list_prepend(4294967295, flatten(list_transform(codes,
            lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END))),
        lambda c, b: xor(c >> 8, entries[1 + (xor(c, b) & 255)]))) AS h
    FROM points, bits
), words AS (
    SELECT word, count(*) AS n
    FROM (
        SELECT CASE WHEN h % 31 = 0
            THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM sums
    )
    WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), gaps AS (
    SELECT word, n, place, left(word, place - 1) || substr(word, place + 1) AS rest
    FROM (SELECT *, unnest(range(1, length(word) + 1)) AS place FROM words)
), shorter AS (
    SELECT DISTINCT g.word AS long, w.word AS short, g.n AS long_n, w.n AS short_n
    FROM gaps g JOIN words w ON g.rest = w.word
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n
    FROM gaps a JOIN gaps b ON a.place = b.place AND a.rest = b.rest AND a.word <> b.word
    UNION ALL SELECT long, short, short_n FROM shorter
    UNION ALL SELECT short, long, long_n FROM shorter
), best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS form_n,
        first(other ORDER BY other_n DESC, encode(other)) AS form
    FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
        CASE WHEN b.form_n >= 10 * w.n THEN b.form END AS form,
        CASE WHEN b.form_n >= 10 * w.n THEN b.form_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
), chains AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chains c ON f.word = c.word
JOIN formed r ON c.root = r.word AND r.form IS NULL
"""

_ESCAPE = r"regexp_replace({0}, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')"
_CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
    UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(length('{chat.START}') + length({_ESCAPE.format("role")}) + length('{chat.HEAD}')
        + length({_ESCAPE.format("text")}) + length('{chat.END}'))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": _EXACT_DEDUP, "op11_spelling": _SPELLING, "op13_chat": _CHAT}
