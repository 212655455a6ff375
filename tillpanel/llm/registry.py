"""Queries of the training-data operators over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.llm import (chat, decontaminate, licences, mixing, near_dups, neighbours, phrases, quality, sharding,
                           token_counts, token_files, vector_codes, warc)
from tillpanel.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
FILE_TOKENIZER, END_ID = "word_bpe_49k.json", 2


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "keep")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.licences(licences.documents_as_files(table(spark, sf_dir, "documents")))
    return found.withColumnRenamed("file_id", "doc_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents")).select("doc_id", "source", "copies", "block", "slot", "position")


PROBE = "\\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    return chat.digests(chat.formatted(chat.turns_as_events(turns.union(probe))))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), 40)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(FILE_TOKENIZER), END_ID)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_counts, op2_warc, op3_neighbours, op4_quality, op5_near_dups, op6_decontaminate, op7_licences,
    op8_mixing, op9_chat, op10_sharding, op11_vector_codes, op12_token_files, op13_phrases)}


def _nearest(books: str) -> str:
    """Twice used: nearest entry ``e`` and squared distance ``d`` of every part, ties to the lower index."""
    return f"""
        SELECT vec_id, label, p, any_value(x) AS x, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d
        FROM (SELECT parts.*, {books}.e, list_sum(list_transform(list_zip(parts.x, {books}.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
              FROM parts JOIN {books} USING (p))
        GROUP BY vec_id, label, p"""


def _moved(books: str, assigned: str) -> str:
    """Entries of ``books`` moved to the floored means of their parts."""
    return f"""
        SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM {books} b LEFT JOIN (
            SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x
            FROM (SELECT p, e, j, sum(x[j])::BIGINT AS s, count(*) AS n FROM {assigned}, range(1, 1 + len(x)) AS t(j) GROUP BY p, e, j)
            GROUP BY p, e) m ON b.p = m.p AND b.e = m.e"""

ORACLES = {
    "op2_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        q AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d) END AS holder FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
               CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN holder <> page_id THEN holder END AS refers_to
        FROM q""",
    "op9_chat": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
                   UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
               sum(14 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g'))
                      + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')))::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op11_vector_codes": f"""
        WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS (SELECT vec_id, label, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS x FROM kept, range(16) AS t(p)),
        books0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts
                   WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
        first AS ({_nearest("books0")}), books1 AS ({_moved("books0", "first")}),
        second AS ({_nearest("books1")}), books2 AS ({_moved("books1", "second")}),
        last AS ({_nearest("books2")}),
        coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM last GROUP BY vec_id, label),
        digest AS (SELECT sha256(string_agg(x[j]::VARCHAR, ',' ORDER BY p, e, j)) AS codebooks_sha256 FROM books2, range(1, 1 + len(x)) AS t(j))
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, digest""",
    "op13_phrases": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
               FROM documents WHERE text IS NOT NULL),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (SELECT lang, w[i:i + m - 1] AS w FROM split, range(1, 5) AS s(m), range(1, len(w) - m + 2) AS t(i)),
        f AS (SELECT lang, w, count(*) AS f FROM grams GROUP BY lang, w),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(w) = 1 GROUP BY lang),
        c AS (SELECT lang, w, f AS a FROM f WHERE len(w) > 1 AND f >= 30),
        cuts AS (SELECT c.lang, c.w, a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f::HUGEINT + y.f) AS score
                 FROM c, range(1, len(c.w)) AS t(k) JOIN f x ON x.lang = c.lang AND x.w = c.w[1:k] JOIN f y ON y.lang = c.lang AND y.w = c.w[k + 1:len(c.w)]),
        low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
        inner_parts AS (SELECT lang, w[i:i + m - 1] AS w, max(a) AS longer FROM c, range(2, 4) AS s(m), range(1, len(w) - m + 2) AS t(i)
                        WHERE m < len(w) GROUP BY ALL),
        kept AS (SELECT low.* FROM low LEFT JOIN inner_parts p ON p.lang = low.lang AND p.w = low.w WHERE longer IS NULL OR 100 * longer < 80 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ') COLLATE "binary") AS rank,
               array_to_string(w, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
        FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
}
