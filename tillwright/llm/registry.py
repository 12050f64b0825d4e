"""Registered queries of this folder and the SQL twins of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import alignment, ann, bpe, chat, linededup, minhash, mixing, pst, quality, simhash, sketch, spelling, toxicity
from tillwright.llm.common import remainder, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return pst.score(table(spark, folder, "documents"), remainder("doc_id", 10) == 0)


def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], rows.schema)
    return chat.digests(chat.format_turns(rows.union(extra)))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(bpe.encode(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN, decoded=True), "doc_id")


def bpe_digests(decoded: DataFrame, *keep: str) -> DataFrame:
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(*keep, F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    pairs = sketch.edited_pairs(table(spark, folder, "documents"))
    return pairs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), sketch.fingerprint("sketch").alias("fingerprint"),
        sketch.fingerprint("edited_sketch").alias("edited_fingerprint"), sketch.containment("sketch", "edited_sketch").alias("near_edited"),
        sketch.containment("sketch", "next_sketch").alias("near_next"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = toxicity.Model(docs, table(spark, folder, "labels"), keep=~held_out)
    return model.score(docs).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = linededup.cleaned(docs, linededup.keep_bitmaps(docs, least_chars=40, least_docs=5))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, mixing.rates(docs))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = remainder("doc_id", 4) == 2
    model = quality.train(docs, table(spark, folder, "labels"), keep=~held_out)
    rated = quality.score(docs.select("doc_id", "text"), model)
    return rated.select("doc_id", held_out.alias("held_out"), F.col("rating.expected").alias("expected_grade"),
                        F.col("rating.tail").alias("tail_probability"), (F.col("rating.tail") >= 0.5).alias("selected"))


def op11_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_chat_formatting, op3_simhash, op4_byte_bpe, op5_nearest_neighbours, op6_document_fingerprints,
    op7_toxicity, op8_line_dedup, op9_source_mixing, op10_quality, op11_minhash, op12_tokenizer_alignment, op13_spelling_variants)}

ORACLES = {
    "op11_minhash": """
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                                ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
            FROM worded),
        flat AS (SELECT doc_id, hash(unnest(s)) AS h FROM sets),
        sizes AS (SELECT doc_id, len(s) AS n FROM sets),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met FROM flat a JOIN flat b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
        near AS (
            SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * met >= 85 * (p.n + q.n - met)),
        edges AS (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
        reached AS (
            SELECT doc_id, doc_id AS r FROM sets
            UNION
            SELECT reached.doc_id, edges.y FROM reached JOIN edges ON reached.r = edges.x)
        SELECT doc_id, n AS n_shingles, min(r) AS component_id, min(r) = doc_id AS kept
        FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id, n""",
    "op5_nearest_neighbours": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e, row_number() OVER () AS r FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score,
                   row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
            FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
        WHERE rank <= 20""",
    "op8_line_dedup": """
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
        repeated AS (
            SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM (SELECT y.*, r.k IS NOT NULL AND y.doc_id <> r.keeper AS gone FROM keyed y LEFT JOIN repeated r ON y.k = r.k)
        GROUP BY doc_id""",
    "op9_source_mixing": """
        WITH held AS (
            SELECT source, sum(length(coalesce(text, '')) + 1) AS held FROM documents GROUP BY source),
        rated AS (
            SELECT source, pow(held, 0.5) / (SELECT sum(pow(held, 0.5)) FROM held) * (SELECT sum(held) FROM held) / held AS rate FROM held),
        parted AS (
            SELECT source, greatest(ceil(rate / 32), 1)::INT AS parts, rate / greatest(ceil(rate / 32), 1) AS mean FROM rated),
        masses AS (
            SELECT source, parts, list_transform(range(0, 128), lambda k: exp(-mean + k * ln(mean) - lgamma(k + 1))) AS mass FROM parted),
        tables AS (
            SELECT source, parts, list_transform(range(1, 129), lambda i: list_sum(mass[1:i])) AS cdf FROM masses),
        numbers AS (
            SELECT d.doc_id, d.source, d.text, t.cdf, unnest(range(1, t.parts + 1)) AS j FROM documents d JOIN tables t USING (source)),
        counts AS (
            SELECT doc_id, source, text, sum(len(list_filter(cdf, lambda c: c < ('0x' || md5('42:' || doc_id || ':' || j)[1:13])::BIGINT / 4503599627370496.0))) AS n
            FROM numbers GROUP BY ALL)
        SELECT doc_id, source, text, copy::INT AS copy,
               ('0x' || md5('42:order:' || doc_id || ':' || copy)[1:13])::BIGINT / 4503599627370496.0 AS mix_key
        FROM (SELECT doc_id, source, text, unnest(range(1, n::BIGINT + 1)) AS copy FROM counts)""",
}
