"""The corpus operators as queries on the test tables, with SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelflow.llm import (
    bpe, cross_polytope, filter_audit, line_dedup, packing, pii, quality, resampling, rp_forest, secret_scan, simhash, token_files,
    toxicity,
)
from parcelflow.sources.layers import scratch_folder

BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"


LINE_DEDUP = """
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
        FROM documents),
    keyed AS (
        SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines),
    shared AS (
        SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
    SELECT doc_id, count(*) AS n_lines, count(keeper) FILTER (keeper <> doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
    FROM keyed LEFT JOIN shared USING (key)
    GROUP BY doc_id"""


CROSS_POLYTOPE = """
    WITH RECURSIVE vectors AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
               coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                        AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS able
        FROM embeddings),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE a.able AND b.able AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
    reached AS (
        SELECT vec_id AS node, vec_id AS other FROM vectors
        UNION SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a),
    components AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
    SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
    FROM vectors JOIN components ON vec_id = node"""


# Whole tables in one statement: each document's failures, then each order as rows of its steps.
FILTER_AUDIT = """
    WITH texts AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents),
    firsts AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
    marks AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
    flags AS (
        SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
               CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
               || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
               || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
               || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
               || CASE WHEN t.doc_id > first_id THEN 'E' ELSE '' END AS f
        FROM texts t JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
    masks AS (
        SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM flags GROUP BY part, f),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
    orders AS (
        SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
    gone AS (
        SELECT part, filter_order, n, good, toxic, f,
               [substr(filter_order, i, 1) FOR i IN range(1, 6) IF contains(f, substr(filter_order, i, 1))] AS failing
        FROM masks, orders),
    steps AS (SELECT unnest(range(1, 6)) AS step),
    counted AS (
        SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
               sum(n) - coalesce(sum(n) FILTER (len(failing) > 0 AND strpos(filter_order, failing[1]) <= step), 0) AS kept,
               coalesce(sum(n) FILTER (failing[1] = substr(filter_order, step, 1)), 0) AS removed,
               coalesce(sum(n) FILTER (list_contains(failing, substr(filter_order, step, 1)) AND failing[1] <> substr(filter_order, step, 1)), 0) AS redundant,
               coalesce(sum(n) FILTER (failing = [substr(filter_order, step, 1)]), 0) AS unique_fails,
               coalesce(sum(good) FILTER (failing[1] = substr(filter_order, step, 1)), 0) AS good_lost,
               coalesce(sum(toxic) FILTER (failing[1] = substr(filter_order, step, 1)), 0) AS toxic_lost
        FROM gone, steps GROUP BY part, filter_order, step)
    SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
           CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
    FROM counted"""


# crc32 of distinct words byte by byte, by the usual table of 256 remainders.
RESAMPLING = """
    WITH crc AS (
        SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS remainders),
    docs AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
        FROM documents),
    doc_words AS (SELECT r, doc_id, unnest(words) AS word FROM docs),
    target_words AS (
        SELECT unnest(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
        FROM benchmark),
    words AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_words UNION SELECT word FROM target_words)),
    hashed AS (
        SELECT word, xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
            lambda c, b: xor(c >> 8, remainders[xor(c & 255, b) + 1]))) % 10000 AS bucket
        FROM words, crc),
    s AS (SELECT bucket, count(*) AS s FROM doc_words JOIN hashed USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM target_words JOIN hashed USING (word) GROUP BY bucket),
    gains AS (
        SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
            / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
        FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
    weighed AS (
        SELECT d.r, count(w.word) AS n_features, coalesce(sum(gain), 0) AS weight, any_value(d.doc_id) AS doc_id
        FROM docs d
        LEFT JOIN doc_words w ON w.r = d.r LEFT JOIN hashed USING (word) LEFT JOIN gains USING (bucket) GROUP BY d.r),
    scored AS (
        SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight,
               CAST(weight + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                   / 4294967296::DOUBLE))) AS BIGINT) AS score
        FROM weighed),
    ranked AS (
        SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
            PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place
        FROM scored)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN place <= 10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 THEN place END AS rank
    FROM ranked"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, n: int) -> Column:
    """Remainder by which rows are held out of training."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(-1))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed("base").cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed("spans").alias("spans"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that three or more documents share."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate vectors with equal labels."""
    return cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learnt from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    network = quality.train(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return quality.score(docs, network, keep=["doc_id"]).select("row.doc_id", "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 1,024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, model, keep=["doc_id"]).select("row.doc_id", "score", "evidence").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.transform("evidence", lambda e: e["doc_id"]).alias("evidence"),
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as token ids and read back."""
    folder = scratch_folder(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY), folder)
    return token_files.checksums(spark, folder)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-duplicates of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes under all their orders, for each language."""
    flagged = filter_audit.flag_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), part="lang")
    return filter_audit.audit_orders(flagged, "ABCDE", "part", ["good", "toxic"])


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document."""
    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.train(docs), keep=["doc_id"]).select("row.doc_id", "base", "spans")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.KINDS],
        F.sha2(pii.listed("base").cast("binary"), 256).alias("base_sha256"),
        pii.listed("spans").alias("spans"),
    )


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by how much their words resemble the benchmark's."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, least_words=20)


def queries() -> dict:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_line_dedup": op2_line_dedup,
        "op3_bpe": op3_bpe,
        "op4_rp_forest": op4_rp_forest,
        "op5_cross_polytope": op5_cross_polytope,
        "op6_quality": op6_quality,
        "op7_packing": op7_packing,
        "op8_toxicity": op8_toxicity,
        "op9_token_files": op9_token_files,
        "op10_simhash": op10_simhash,
        "op11_filter_audit": op11_filter_audit,
        "op12_pii": op12_pii,
        "op13_resampling": op13_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": LINE_DEDUP, "op5_cross_polytope": CROSS_POLYTOPE, "op11_filter_audit": FILTER_AUDIT, "op13_resampling": RESAMPLING}
