"""The registered queries of this package and the SQL of those SQL can state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidewater.llm.bpe import encode
from tidewater.llm.collocations import collocations
from tidewater.llm.common import fold, shared_folder, table
from tidewater.llm.decontaminate import overlaps
from tidewater.llm.exact_dedup import exact_groups
from tidewater.llm.kd_shards import kd_shards
from tidewater.llm.language import identify, train_language_model
from tidewater.llm.licenses import scan_licenses
from tidewater.llm.passages import drop_repeated_passages
from tidewater.llm.quality import quality, train_quality_model
from tidewater.llm.runs import longest_run, periodic_runs, planted_order, run_digest
from tidewater.llm.simhash import simhash_groups
from tidewater.llm.token_records import read_records, write_records
from tidewater.llm.toxicity import toxicity, train_toxicity_model

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
SHARDS = 24


def op1_decontaminate(spark, sf_dir):
    """One row per contaminated document: its items and the longest overlap."""
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"),
                                       F.max("n_equal").alias("n_equal"), F.min("first_word").alias("first_word"))


def op2_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents")).drop("frequent")


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = toxicity(docs, train_toxicity_model(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                       (F.col("score") >= 0.7).cast("int").alias("predicted"), "lang_threshold",
                       (F.col("score") >= F.col("lang_threshold")).alias("flagged"))


def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train_language_model(docs)).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op5_token_records(spark, sf_dir):
    folder = shared_folder(spark, "token-records")
    files = write_records(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_TOKENIZER))
    return read_records(files, folder)


def op6_simhash(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_licenses(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op8_bpe(spark, sf_dir):
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)


def op9_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = quality(docs, train_quality_model(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_kd_shards(spark, sf_dir):
    placed = kd_shards(table(spark, sf_dir, "documents"), numeric=["n_chars"], categories=["source", "lang"],
                       shards=SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op11_runs(spark, sf_dir):
    rows = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted_order)
    return (rows.withColumn("best", longest_run(F.col("runs")))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.*",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    run_digest(F.col("runs")).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


def op13_passages(spark, sf_dir):
    return drop_repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def pipeline(spark, sf_dir):
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_language": op4_language,
    "op5_token_records": op5_token_records,
    "op6_simhash": op6_simhash,
    "op7_licenses": op7_licenses,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_kd_shards": op10_kd_shards,
    "op11_runs": op11_runs,
    "op12_collocations": op12_collocations,
    "op13_passages": op13_passages,
    "pipeline": pipeline,
}

ORACLES = {
    "op2_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, digest AS text_sha256
        FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS digest
              FROM documents)
        WINDOW g AS (PARTITION BY digest)""",
    # crc32 as a fold over the digits; pairs of equal words of a document, then gaps and islands per lag
    "op11_runs": r"""
        WITH base AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w0,
                   xor(list_reduce(list_prepend(4294967295::UBIGINT,
                       list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
                       lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
                           lambda c, i: xor(c >> 1, 3988292384::UBIGINT * (c & 1)))), 4294967295::UBIGINT)::BIGINT AS h
            FROM documents),
        plan AS (SELECT *, len(w0)::BIGINT AS n, h % 10 = 0 AND len(w0) > 0 AS planted,
                        (h // 10) % greatest(len(w0), 1) AS a FROM base),
        docs AS (
            SELECT doc_id, n, CASE WHEN planted THEN list_transform(range(n), lambda i: w0[1 + CASE WHEN i < a THEN i
                       ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) ELSE w0 END AS w FROM plan),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM docs),
        pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
                  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i),
        islands AS (SELECT doc_id, q, min(i) AS s, count(*) AS m FROM
                    (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM pairs)
                    GROUP BY doc_id, q, g),
        runs AS (SELECT doc_id, s AS start, m + q AS length, min(q) AS period FROM islands
                 WHERE m >= greatest(12 - q, q) GROUP BY doc_id, s, m + q),
        best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
        listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), ''
                          ORDER BY start, period) AS lines FROM runs GROUP BY doc_id),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words x WHERE NOT EXISTS
                 (SELECT 1 FROM runs r WHERE r.doc_id = x.doc_id AND x.i >= r.start + r.period AND x.i < r.start + r.length)
                 GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
               sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
        FROM docs d LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (
            SELECT lang, unnest(flatten(list_transform([1, 2, 3], lambda k: list_transform(
                       range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) AS phrase FROM lists),
        counts AS (SELECT lang, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, phrase),
        totals AS (SELECT lang, sum(len(w)) AS n FROM lists GROUP BY lang),
        candidates AS (SELECT lang, phrase, f AS a, w FROM counts WHERE len(w) > 1 AND f >= 10),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r,
                   (c.a::HUGEINT * c.a * 1000000) // (x.f::HUGEINT * y.f) AS score
            FROM (SELECT *, unnest(range(1, len(w))) AS k FROM candidates) c
            JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
            JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_ones AS (SELECT DISTINCT c.lang, s.phrase FROM candidates c, unnest([array_to_string(c.w[1:2], ' '),
                              array_to_string(c.w[2:3], ' ')]) AS s(phrase)
                       JOIN counts f ON f.lang = c.lang AND f.phrase = s.phrase
                       WHERE len(c.w) = 3 AND 100 * c.a >= 50 * f.f)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
               n::BIGINT AS n, score::BIGINT AS score
        FROM best JOIN totals USING (lang)
        WHERE NOT EXISTS (SELECT 1 FROM inner_ones o WHERE o.lang = best.lang AND o.phrase = best.phrase)
        QUALIFY rank <= 2000""",
    "op13_passages": r"""
        WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (SELECT doc_id, s, array_to_string(w[s + 1:s + 20], ' ') AS t
                    FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS s FROM docs)),
        later AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, s) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
                 FROM words x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (doc_id)""",
}
