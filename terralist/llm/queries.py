"""The registered queries: thin forms of the operators over the given tables."""

import public_tokenizers
from pyspark.sql import functions as F

from terralist.llm import (
    byte_bpe as op2, conversation_repair as op11, jaccard as op1, langid as op7, maxscore as op8, mixing as op4, periodic_runs as op12, piece_agenda as op13, piece_count as op10, quality as op9, recurrent_lm as op6, suffix_dedup as op5, warc as op3,
)
from terralist.llm.words import word_count

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark, folder, name, *columns):
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


@query("op9_quality_rules", op9.quality_sql())
def quality_rules(spark, folder):
    judged = op9.quality(table(spark, folder, "documents", "doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    )


@query("op2_byte_bpe")
def byte_bpe(spark, folder):
    ranks = op2.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, folder, "documents", "doc_id", "text")
    decoded = op2.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_piece_counts")
def piece_counts(spark, folder):
    model = op10.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, folder, "documents", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = op10.count_tokens(docs.withColumn("n_bytes", F.octet_length("text").cast("long")), model)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@query("op8_maxscore", op8.top_k_sql())
def maxscore(spark, folder):
    vectors = op8.whole_vectors(table(spark, folder, "embeddings", "vec_id", "embedding"))
    return op8.top_k(vectors, F.col("id") % 20 == 0, k=20).select("query_id", "rank", "vec_id", "score")


@query("op4_mixing", op4.mix_sql())
def mixing(spark, folder):
    sized = table(spark, folder, "documents", "doc_id", "source", word_count(F.col("text")).alias("size"))
    return op4.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_warc", op3.archive_sql())
def warc(spark, folder):
    manifest = op3.write_archives(table(spark, folder, "pages", "page_id", "url", "html"))
    records = op3.read_archives(manifest, payload=False).filter("kind = 'record'")
    return records.select(
        F.expr("try_cast(record_id AS bigint)").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.expr("try_cast(refers_to AS bigint)").alias("refers_to"),
    )


@query("op7_language_id")
def language_id(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text", "lang").withColumn("held_out", op7.fold("doc_id", 3) == 1)
    models = op7.fit(docs.filter(~F.col("held_out")))
    return op7.identify(docs, models).select("doc_id", "held_out", "lang_pred", "score")


@query("op1_ngram_jaccard", op1.near_duplicates_sql())
def ngram_jaccard(spark, folder):
    return op1.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))


@query("op5_suffix_dedup")
def suffix_dedup(spark, folder):
    done = op5.remove_repeats(table(spark, folder, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return done.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op6_recurrent_lm")
def recurrent_lm(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text").withColumn("held_out", op7.fold("doc_id", 10) == 0)
    return op6.score_documents(docs, ~F.col("held_out")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


@query("op13_piece_agenda")
def piece_agenda(spark, folder):
    model = op10.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    coded = op13.round_trip(table(spark, folder, "documents", "doc_id", "text"), model, check="library_agrees")
    return coded.select(
        "doc_id", "n_tokens", F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"), "library_agrees",
    )


@query("op12_periodic_runs")
def periodic_runs(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", op12.repeat_words(F.col("text"), F.col("doc_id")).alias("text"))
    found = op12.periodic_runs(docs).withColumn("best", op12.longest_run(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(op12.run_lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op11_conversation_repair", op11.repair_sql())
def conversation_repair(spark, folder):
    given = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    ordered = op11.ordered_rows(op11.damage(given))
    edited = op11.edits(op11.row_blocks(ordered))
    ids = given.select(F.col("conv_id").alias("conv")).distinct()
    return op11.summary(ids, ordered, edited).select(
        F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    )
