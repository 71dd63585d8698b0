"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railstream.llm import (
    bpe,
    chat,
    checks,
    merkle,
    ngram_join,
    packing,
    periods,
    permutation_index,
    piece_table,
    quality,
    secrets,
    sharding,
    token_counts,
    toxicity,
)
from railstream.llm.store import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _register(name: str):
    def keep(function):
        QUERIES[name] = function
        return function
    return keep


@_register("op1_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.grouped_documents(table(spark, sf_dir, "documents"))


CHECKS["op1_ngram_jaccard"] = checks.jaccard_sql()


@_register("op2_distinct_word_bpe")
def distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), with_text=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


@_register("op3_perspective_rotation")
def perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


CHECKS["op3_perspective_rotation"] = chat.PERSPECTIVES_SQL


def _joined(spans: str):
    """kind:start:end of each find, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str, span):
    return span["kind"] == kind


@_register("op4_recursive_secrets")
def recursive_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.finds(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("base", partial(_of_kind, kind))).cast("long").alias(f"n_{kind}")
              for kind in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("every").alias("spans"), "unread")


@_register("op5_permutation_index")
def permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@_register("op6_compression_toxicity")
def compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model).select("row.doc_id", "score")
            .select("doc_id", toxicity.in_fold("doc_id").alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


@_register("op7_adaptive_quality")
def adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@_register("op8_viterbi_counts")
def viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), whole=True)


@_register("op9_harmonic_packing")
def harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@_register("op10_virtual_slots")
def virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                       "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def _planted(doc_id, text):
    """Every tenth text, by the checksum of its id, with a periodic end."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        left = n - a
        p = (F.floor(left / (3 + g % 8)) + 1).cast("int")
        unit = F.slice(words, a + 1, p)
        copies = F.flatten(F.array_repeat(unit, F.ceil(left / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(copies, F.lit(1), left)), " ")

    words = F.filter(F.split(text, periods.SPACES), lambda w: w != "")
    # As the value of a lambda the words are split once.
    return F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(text)


@_register("op11_tiled_periods")
def tiled_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periods.runs(docs.select("doc_id", _planted(F.col("doc_id"), F.col("text")).alias("text")))
    best = periods.longest("runs")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
        F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), "collapsed_sha256")


CHECKS["op11_tiled_periods"] = checks.periods_sql()


@_register("op12_distinct_chunk_pieces")
def distinct_chunk_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = piece_table.encode(table(spark, sf_dir, "documents"), with_text=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


@_register("op13_veb_manifest")
def veb_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # What a check finds: every other row has lost its newlines.
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.checked(merkle.manifest(table(spark, sf_dir, "documents"), found)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


CHECKS["op13_veb_manifest"] = checks.manifest_sql()
