"""The registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.session import scratch_path, share_package

from . import merkle, perplexity, url_templates
from .decontaminate import find_items
from .ngram_join import jaccard_components
from .packing import pack_documents
from .projections import near_vectors
from .repeats import remove_repeats
from .runs import greatest_run, periodic_runs, with_periods
from .secrets import scan_secrets
from .token_counts import token_counts
from .token_files import read_token_files, write_token_files
from .word_bpe import decode_words, encode_words


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents")).drop("row_hash")


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > 1024)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = perplexity.fit(docs, _table(spark, sf_dir, "labels"))
    return model.score(docs).select("doc_id", "lang", F.round("perplexity", 6).alias("perplexity"),
                                    F.round("peak_perplexity", 6).alias("peak_perplexity"), F.round("contrast", 6).alias("contrast"), "keep")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.url_verdicts(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"), matches=False)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(told(base).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode_words(encode_words(_table(spark, sf_dir, "documents")))
    told = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(told.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    changed = {f: F.col(f) for f in merkle.FIELDS} | {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf_digest(changed))
    rows = merkle.merkle_manifest(docs, extra={"tampered": tampered}).withColumn("held", F.coalesce("tampered", "leaf"))
    siblings = F.array_join(F.transform("witness", lambda p: p["others"]), "")
    rows = merkle.verify(rows, "held").withColumn("proof_sha256", F.sha2(siblings.cast("binary"), 256))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periods(_table(spark, sf_dir, "documents"))).withColumn("best", greatest_run(F.col("runs")))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(told.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_near_vectors, op3_decontamination, op4_packing, op5_token_counts, op6_repeats, op7_quality, op8_url_filter, op9_token_files, op10_secrets, op11_word_bpe, op12_merkle_manifest, op13_periodic_runs)}
ORACLE = {"op8_url_filter": url_templates.oracle(), "op12_merkle_manifest": merkle.oracle()}
