"""The training-data pipeline: quality classifier, n-gram Jaccard join, benchmark decontamination, secret scan, packing.

Every stage takes all rows its predecessor kept. All but the last return the columns of ``documents``, extra ones included, whatever
their names. Null, empty and blank texts pass the quality, decontamination and secrets stages unchanged; of rows equal in id
and text one stays after the second stage (null ids and null texts are values like others there). Without trusted rows in ``labels`` the
quality stage keeps all, without items in ``benchmark`` the decontamination stage does. An empty ``documents`` gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import perplexity
from corpusprep.llm.common import stored
from corpusprep.llm.decontaminate import drop_contaminated
from corpusprep.llm.ngram_join import drop_near_copies
from corpusprep.llm.packing import pack_documents
from corpusprep.llm.secrets import redact_secrets
from corpusprep.session import drop_stored, scratch_scope, share_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go. Trusted text is what the given documents and ``labels`` hold."""
    share_package(spark)
    # columns named like the classifier's results must come through as they are
    rows = docs.toDF(*(c if c in ("doc_id", "text", "lang") else f"c{i}" for i, c in enumerate(docs.columns)))
    model = perplexity.fit(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return model.score(rows).where("keep").select(*rows.columns).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    share_package(spark)
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    share_package(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; every document stays, ``n_chars`` follows its text."""
    share_package(spark)
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    share_package(spark)
    return pack_documents(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality), ("near_copies", near_copies), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

#: SQL cannot express the stages; the tests hold run() against a plain computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch_scope() as made:
            before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_stored(before, *(t for t in made if t is not docs))  # the next stage reads this one's rows alone
    return STAGES[-1][1](spark, docs, sf_dir)
