"""Sinks (1.7, 1.8): prepared tables with reuse, and metric summaries.

A prepared table's folder holds one folder per version (``_version-...``) and the commits (``_commits/<number>.json``), whose
newest names the version that counts. A version is written in full before its commit, so a run that dies on the way leaves
the table as it was, and readers never see a table that is half written."""

from __future__ import annotations

import hashlib
import json
import uuid
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS, VERSION = "_commits", "_version-"


def fingerprint(params: dict, inputs: list[str] | None = None) -> str:
    """Stable digest of the preparation parameters and what is known of the input files."""
    payload = json.dumps({"params": params, "files": sorted(inputs or [])}, sort_keys=True, default=str)
    return hashlib.sha256(payload.encode()).hexdigest()


def content_digest(spark: SparkSession, paths: list[str]) -> str:
    """Number and order-independent digest of path, length and modification time of all files at ``paths`` (files or folders). Spark lists
    and digests them; no content is read and the driver gets one row."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    h = F.xxhash64("path", "length", "modificationTime")
    n, low, total = found.select(h.alias("h")).agg(F.count(F.lit(1)), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return f"{n} files {low} {total}"


def input_states(spark: SparkSession, inputs: list[str] | None) -> list[str]:
    """One entry for all inputs that are there, so that changed content is noticed, and one for each that is not."""
    paths = [unquote(p) if "://" in p or p.startswith("file:") else p for p in inputs or []]
    if not paths:
        return []
    try:
        return [content_digest(spark, paths)]
    except AnalysisException:  # some path is not there
        there = [p for p in paths if _exists(spark, p)]
        return [f"{p} absent" for p in paths if p not in there] + ([content_digest(spark, there)] if there else [])


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def _commits(spark: SparkSession, directory: str) -> list[tuple[int, str]]:
    fs, place = _at(spark, f"{directory}/{COMMITS}")
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return sorted((int(n[:-5]), n) for n in names if n.endswith(".json") and n[:-5].isdigit())


def current_version(spark: SparkSession, directory: str) -> dict | None:
    """What the newest commit says: ``version`` (its folder), ``fingerprint`` and ``params``; None if there is none."""
    commits = _commits(spark, directory)
    if not commits:
        return None
    text = spark.read.text(f"{directory}/{COMMITS}/{commits[-1][1]}", wholetext=True).first()
    return json.loads(text[0])


def read_prepared(spark: SparkSession, directory: str) -> DataFrame:
    """The table that the newest commit names; of a folder without commits (a table stored by other means) the folder itself."""
    now = current_version(spark, directory)
    return spark.read.parquet(f"{directory}/{now['version']}" if now else directory)


def _commit(spark: SparkSession, directory: str, number: int, told: dict) -> None:
    """Write the commit beside its place and rename it there: a rename onto a commit that exists fails."""
    fs, place = _at(spark, f"{directory}/{COMMITS}/{number:012d}.json")
    _, beside = _at(spark, f"{directory}/{COMMITS}/.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(bytearray(json.dumps(told, sort_keys=True, default=str).encode()))
    out.close()
    if fs.exists(place) or not fs.rename(beside, place):
        fs.delete(beside, False)
        raise RuntimeError(f"another run committed version {number} of {directory} first")


def write_prepared(df: DataFrame, directory: str, *, params: dict, input_files: list[str] | None = None,
                   overwrite: bool = False, split_col: str | None = "split", keep: int = 2) -> tuple[DataFrame, bool]:
    """Write the prepared table partitioned by split, unless the newest version was made from the same parameters and
    unchanged input files or folders (then it is reused). Returns the stored table and whether it was reused. The version is
    written through Spark's committer and then committed; of older versions the last ``keep - 1`` stay for their readers."""
    spark = df.sparkSession
    directory = directory.rstrip("/")
    now, commits = current_version(spark, directory), _commits(spark, directory)
    fp = fingerprint(params, input_states(spark, input_files))
    if not overwrite and now and now["fingerprint"] == fp:
        return read_prepared(spark, directory), True
    version = f"{VERSION}{uuid.uuid4().hex}"
    writer = df.write.partitionBy(split_col) if split_col else df.write
    writer.parquet(f"{directory}/{version}")
    _commit(spark, directory, commits[-1][0] + 1 if commits else 0, {"version": version, "fingerprint": fp, "params": params})
    for _, name in commits[: len(commits) + 1 - max(keep, 1)]:
        fs, place = _at(spark, f"{directory}/{COMMITS}/{name}")
        old = json.loads(spark.read.text(f"{directory}/{COMMITS}/{name}", wholetext=True).first()[0])["version"]
        fs.delete(_at(spark, f"{directory}/{old}")[1], True)
        fs.delete(place, False)
    return read_prepared(spark, directory), False


def write_summary(df: DataFrame, path: str) -> None:
    """A small metrics frame (one row, e.g. ``{"perplexity": x}``) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
