"""Corpus files: discovery, type check, readers (1.1-1.6).

A split is a folder searched recursively for ``.txt``, ``.json`` and ``.jsonl`` files (suffixes
are case-sensitive). All files of the corpus must share one extension (``json`` and ``jsonl``
count as different). Rows keep their file order through a position key:
``(file rank in sorted path order, split start in the file, position in the split)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.constants import CORPUS_EXTENSIONS
from corpusprep.operators.ordering import row_index

RANK_BROADCAST_BYTES = 256 * 1024 * 1024
TEXT_SCHEMA = T.StructType([T.StructField("text", T.StringType())])
PAIRS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("prompt", "chosen", "rejected")])
TRANSCRIPT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("chosen", "rejected")])
INSTRUCTION_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("instruction", "input", "output")])
CONVERSATION_SCHEMA = T.StructType([T.StructField("conversations", T.ArrayType(T.StructType([
    T.StructField("from", T.StringType()), T.StructField("value", T.StringType())])))])


def _exists(spark: SparkSession, directory: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path))


def discover_files(spark: SparkSession, directory: str | None, extensions=CORPUS_EXTENSIONS) -> list[str] | None:
    """Sorted paths of the corpus files under ``directory`` (recursive); ``None`` when the
    folder does not exist (the split is then absent). Listing uses Spark's file index on the
    driver; the ``binaryFile`` scan reads no content because only ``path`` is selected."""
    if directory is None or not _exists(spark, directory):
        return None
    pattern = "*.{" + ",".join(extensions) + "}"
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
               .option("pathGlobFilter", pattern).load(directory).select("path"))
    jvm = spark.sparkContext._jvm
    # inputFiles() gives encoded URIs; readers want Hadoop path strings
    return sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(u)).toString() for u in listing.inputFiles())


def _metadata_form(spark: SparkSession, path: str) -> str:
    """The spelling ``_metadata.file_path`` uses for ``path``: an encoded URI with its file system,
    also for a path given without one."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().toString()


def extension(path: str) -> str:
    return path.rsplit(".", 1)[-1]


def check_one_type(files: dict[str, list[str] | None], *, raise_error: bool = True) -> dict[str, list[str]]:
    """Extensions per split; error when the corpus (all splits together) mixes extensions."""
    found = {split: sorted({extension(p) for p in (paths or [])}) for split, paths in files.items()}
    every = sorted({e for exts in found.values() for e in exts})
    if raise_error and len(every) > 1:
        raise ValueError(f"corpus files must share one type (all txt or all jsonl), got {found}")
    return found


def with_file_position(df: DataFrame, files: list[str] | None = None, name: str = "file_pos", *,
                       path_col: str | None = None, block_col: str | None = None) -> DataFrame:
    """Add ``file_rank, file_block, file_row`` and a numeric ``name`` that is monotone in them.

    ``monotonically_increasing_id`` grows in read order inside a scan partition; together with
    the split start it orders the rows of one file. The rank table has one row per file
    (the driver already lists every file) and is joined on the path. ``files`` are readable
    paths; when the frame already carries ``_metadata`` fields (a stream micro-batch), pass
    their columns as ``path_col`` / ``block_col`` and the ranks follow the sorted paths in it.
    """
    spark = df.sparkSession
    if path_col is None:
        d = df.select("*", F.col("_metadata.file_path").alias("__path"),
                      F.col("_metadata.file_block_start").alias("file_block"),
                      F.monotonically_increasing_id().alias("file_row"))
        keys = [_metadata_form(spark, p) for p in files]
    else:
        d = df.select("*", F.col(path_col).alias("__path"), F.col(block_col).alias("file_block"),
                      F.monotonically_increasing_id().alias("file_row")).drop(path_col, block_col)
        keys = list(files)
    ranks = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "__path string, file_rank bigint")
    # one row per file: broadcast when its size is known to be small, else a shuffle join
    # (AQE splits a file holding many rows)
    small = sum(len(k) + 16 for k in keys) <= RANK_BROADCAST_BYTES
    d = d.join(F.broadcast(ranks) if small else ranks, on="__path", how="left")
    unknown = F.raise_error(F.concat(F.lit("no rank for file "), F.col("__path"))).cast("bigint")
    d = d.withColumn("file_rank", F.coalesce("file_rank", unknown)).drop("__path")
    # rank plus a share below 1 that grows with the block: monotone for files of any size
    block = F.col("file_block").cast("double")
    key = F.col("file_rank").cast("double") + block / (block + F.lit(float(2 ** 30)))
    return d.withColumn(name, key)


def read_text(spark: SparkSession, files: list[str], *, keep_linebreaks: bool = True) -> DataFrame:
    """One row per line, column ``text``; blank lines stay. With ``keep_linebreaks`` every
    line gets its newline back (Spark drops terminators, so a last line without one cannot
    be told apart: it gains one)."""
    df = spark.read.text(files)
    text = F.concat(F.col("value"), F.lit("\n")) if keep_linebreaks else F.col("value")
    return with_file_position(df.select(text.alias("text")), files)


def read_json(spark: SparkSession, files: list[str], schema: T.StructType = TEXT_SCHEMA, *,
              multiline: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines (or JSON documents with ``multiline``) with an explicit schema; other
    fields are ignored, malformed rows fail the job unless ``mode`` says otherwise."""
    df = spark.read.schema(schema).option("mode", mode).option("multiLine", str(multiline).lower()).json(files)
    return with_file_position(df, files)


def read_corpus(spark: SparkSession, train_dir: str, validation_dir: str | None = None, *,
                keep_linebreaks: bool = True, schema: T.StructType = TEXT_SCHEMA,
                json_multiline: bool = False) -> dict[str, DataFrame]:
    """Discover, type-check (both splits together) and read the corpus. The reader follows
    the extension; a missing validation folder leaves that split out. ``json_multiline`` reads
    ``.json`` files that hold a JSON array or pretty-printed documents (one file per task)."""
    files = {"train": discover_files(spark, train_dir)}
    if files["train"] is None:
        raise FileNotFoundError(f"no train folder {train_dir}")
    if not files["train"]:
        raise FileNotFoundError(f"no .txt/.json/.jsonl files under {train_dir}")
    val = discover_files(spark, validation_dir) if validation_dir else None
    if val:
        files["validation"] = val
    check_one_type(files)
    kind = extension(files["train"][0])
    out = {}
    for split, paths in files.items():
        if kind == "txt":
            out[split] = read_text(spark, paths, keep_linebreaks=keep_linebreaks)
        else:
            out[split] = read_json(spark, paths, schema, multiline=json_multiline)
    return out


def file_manifest(spark: SparkSession, directory: str | None, extensions=CORPUS_EXTENSIONS) -> DataFrame | None:
    """The corpus files under ``directory`` as a table: ``path``, ``uri`` (as ``_metadata.file_path`` spells it), ``extension``,
    ``length``, ``modified`` and ``file_rank``, the place in sorted path order; ``None`` when the folder does not exist. Spark lists
    the files (many folders as a job of its own) and ranks them; no list of them is kept in Python and no content is read."""
    if directory is None or not _exists(spark, directory):
        return None
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.{" + ",".join(extensions) + "}").load(directory))
    files = listed.select("path", F.col("_metadata.file_path").alias("uri"), F.regexp_extract("path", r"([^.]*)$", 1).alias("extension"),
                          "length", F.col("modificationTime").alias("modified"))
    return row_index(files, ["path"], name="file_rank")


def read_numbered(spark: SparkSession, folders: dict[str, str | None], *, keep_linebreaks: bool = True,
                  schema: T.StructType = TEXT_SCHEMA, json_multiline: bool = False) -> DataFrame:
    """``split, row_idx`` and the columns of ``schema`` of all rows of the folders (split name -> folder; folders that do not exist are
    left out, the first one must). ``row_idx`` is the row's position in its split, in file order.

    The rows are stored with their positions once, so they keep them whatever a later job's scan settings. Folders are read as a whole;
    ranks come from the manifest table by a join. Files of all splits must share one type."""
    manifests = {split: file_manifest(spark, folder) for split, folder in folders.items()}
    manifests = {split: m for split, m in manifests.items() if m is not None}
    if not folders or next(iter(folders)) not in manifests:
        raise FileNotFoundError(f"no folder {next(iter(folders.values()), None)}")
    found = {split: sorted(r[0] for r in m.select("extension").distinct().collect()) for split, m in manifests.items()}  # the few extensions asked for
    every = sorted({e for kinds in found.values() for e in kinds})
    if len(every) > 1:
        raise ValueError(f"corpus files must share one type (all txt or all jsonl), got {found}")
    if not found[next(iter(folders))]:
        raise FileNotFoundError(f"no .txt/.json/.jsonl files under {next(iter(folders.values()))}")
    out = None
    for split, manifest in manifests.items():
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{every[0]}")
        if every[0] == "txt":
            rows = reader.text(folders[split])
            columns = [(F.concat("value", F.lit("\n")) if keep_linebreaks else F.col("value")).alias("text")]
        else:
            rows = reader.schema(schema).option("mode", "FAILFAST").option("multiLine", str(json_multiline).lower()).json(folders[split])
            columns = [F.col(c) for c in schema.names]
        rows = rows.select(*columns, F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("file_block"),
                           F.monotonically_increasing_id().alias("file_row"))
        rows = row_index(rows.join(manifest.select("uri", "file_rank"), "uri"), ["file_rank", "file_block", "file_row"])
        rows = rows.select(F.lit(split).alias("split"), "row_idx", *[c for c in rows.columns if c in ("text", *schema.names)])
        out = rows if out is None else out.unionByName(rows)
    return out


def csv_by_header(spark: SparkSession, path: str, columns=("prompt", "chosen", "rejected")) -> list[DataFrame]:
    """The CSV files of a path, one frame per distinct header (files may name the columns in any
    order): ``columns`` by name, as text. Each file is checked against its own header."""
    listed = spark.read.text(path, recursiveFileLookup=True) if "*" not in path else spark.read.text(path)
    # of each file's first split the first line: narrow rows, combined before the shuffle
    lines = listed.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"),
                          F.monotonically_increasing_id().alias("at")).where("begin = 0")
    headers = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    jvm = spark.sparkContext._jvm
    frames = []
    for g in groups:  # one per distinct header; the files of a folder are listed on the driver anyway
        files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in g["files"]]
        df = (spark.read.option("header", "true").option("inferSchema", "false").option("multiLine", "true")
              .option("escape", '"').option("enforceSchema", "false").option("mode", "FAILFAST").csv(files))
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"CSV {files[0]} lacks columns {missing} (has {df.columns})")
        frames.append(df.select(*[F.col(c).cast("string") for c in columns]))
    if not frames:
        raise ValueError(f"no CSV rows under {path}")
    return frames


def read_pairs_csv(spark: SparkSession, path: str, *, columns=("prompt", "chosen", "rejected")) -> DataFrame:
    """Preference CSV with a header: columns are taken by header name (any order, also different
    orders in different files; other columns ignored), all as text; quoted newlines and doubled
    quotes inside fields, blank cells read as NULL. A file with quoted newlines cannot be split: one task
    per file, so large tables should come as many files."""
    return reduce(DataFrame.unionByName, csv_by_header(spark, path, columns))


def read_split(spark: SparkSession, directory: str, split: str, *, split_col: str = "split") -> DataFrame:
    """One named split of a stored dataset (``partitionBy(split)`` layout: only that folder is
    read); of a folder that ``write_prepared`` filled, of its newest version."""
    from corpusprep.sources.sinks import read_prepared

    return read_prepared(spark, directory).where(F.col(split_col) == F.lit(split))
