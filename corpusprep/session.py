"""Session helpers. Library functions never create a session; they use ``df.sparkSession``."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "corpusprep", master: str | None = None,
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """A session with AQE on and UTC time (for scripts, tests and the bench)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a local-mode session that
    names none (tests) gets a private temporary folder; on a cluster a missing setting is an
    error, because a machine-local folder is not shared."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        current = tempfile.mkdtemp(prefix="corpusprep-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "corpusprep", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read again: later jobs read the files, so nothing
    is computed twice and a lost executor costs no lineage. ``drop_stored`` deletes the files. With ``by``, a column of which a task holds
    few values, each task writes its rows to the buckets of that column, so grouping by it later moves no row."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if by is None:
        df.write.option("compression", "zstd").parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    else:
        table = os.path.basename(path).replace("-", "_")
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.option("compression", "zstd").bucketBy(buckets, by).saveAsTable(table, format="parquet", path=path)
        out = spark.table(table)
        out.__dict__["_scratch_table"] = table
    out.__dict__["_scratch_path"] = path
    for scope in _SCOPES[-1:]:
        scope.append(out)
    return out


_SCOPES: list[list[DataFrame]] = []


@contextmanager
def scratch_scope() -> Iterator[list[DataFrame]]:
    """Collects every table that ``stored`` writes inside, so that the caller can drop those that its result does not read."""
    made: list[DataFrame] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.pop()
        for outer in _SCOPES[-1:]:  # what is left belongs to the scope around this one
            outer += [t for t in made if "_scratch_path" in t.__dict__]


def drop_stored(*frames: DataFrame) -> None:
    """Delete the files of frames that ``stored`` returned, once nothing that is still to run reads them. Other frames are left alone.
    Spark deletes the shuffle files of finished jobs when the driver collects its garbage, so it is asked to."""
    sc = None
    for df in frames:
        path = df.__dict__.pop("_scratch_path", None)
        if table := df.__dict__.pop("_scratch_table", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")  # its name; the files go below
        if path:
            sc = df.sparkSession.sparkContext
            place = sc._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)
    if sc is not None:
        sc._jvm.System.gc()


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (the same path on every
    machine, as when the package is installed or its folder is on a shared path)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
