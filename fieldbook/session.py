"""Session settings and the shared scratch area used to materialise reused tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "fieldbook", **conf) -> SparkSession:
    """A session with the settings the plans rely on; the cluster's own defaults win otherwise."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # call-site capture costs a round trip per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="fieldbook-")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder, since there every executor
    thread sees the same disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


_given: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder in the shared area that nothing else uses."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _given.append(path)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it is stored; nothing happens if there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def delete_file(spark: SparkSession, uri: str) -> None:
    """Delete a file told by its uri, as ``_metadata.file_path`` gives it; nothing happens if it is gone."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(file, False)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this process has staged so far.

    Call it when results are written: frames that read a staged table cannot run any more.
    """
    while _given:
        delete_folder(spark, _given.pop())


#: lets Spark delete a plan's shuffle files as soon as it has run, not when the driver happens to collect garbage
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a table that several branches of a plan consume: the upstream work runs once, the branches
    keep column pruning and filter pushdown, and a lost executor costs a file re-read.  With ``release`` what the
    plan has shuffled does not stay on disk beyond its run.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(RELEASE, None)
    try:
        if release:
            spark.conf.set(RELEASE, "true")
        df.write.mode("errorifexists").parquet(path)
    finally:
        if release:
            spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)
