"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "newsloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on.

    Shuffle partitions start high and adaptive execution merges them to ``advisoryPartitionSize``,
    so one setting serves small and large inputs; skewed join partitions are split at run time.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "128m",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which all executors share: ``spark.checkpoint.dir`` of the
    session, or the checkpoint directory set on its context."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named


def new_table_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/newsloom/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    The result no longer depends on executors that computed it, and readers fetch only the columns
    they use.
    """
    path = new_table_path(df.sparkSession, tag)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_path = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote, once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
