"""Session settings and the shared folder for checkpoints and hand-off tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores="*", shuffle_partitions=8, memory="8g"):
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("tillcast")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from the session's ``spark.checkpoint.dir``.

    A local session that names none uses its warehouse folder. A cluster must name one:
    anything else would be a folder that only one machine sees.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this application's own part of it."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _own_dir(spark):
    return f"{shared_dir(spark).rstrip('/')}/tillcast/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Several actions then share one computation, the lineage is cut, and a lost
    executor costs a re-read, not a recomputation. The write and read keep columns
    prunable and filters pushable, which a checkpointed RDD would not. With
    ``partition_by`` a filter on that column reads only its own files.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


def release(spark: SparkSession) -> None:
    """Delete every hand-off table of this application.

    For its owner to call once all results are written: frames that still read a
    hand-off table fail afterwards.
    """
    drop_path(spark, _own_dir(spark))


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one path of the shared folder."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)
