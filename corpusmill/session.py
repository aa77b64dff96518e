"""Session set-up, table access and shared scratch space."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app="corpusmill", master=None, **conf):
    """A session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Documents and vectors are wide rows: keep Arrow batches small.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """A scan of few files spread over all cores by key, for work that is heavy per row.

    A large input has far more splits than the cluster has cores and is returned
    as it is; only a small one is shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= 2 * cores:
        return scan
    return scan.repartition(2 * cores, key)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="corpusmill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; two runs never get the same one."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label="step") -> DataFrame:
    """A step that is read several times, as a table in the shared folder.

    Later reads skip its computation, prune columns and know its size, and a lost
    executor costs a read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the reliable checkpoint folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
