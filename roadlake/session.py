"""Session settings the jobs are written for, and the shared folder they may write to."""

import contextlib
import functools
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # keeps the state of long streams off the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build(app: str = "roadlake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs that run within; then they are as before."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_table(spark: SparkSession, **columns: list) -> DataFrame:
    """A fixed table given by its columns; the plan holds its rows, so it needs no job to read."""
    return spark.createDataFrame(pa.table(columns))


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="roadlake-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local run without one gets a scratch folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


def _scratch_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/roadlake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path of this application in the shared folder."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what this application put in the shared folder; call it when the results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once what was made of it is stored itself."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if f"/roadlake/{spark.sparkContext.applicationId}/" not in path.toString():
            raise ValueError(f"{path} is no scratch table of this application")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several branches, so that its shuffles run once, and where an
    aggregate is joined to a large table: the planner then knows the true size of the aggregate
    and broadcasts it only below spark.sql.autoBroadcastJoinThreshold. Above that it joins by
    sort-merge, where adaptive execution splits hot keys; it does so between plain tables, not next
    to an aggregate. The table outlives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
