"""Session helpers: local sessions, and tables written once to the shared folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A single-JVM session for tests and the bench. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Runtime SQL settings the plans rely on: adaptive re-planning; splitting of skewed joins, also
    where the split costs one more shuffle; a size estimate for files that allows for their
    compression, so that a side is broadcast for the size it has in memory; and a codec for written
    tables that also shortens what never repeats, such as the hexadecimal ids of the order lines."""
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.fileCompressionFactor": "4.0",
        "spark.sql.parquet.compression.codec": "zstd",
    }.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, which the session names in `spark.checkpoint.dir`. Where it names none, a folder is
    made only on a local master, whose executors are this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="shelfline-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def files_of(spark: SparkSession, folder: str):
    """The folder's path and file system, whatever store it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def last_change(spark: SparkSession, folder: str) -> int:
    """When the newest entry of a folder was written, in milliseconds; 0 for an empty one."""
    path, files = files_of(spark, folder)
    return max((entry.getModificationTime() for entry in files.listStatus(path)), default=0)


def own_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Removes the intermediate tables of this application. Tables that read them can't be used any more."""
    path, files = files_of(spark, own_folder(spark))
    files.delete(path, True)


def materialize(df: DataFrame, name: str = "step", partition_by: tuple[str, ...] = (), placed: bool = False) -> DataFrame:
    """Write `df` as Parquet to the shared folder and return a scan of it.

    This cuts the lineage at a point that survives lost executors, and gives later plans
    real file sizes to choose their joins by. `placed`: the rows lie by `partition_by` already and are not shuffled for it.
    """
    spark = df.sparkSession
    path = f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if partition_by and not placed:
        # Gathers small partitions and splits a folder that holds much more than the others.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # The declared schema spares the footer-reading job.
    table = spark.read.schema(df.schema).parquet(path)
    vars(table)["_written_to"] = path
    return table


def is_stored(table: DataFrame) -> bool:
    """Whether this very frame is what `materialize` has returned."""
    return "_written_to" in vars(table)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `materialize` has written, once their last reader is done, and lets Spark drop the shuffle files of
    plans that nothing refers to any more. Lineage that reads such a table can't be computed again, so whatever was made from it
    has to be written first."""
    for table in tables:
        if folder := vars(table).get("_written_to"):
            path, files = files_of(table.sparkSession, folder)
            files.delete(path, True)
    gc.collect()
    for table in tables[:1]:
        table.sparkSession._jvm.System.gc()
