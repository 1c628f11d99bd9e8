"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# UTC keeps zone-stamped article dates on their own day; symbols such as
# "NOW" or "1" must stay strings when they become partition directories.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Window stages are heavy per byte: let small inputs still use every core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Window partitions can be merged at run time but not split: start high.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    # Sorted ids compress tenfold and more: 64 MB of shuffled rows, the default,
    # take gigabytes where a task sorts, joins and groups them.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_spark(app: str = "barsignal", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Fits that run side by side share the cores; read when a session starts.
    for key, value in {"spark.scheduler.mode": "FAIR", **SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Without that setting it lies in the warehouse folder. On a cluster that
    must be a shared one: a folder of the driver's own machine is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        own = root.startswith("file:") or "://" not in root
        if own and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the scan of it.

    Cuts the lineage without losing column pruning or filter pushdown, and the
    table outlives any executor.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(table: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` has written."""
    spark = table.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {path.rpartition("/")[0] for path in table.inputFiles()}:
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
