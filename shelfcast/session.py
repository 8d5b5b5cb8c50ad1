"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g", shared: str | None = None
) -> SparkSession:
    """A local session for tests and benches; on a cluster the submitter's session is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfcast")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a temporary folder; a cluster session
    without it is an error, since a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"shelfcast-{application}-")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/shelfcast/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and lets several scans share the work."""
    spark = df.sparkSession
    path = new_table_path(spark, name)
    out = df
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
