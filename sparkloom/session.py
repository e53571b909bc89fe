"""Session settings and the shared scratch folder."""

from __future__ import annotations

import zlib

from pyspark.sql import SparkSession

# All of these are Spark settings a job may override; none is needed for right
# results. AQE starts from many small shuffle partitions and merges or splits
# them by measured size, so one setting serves small and large inputs.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "sparkloom",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the defaults above; ``settings`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder for files between two steps, one that every executor can reach.

    ``spark.checkpoint.dir`` if the session names one, else the warehouse,
    which a session always has.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/sparkloom-{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, label: str, source: str = "") -> str:
    """The folder of one step of this application, the same for each call.

    ``source`` tells inputs apart: a step that runs again over the same input
    overwrites what it wrote, and over another input writes beside it.
    """
    suffix = f"-{zlib.crc32(source.encode()):08x}" if source else ""
    return f"{shared_root(spark)}/{label}{suffix}"


def release_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote through ``scratch_dir``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
