"""Frames kept in the executors or on storage, with a way to let go of them."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from sparkloom.session import shared_root


class Persisted:
    """Persisted frames of one user, released together.

    ``with Persisted() as kept`` releases them at the end of the block.
    """

    def __init__(self) -> None:
        self.frames: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self.frames.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def release(self) -> None:
        for df in self.frames:
            if df.sparkSession.sparkContext._jsc is not None:
                df.unpersist()
        self.frames.clear()

    def __enter__(self) -> Persisted:
        return self

    def __exit__(self, *_) -> None:
        self.release()


class Checkpointed:
    """Frames kept on shared storage, released together.

    What ``keep`` returns reads files below ``spark.checkpoint.dir`` and has no
    lineage beyond them, so a lost executor costs nothing but a read; a frame kept
    in the executors would be computed again where its blocks are lost. The files
    are Parquet, so each user reads only the columns it needs. ``with
    Checkpointed() as kept`` releases them at the end of the block; a frame must
    not be used after that.
    """

    def __init__(self) -> None:
        self.folders: list[tuple[SparkSession, str]] = []

    def keep(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path = f"{shared_root(spark)}/checkpoint-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.folders.append((spark, path))
        return spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        for spark, path in self.folders:
            context = spark.sparkContext
            if context._jsc is not None:
                folder = context._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        self.folders.clear()

    def __enter__(self) -> Checkpointed:
        return self

    def __exit__(self, *_) -> None:
        self.release()
