"""Named views of a frame, for SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def as_view(df: DataFrame, name: str) -> str:
    """A view of this session."""
    df.createOrReplaceTempView(name)
    return name


def as_global_view(df: DataFrame, name: str) -> str:
    """A view all sessions of the application see, under the name returned."""
    df.createOrReplaceGlobalTempView(name)
    return f"global_temp.{name}"


def drop_global_view(spark: SparkSession, name: str) -> bool:
    """Remove a view of all sessions; whether there was one."""
    return spark.catalog.dropGlobalTempView(name)


def query_frames(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over frames, written ``{name}`` in the text; no view is left or replaced."""
    return spark.sql(sql, **frames)
