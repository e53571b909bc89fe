"""File sources and sinks: text, CSV, JSON lines and Parquet.

Parquet is the format to keep data in: of the four only its scans skip the
bytes of unread columns and take filters into the reader. Inferring a CSV or
JSON schema reads the whole input once more, so pass a schema for large input.

What is written here can be read back as it was. In CSV files a NULL is written
as a marker, so that it differs from the empty string, and line breaks within
strings are escaped, so that a line is a row and large files can be split; read
such files with ``escaped``. Rows that do not fit a typed schema raise an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# How NULL is written in CSV files and in lines of delimited fields.
NULL_MARK = "\\N"
CSV_FORMAT = {
    "escape": '"',
    "nullValue": NULL_MARK,
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# Written for characters that would end a line or undo this, and for a string
# that looks like the mark of NULL.
ESCAPES = (("%", "%25"), ("\n", "%0A"), ("\r", "%0D"), ("\\", "%5C"))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``; only a line feed ends a line."""
    return spark.read.text(path, lineSep="\n")


def escape_breaks(column: Column) -> Column:
    for plain, written in ESCAPES:
        column = F.replace(column, F.lit(plain), F.lit(written))
    return column


def unescape_breaks(column: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        column = F.replace(column, F.lit(written), F.lit(plain))
    return column


def _strings(df: DataFrame, change) -> DataFrame:
    return df.select(
        *[
            change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def read_csv_strings(
    spark: SparkSession, path: str, header: bool = False, escaped: bool = False
) -> DataFrame:
    """Every column a string; named by the header, else ``_c0, _c1, ...``."""
    df = spark.read.options(**CSV_FORMAT).csv(path, header=header)
    return _strings(df, unescape_breaks) if escaped else df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    header: bool = False,
    escaped: bool = False,
) -> DataFrame:
    """CSV under a DDL string or a StructType, without inference; bad rows raise."""
    reader = spark.read.options(**CSV_FORMAT, mode="FAILFAST")
    df = reader.csv(path, schema=schema, header=header, inferSchema=False)
    return _strings(df, unescape_breaks) if escaped else df


def read_csv_inferred(
    spark: SparkSession, path: str, header: bool = True, escaped: bool = False
) -> DataFrame:
    reader = spark.read.options(**CSV_FORMAT, mode="FAILFAST")
    df = reader.csv(path, header=header, inferSchema=True)
    return _strings(df, unescape_breaks) if escaped else df


def read_json_lines(
    spark: SparkSession, path: str, schema: str | StructType | None = None
) -> DataFrame:
    """JSON lines; bad rows raise."""
    return spark.read.json(path, schema=schema, mode="FAILFAST")


def string_schema(*names: str) -> StructType:
    """A schema of nullable string columns."""
    return StructType([StructField(name, StringType(), True) for name in names])


def delimited(*columns: str, delimiter: str = ",") -> Column:
    """The columns as one line of fields, a NULL as the mark of NULL."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.concat_ws(delimiter, *fields)


def write_text_lines(df: DataFrame, column: str, path: str) -> str:
    """A line per row; a NULL has no line, a line feed in the text ends a line."""
    lines = df.select(df[column].alias("value")).filter("value is not null")
    lines.write.mode("overwrite").text(path, lineSep="\n")
    return path


def write_csv(df: DataFrame, path: str, header: bool = False) -> str:
    """CSV with escaped line breaks; read it back with ``escaped``."""
    writer = _strings(df, escape_breaks).write.mode("overwrite").options(**CSV_FORMAT)
    writer.csv(path, header=header)
    return path


def write_json_lines(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path
