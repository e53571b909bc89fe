"""Column functions over lines of text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sentences the classification returns.
MINOR = " is a minor."
ADULT = " is an adult."
SENIOR = " is a senior citizen."
NOBODY = "None"


def tokens(line: Column, delimiter: str = " ") -> Column:
    """Split a line on a one-character delimiter, as the JVM's split does.

    Empty tokens at the end are dropped and those before are kept. So a line
    of delimiters alone has no token, while an empty line has one empty token.
    """
    kept = F.rtrim(line, F.lit(delimiter))
    no_tokens = F.array().cast("array<string>")
    return F.when((kept == "") & (line != ""), no_tokens).otherwise(
        F.split(kept, re.escape(delimiter))
    )


def parse_fields(
    df: DataFrame,
    line: str,
    fields: dict[str, str],
    delimiter: str = ",",
    lenient: bool = False,
    null_mark: str = "\\N",
) -> DataFrame:
    """Typed columns from a delimited line, ``fields`` being name -> type.

    A field that is ``null_mark`` is NULL. Bad text raises; with ``lenient`` it
    gives NULL.
    """
    parts = F.split(F.col(line), re.escape(delimiter))
    columns = []
    for position, (name, type_) in enumerate(fields.items()):
        raw = parts.getItem(position) if not lenient else F.get(parts, F.lit(position))
        raw = F.nullif(raw, F.lit(null_mark))
        columns.append((raw.try_cast(type_) if lenient else raw.cast(type_)).alias(name))
    return df.select(*columns)


def describe_age(name: Column, age: Column, adult_from: int = 18, senior_from: int = 65) -> Column:
    """"NAME is a minor." and so on by age; "None" where the age is unknown."""
    return (
        F.when(age < adult_from, F.concat(name, F.lit(MINOR)))
        .when(age < senior_from, F.concat(name, F.lit(ADULT)))
        .when(age.isNotNull(), F.concat(name, F.lit(SENIOR)))
        .otherwise(F.lit(NOBODY))
    )
