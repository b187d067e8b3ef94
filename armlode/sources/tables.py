"""Table readers and names shared by every source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``base``; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def source_key(name: str | Column) -> Column:
    """A source's name reduced to its letters and digits, in lower case.

    Two spellings of one source have the same key. Null stays null.
    """
    col = F.col(name) if isinstance(name, str) else name
    return F.lower(F.regexp_replace(col, r"[^\p{L}\p{N}]+", ""))
