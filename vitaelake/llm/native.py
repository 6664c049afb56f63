"""Column helpers that stay inside the JVM."""

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.session import drop_scratch, scratch_location, shuffles_dropped

WHITE_SPACE = "[\\x09-\\x0D\\x20]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_SPACE), "")


def row_digest(*columns: Column) -> Column:
    """64 bits that tell rows apart, nulls included."""
    marked = [part for column in columns for part in (column.isNull(), column)]
    return F.xxhash64(*marked)


def staged(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read back."""
    return stored(spark, rows, scratch_location(spark, label))


def stored(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    with shuffles_dropped(spark):
        rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


class Scratch:
    """Tables that a step stages for itself."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []

    def staged(self, rows: DataFrame, label: str) -> DataFrame:
        self.folders.append(scratch_location(self.spark, label))
        return stored(self.spark, rows, self.folders[-1])

    def drop(self) -> None:
        for folder in self.folders:
            drop_scratch(self.spark, folder)
        self.folders = []
