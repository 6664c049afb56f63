"""Selecting, renaming, flattening and adding columns."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col(f"`{name}`")


def row_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """Hash of a row, or of the named columns; repeatable, so a recomputed task agrees."""
    if columns is None:
        unhashable = ("map<", "variant")
        columns = [
            field.name
            for field in df.schema.fields
            if not any(kind in field.dataType.simpleString() for kind in unhashable)
        ]
    return F.xxhash64(*[quoted(name) for name in columns])


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The input itself; raises when a column is absent."""
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def select_rename(
    df: DataFrame, names: Mapping[str, str], rename: bool = True, strict: bool = True
) -> DataFrame:
    """Select in map order and rename. Absent columns raise if ``strict`` and renaming, and
    are left out otherwise."""
    if strict and rename:
        require_columns(df, names)
    present = [name for name in names if name in df.columns]
    return df.select(*[quoted(old).alias(names[old] if rename else old) for old in present])


def _check_clash(names: list[str]) -> None:
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"duplicate columns: {', '.join(repeated)}")


def unnest_struct(df: DataFrame, column: str) -> DataFrame:
    """Put a struct's fields in its place. Equal names raise; Spark would keep both."""
    require_columns(df, [column])
    fields = df.schema[column].dataType.names
    columns, names = [], []
    for name in df.columns:
        if name == column:
            columns += [quoted(column).getField(field).alias(field) for field in fields]
            names += fields
        else:
            columns.append(quoted(name))
            names.append(name)
    _check_clash(names)
    return df.select(*columns)


def merge_records(df: DataFrame, left: str, right: str) -> DataFrame:
    """Two struct columns as one flat record; on equal names the right side's value wins, at
    the left side's place. Other columns follow."""
    left_fields, right_fields = (df.schema[name].dataType.names for name in (left, right))
    merged = [
        quoted(right if field in right_fields else left).getField(field).alias(field)
        for field in left_fields
    ] + [
        quoted(right).getField(field).alias(field)
        for field in right_fields
        if field not in left_fields
    ]
    others = [quoted(name) for name in df.columns if name not in (left, right)]
    return df.select(*merged, *others)


def add_if_absent(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column unless the table already has one of that name."""
    return df if name in df.columns else df.withColumn(name, value)


def set_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column, or overwrite the one of that name."""
    return df.withColumn(name, value)


def string_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of the names that exist and hold text."""
    return [
        name
        for name in names
        if name in df.columns and isinstance(df.schema[name].dataType, T.StringType)
    ]
