"""Conversions of whole columns, steered by a value of the column itself."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.functions import date_format_of, date_text_in_format
from vitaelake.operators.dedup import first_non_null
from vitaelake.operators.projection import quoted, string_columns


def date_columns_by_sample(
    df: DataFrame, columns: Sequence[str], order_by: str, strict: bool = True
) -> DataFrame:
    """Text columns of dates as ``dd/mm/yyyy`` text, each in the format of its first non-null value
    under a declared order; columns that are absent or hold no text stay as they are.

    The samples are one row, aggregated in the same job out of the columns alone (combined before
    the shuffle), and read by every row as a scalar; no value passes through the driver. Where the
    format is a matter of the row, use ``functions.reformat_date_text``.
    """
    dates = string_columns(df, columns)
    if not dates:
        return df
    samples = first_non_null(df.select(*map(quoted, dict.fromkeys([*dates, order_by]))), dates, order_by)
    return df.withColumns(
        {
            name: date_text_in_format(
                quoted(name), date_format_of(samples.select(quoted(name)).scalar()), strict
            )
            for name in dates
        }
    )
