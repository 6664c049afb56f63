"""Text, list and recode functions."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_segment(url: Column) -> Column:
    """What follows the last slash of a URL id; the whole text when there is none."""
    return F.substring_index(url, "/", -1)


def falsy_coalesce(preferred: Column, fallback: Column) -> Column:
    """The preferred text, or the fallback when it is null or empty."""
    return F.coalesce(F.nullif(preferred, F.lit("")), fallback)


def join_list(items: Column, separator: str = "; ") -> Column:
    """List members as one text. Null members are left out, an empty list gives ``''``."""
    return F.array_join(items, separator)


def project_list(items: Column, field: str) -> Column:
    """One field of every struct in a list. The scan then reads that field only."""
    return items.getField(field)


def recode(value: Column, codes: Mapping) -> Column:
    """Replace by a closed map; anything outside it, null included, becomes null."""
    pairs = iter(codes.items())
    known, code = next(pairs)
    result = F.when(value == known, F.lit(code))
    for known, code in pairs:
        result = result.when(value == known, F.lit(code))
    return result
