"""Column functions: Column in, Column out, all built-in and JVM-side."""

from vitaelake.functions.dates import (
    date_format_of,
    date_text_in_format,
    parse_update_date,
    reformat_date_text,
    run_date_text,
    run_timestamp,
)
from vitaelake.functions.inverted_index import (
    encode_json,
    map_text_or_null,
    text_from_inverted_index,
)
from vitaelake.functions.text import falsy_coalesce, join_list, last_segment, project_list, recode

__all__ = [
    "date_format_of",
    "date_text_in_format",
    "encode_json",
    "falsy_coalesce",
    "join_list",
    "last_segment",
    "map_text_or_null",
    "parse_update_date",
    "project_list",
    "recode",
    "reformat_date_text",
    "run_date_text",
    "run_timestamp",
    "text_from_inverted_index",
]
