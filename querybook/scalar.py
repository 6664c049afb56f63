"""Queries over column functions."""

from datetime import datetime

from pyspark.sql import functions as F

from querybook.derived import index_from_text, spread, table, text
from querybook.registry import query
from vitaelake import functions as V
from vitaelake.operators.columns import date_columns_by_sample
from vitaelake.operators.projection import add_if_absent, set_column, string_columns

RUN_AT = datetime(2024, 5, 24, 9, 30, 15)


@query(
    "split_last",
    "SELECT page_id, string_split(url, '/')[-1] AS last_part FROM pages",
)
def split_last(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", V.last_segment(F.col("url")).alias("last_part"))


@query(
    "falsy_coalesce",
    """
    SELECT c_custkey,
           coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN ''
                                WHEN c_custkey % 3 = 1 THEN c_name END, ''), c_mktsegment)
             AS chosen
    FROM customer
    """,
)
def falsy_coalesce(spark, sf_dir):
    key = F.col("c_custkey")
    preferred = F.when(key % 3 == 0, "").when(key % 3 == 1, F.col("c_name"))
    chosen = V.falsy_coalesce(preferred, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", chosen.alias("chosen"))


@query(
    "recode",
    """
    SELECT event_id, event_type,
           CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 END
             AS event_order
    FROM events
    """,
)
def recode(spark, sf_dir):
    code = V.recode(F.col("event_type"), {"view": 1, "click": 2, "purchase": 3})
    events = table(spark, sf_dir, "events")
    return events.select("event_id", "event_type", code.alias("event_order"))


def _keyword_list():
    member = "struct<display_name:string>"
    return (
        F.when(F.col("p_size") % 5 == 1, F.array().cast(f"array<{member}>"))
        .when(
            F.col("p_size") % 5 != 0,
            F.array(
                *[
                    F.struct(F.col(name).alias("display_name"))
                    for name in ("p_name", "p_brand")
                ],
                F.lit(None).cast(member),
                F.struct(F.lit(None).cast("string").alias("display_name")),
                F.struct(F.col("p_type").alias("display_name")),
            ),
        )
    )


@query(
    "list_project",
    """
    SELECT p_partkey,
           CASE WHEN p_size % 5 = 0 THEN -1 WHEN p_size % 5 = 1 THEN 0 ELSE 5 END AS n_names,
           CASE WHEN p_size % 5 > 1
                THEN p_name || '|' || p_brand || '|<null>|<null>|' || p_type
                WHEN p_size % 5 = 1 THEN '' END AS names
    FROM part
    """,
)
def list_project(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("keywords", _keyword_list())
    names = parts.withColumn("names", V.project_list(F.col("keywords"), "display_name"))
    return names.select(
        "p_partkey",
        F.coalesce(F.size("names"), F.lit(-1)).alias("n_names"),
        F.array_join("names", "|", "<null>").alias("names"),
    )


@query(
    "list_join",
    """
    SELECT p_partkey,
           CASE WHEN p_size % 5 > 1 THEN p_name || '; ' || p_brand || '; ' || p_type
                WHEN p_size % 5 = 1 THEN '' END AS joined
    FROM part
    """,
)
def list_join(spark, sf_dir):
    joined = V.join_list(V.project_list(_keyword_list(), "display_name"))
    return table(spark, sf_dir, "part").select("p_partkey", joined.alias("joined"))


@query(
    "nested_fields",
    """
    SELECT p_partkey,
           CASE WHEN p_size % 4 <> 0 AND p_size % 3 <> 0 THEN p_name END AS journal_name,
           CASE WHEN p_size % 4 <> 0 AND p_size % 3 <> 0 THEN p_brand END AS issn_l,
           CASE WHEN p_size % 4 <> 0 THEN p_type END AS license
    FROM part
    """,
)
def nested_fields(spark, sf_dir):
    from vitaelake.operators.works import add_journal

    source = F.struct(F.col("p_name").alias("display_name"), F.col("p_brand").alias("issn_l"))
    location = F.struct(
        F.when(F.col("p_size") % 3 != 0, source).alias("source"),
        F.col("p_type").alias("license"),
    )
    parts = table(spark, sf_dir, "part").withColumn(
        "primary_location", F.when(F.col("p_size") % 4 != 0, location)
    )
    return add_journal(parts).select("p_partkey", "journal_name", "issn_l", "license")


@query(
    "inverted_index_text",
    """
    SELECT doc_id,
           trim(regexp_replace(text, ' +', ' ', 'g'), ' ') AS abstract
    FROM documents
    """,
)
def inverted_index_text(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents"))
    index = docs.select("doc_id", V.encode_json(index_from_text(F.col("text"))).alias("index"))
    return index.select("doc_id", V.text_from_inverted_index(F.col("index")).alias("abstract"))


@query(
    "json_encode_map",
    """
    SELECT event_id,
           CASE WHEN event_type <> 'error'
                THEN '{"' || event_type || '":[' || user_id || ',' || event_id || ']}' END
             AS index_json
    FROM events
    """,
)
def json_encode_map(spark, sf_dir):
    index = F.when(
        F.col("event_type") != "error",
        F.create_map("event_type", F.array("user_id", "event_id")),
    )
    events = table(spark, sf_dir, "events")
    return events.select("event_id", V.encode_json(index).alias("index_json"))


@query(
    "date_detect_format",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate, '%d/%m/%Y') END AS order_date
    FROM orders
    """,
)
def date_detect_format(spark, sf_dir):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 4 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 4 == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(key % 4 == 2, F.date_format(day, "dd/MM/yyyy"))
        .when(key % 8 == 3, F.date_format(day, "yyyy-MM-'31T'HH:mm:ss.SSS"))
        .alias("order_date"),
    )
    names = string_columns(orders, ["order_date", "o_orderkey", "absent"])
    return orders.withColumns({name: V.reformat_date_text(F.col(name)) for name in names})


_BY_SAMPLE = """strftime(CASE WHEN contains({0}_first, 'T') THEN try_strptime({0}, '%Y-%m-%dT%H:%M:%S')
                WHEN contains({0}_first, '-') THEN try_strptime({0}, '%Y-%m-%d')
                ELSE try_strptime({0}, '%d/%m/%Y') END, '%d/%m/%Y') AS {0}"""


@query(
    "date_format_by_column",
    f"""
    WITH written AS (
      SELECT o_orderkey,
             CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_custkey % 3 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
                  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS mixed,
             CASE WHEN o_custkey % 5 = 4 THEN 'unknown' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS local,
             CASE WHEN o_orderkey > 40 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS stamp
      FROM orders),
    samples AS (
      SELECT first(mixed ORDER BY o_orderkey) FILTER (mixed IS NOT NULL) AS mixed_first,
             first(local ORDER BY o_orderkey) FILTER (local IS NOT NULL) AS local_first,
             first(stamp ORDER BY o_orderkey) FILTER (stamp IS NOT NULL) AS stamp_first
      FROM written)
    SELECT o_orderkey, {_BY_SAMPLE.format("mixed")}, {_BY_SAMPLE.format("local")},
           {_BY_SAMPLE.format("stamp")}
    FROM written, samples
    """,
)
def date_format_by_column(spark, sf_dir):
    """Each column in the format of its first value, by order key; what is written otherwise is null."""
    day = F.col("o_orderdate")
    local, iso = F.date_format(day, "dd/MM/yyyy"), F.date_format(day, "yyyy-MM-dd")
    written = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", None)
        .when(F.col("o_custkey") % 3 == 0, local)
        .otherwise(iso)
        .alias("mixed"),
        F.when(F.col("o_custkey") % 5 == 4, "unknown").otherwise(local).alias("local"),
        F.when(F.col("o_orderkey") > 40, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")).alias("stamp"),
    )
    names = ["mixed", "local", "stamp", "absent"]
    return date_columns_by_sample(written, names, "o_orderkey", strict=False)


@query(
    "date_parse_strict",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders",
)
def date_parse_strict(spark, sf_dir):
    written = F.date_format("o_orderdate", "ddMMyyyy")
    parsed = table(spark, sf_dir, "orders").select(
        "o_orderkey", V.parse_update_date(written).alias("order_date")
    )
    return parsed.withColumn("order_date", F.col("order_date").cast("string"))


@query(
    "run_timestamp_if_absent",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at,
           '2024-05-24 09:30:15' AS updated_at
    FROM orders
    """,
)
def run_timestamp_if_absent(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("created_at")
    )
    stamped = add_if_absent(orders, "created_at", V.run_timestamp(RUN_AT))
    stamped = add_if_absent(stamped, "updated_at", V.run_timestamp(RUN_AT))
    return stamped.withColumns(
        {
            name: F.col(name).cast("string")
            for name in ("created_at", "updated_at")
        }
    )


@query(
    "run_timestamp_overwrite",
    "SELECT o_orderkey, '2024-05-24 09:30:15' AS updated_at FROM orders",
)
def run_timestamp_overwrite(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", text(F.col("o_orderdate")).alias("updated_at")
    )
    stamped = set_column(orders, "updated_at", V.run_timestamp(RUN_AT))
    return stamped.withColumn("updated_at", F.col("updated_at").cast("string"))
