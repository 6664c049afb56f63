"""Queries over archives, XML, API pages and snapshots."""

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from querybook.derived import (
    bronze_authors,
    bronze_researchers,
    bronze_works,
    cv_documents,
    landed_pages,
    odd_section_documents,
    table,
    text,
    write_archives,
)
from querybook.registry import query
from querybook.relational import (
    BRIDGE_TEXT,
    SILVER_WORKS,
    flags_as_text,
    works_as_text,
)
from querybook.scalar import RUN_AT
from querybook.service import table_service
from querybook.sql import AUTHORS, WORKS_WITH_ABSTRACT
from vitaelake import schemas as S
from vitaelake.functions import text_from_inverted_index
from vitaelake.operators import curriculum, joins
from vitaelake.plans import authors as author_jobs
from vitaelake.plans import curricula_to_bronze, documents_to_bronze as bronze_of_documents
from vitaelake.plans import works as work_jobs
from vitaelake.plans.curricula import stage_documents
from vitaelake.plans.lake import Lake
from vitaelake.session import scratch_location
from vitaelake.sources import archive, drift, paging, snapshots

DAY_1, DAY_2, DAY_3 = date(2024, 5, 1), date(2024, 5, 9), date(2024, 6, 1)

# --- XML ----------------------------------------------------------------------------------

NONE = "CAST(NULL AS VARCHAR)"

# The derived documents whose text is whole, and the values they hold.
CV = """
    SELECT *, lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS lattes_id,
           CAST(c_nationkey AS BIGINT) AS nation
    FROM customer WHERE c_custkey % 7 <> 3
"""

RESEARCHERS = f"""
    SELECT lattes_id,
           CASE WHEN c_custkey % 4 <> 3 THEN 'https://orcid.example.org/' || c_custkey END
             AS orcid_id,
           c_name AS nome_completo, {NONE} AS nome_citacao, 'Country ' || nation AS nacionalidade,
           {NONE} AS pais_nascimento, {NONE} AS uf_nascimento, 'São Luís' AS cidade_nascimento,
           CASE WHEN c_custkey % 5 < 2 THEN '31122019'
                ELSE strftime(DATE '2020-01-01' + CAST(c_custkey % 1500 AS INTEGER), '%d%m%Y')
             END AS data_atualizacao,
           '101112' AS data_hora_atualizacao, {NONE} AS sigla_pais_nacionalidade,
           CASE WHEN c_custkey % 3 <> 0
                THEN ' <' || c_name || '> & "' || c_mktsegment || '" é ' END AS texto_resumo_cv,
           CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS instituicao_empresa,
           CASE WHEN c_custkey % 6 <> 0 THEN CAST(c_custkey % 100 AS VARCHAR) END
             AS codigo_instituicao,
           {NONE} AS nome_orgao, {NONE} AS nome_unidade, {NONE} AS logradouro, {NONE} AS pais,
           {NONE} AS uf, {NONE} AS cidade, {NONE} AS bairro,
           CASE WHEN c_custkey % 6 <> 0 THEN 'mail' || c_custkey || '@example.org' END AS email,
           {NONE} AS home_page
    FROM ({CV}) cv
"""

EDUCATION = f"""
    WITH cv AS (SELECT * FROM ({CV}) WHERE c_custkey % 8 <> 0),
    kinds AS (
      SELECT cv.*, 'GRADUACAO' AS kind, n FROM cv JOIN range(1, 10) r(n) ON n <= c_custkey % 3
      UNION ALL
      SELECT cv.*, 'MESTRADO' AS kind, n FROM cv JOIN range(1, 10) r(n) ON n <= nation % 2
      UNION ALL
      SELECT cv.*, 'DOUTORADO' AS kind, n FROM cv JOIN range(1, 10) r(n) ON n <= c_custkey % 2
      UNION ALL
      SELECT cv.*, 'POS-DOUTORADO' AS kind, n FROM cv JOIN range(1, 10) r(n) ON n <= nation % 3)
    SELECT kind AS tipo_formacao,
           CASE kind WHEN 'GRADUACAO' THEN 'c ' || c_custkey || '/' || n END AS codigo_curso,
           CASE kind WHEN 'GRADUACAO' THEN 'Course' WHEN 'MESTRADO' THEN 'Master'
                     WHEN 'DOUTORADO' THEN 'Doctor' END || ' ' || c_custkey || '/' || n
             AS nome_curso,
           {NONE} AS codigo_instituicao, {NONE} AS nome_instituicao,
           CASE kind WHEN 'GRADUACAO' THEN 's' WHEN 'POS-DOUTORADO' THEN 'stage' END
             || ' ' || c_custkey || '/' || n AS status,
           {NONE} AS ano_inicio, {NONE} AS ano_conclusao,
           CASE kind WHEN 'GRADUACAO' THEN 'Work ' || c_custkey || '/' || n END
             AS titulo_trabalho,
           CASE kind WHEN 'MESTRADO' THEN 'Dissertation ' || c_custkey || '/' || n END
             AS titulo_dissertacao,
           CASE kind WHEN 'DOUTORADO' THEN 'Thesis ' || c_custkey || '/' || n END AS titulo_tese,
           CASE WHEN kind <> 'POS-DOUTORADO' THEN 'Advisor ' || c_custkey || '/' || n END
             AS nome_orientador,
           {NONE} AS codigo_agencia_financiadora,
           CASE WHEN kind IN ('MESTRADO', 'POS-DOUTORADO')
                THEN 'Agency ' || c_custkey || '/' || n END AS nome_agencia,
           lattes_id
    FROM kinds
"""

AREAS = f"""
    SELECT 'n ' || c_custkey || '/' || n AS sequencia,
           'Field ' || c_custkey || '/' || n AS nome_grande_area, {NONE} AS codigo_grande_area,
           {NONE} AS nome_area, {NONE} AS codigo_area, {NONE} AS nome_sub_area,
           {NONE} AS codigo_sub_area, 'Topic ' || c_custkey || '/' || n AS nome_especialidade,
           {NONE} AS codigo_especialidade, lattes_id
    FROM ({CV}) cv JOIN range(1, 10) r(n) ON n <= c_custkey % 4
    WHERE c_custkey % 9 <> 0
"""


def _parsed(spark, sf_dir):
    return curriculum.parse_documents(cv_documents(spark, sf_dir))


@query("xml_attribute_extract", RESEARCHERS)
def xml_attribute_extract(spark, sf_dir):
    return curriculum.researcher_rows(_parsed(spark, sf_dir))


@query("xml_repeated_children", AREAS)
def xml_repeated_children(spark, sf_dir):
    return curriculum.area_rows(_parsed(spark, sf_dir))


@query("union_unlike_shapes", EDUCATION)
def union_unlike_shapes(spark, sf_dir):
    return curriculum.education_rows(_parsed(spark, sf_dir))


@query(
    "xml_reject_malformed",
    """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 16, '0')
             || CASE WHEN c_custkey % 50 = 49 THEN '.XML' ELSE '.xml' END AS entry,
           'malformed XML' AS reject
    FROM customer WHERE c_custkey % 7 = 3
    """,
)
def xml_reject_malformed(spark, sf_dir):
    return curriculum.rejected(_parsed(spark, sf_dir)).select("entry", "reject")


_SHAPED = f"""
    SELECT *, c_custkey % 10 AS shape,
           c_custkey % 8 <> 0
             AND (c_custkey % 3 > 0 OR nation % 2 > 0 OR c_custkey % 2 > 0 OR nation % 3 > 0) AS degrees,
           c_custkey % 9 <> 0 AND c_custkey % 4 > 0 AS areas
    FROM ({CV}) cv
"""


@query(
    "xml_reject_section",
    f"""
    WITH shaped AS ({_SHAPED}),
    bad AS (
      SELECT lattes_id, 'FORMACAO-ACADEMICA-TITULACAO' AS section,
             CASE shape WHEN 4 THEN 'text in place of entries'
                        ELSE 'text in place of an entry''s attributes' END AS reason
      FROM shaped WHERE shape IN (4, 8) AND degrees
      UNION ALL
      SELECT lattes_id, 'AREAS-DE-ATUACAO', 'section occurs twice' FROM shaped WHERE shape = 6 AND areas),
    education AS (SELECT lattes_id, count(*) AS n FROM ({EDUCATION}) e GROUP BY 1),
    area AS (SELECT lattes_id, count(*) AS n FROM ({AREAS}) a GROUP BY 1)
    SELECT s.lattes_id, b.section, b.reason,
           CASE WHEN b.section LIKE 'FORMACAO%' THEN 0 ELSE coalesce(e.n, 0) END AS degrees,
           CASE WHEN b.section LIKE 'AREAS%' THEN 0 ELSE coalesce(a.n, 0) END AS areas
    FROM shaped s LEFT JOIN bad b USING (lattes_id)
    LEFT JOIN education e USING (lattes_id) LEFT JOIN area a USING (lattes_id)
    """,
)
def xml_reject_section(spark, sf_dir):
    """Every researcher, the section of theirs that could not be read, and the rows of the others."""
    staged = stage_documents(spark, odd_section_documents(spark, sf_dir))
    key = F.substring_index("entry", ".", 1)
    rejects = curriculum.rejected(staged).where("section IS NOT NULL")
    rejects = rejects.select(key.alias("lattes_id"), "section", F.col("reject").alias("reason"))
    found = curriculum.researcher_rows(staged).select("lattes_id").join(rejects, "lattes_id", "left")
    children = {"degrees": curriculum.education_rows(staged), "areas": curriculum.area_rows(staged)}
    for name, rows in children.items():
        counts = rows.groupBy("lattes_id").agg(F.count(F.lit(1)).alias(name))
        found = found.join(counts, "lattes_id", "left")
    return found.fillna(0, list(children))


# --- Archives -----------------------------------------------------------------------------


def _archives(spark, sf_dir) -> str:
    folder = scratch_location(spark, "archives")
    write_archives(cv_documents(spark, sf_dir), folder)
    return folder


@query(
    "archive_scan",
    """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 16, '0') || '.xml' AS entry,
           c_custkey % 7 = 3 AS cut, true AS readable
    FROM customer WHERE c_custkey % 50 <> 49
    """,
)
def archive_scan(spark, sf_dir):
    documents = archive.read_archives(spark, _archives(spark, sf_dir))
    return documents.select(
        "entry",
        (~F.endswith("xml", F.lit("</CURRICULO-VITAE>"))).alias("cut"),
        (F.col("error").isNull() & F.contains("xml", F.lit("São Luís"))).alias("readable"),
    )


def _bronze(spark, sf_dir) -> Lake:
    lake = scratch_location(spark, "lake")
    curricula_to_bronze(spark, _archives(spark, sf_dir), lake, DAY_1)
    return Lake(lake)


_IN_ARCHIVE = "CAST(lattes_id AS BIGINT) % 50 <> 49"


@query("landing_to_bronze", f"SELECT * FROM ({RESEARCHERS}) WHERE {_IN_ARCHIVE}")
def landing_to_bronze(spark, sf_dir):
    lake = _bronze(spark, sf_dir)
    return snapshots.read_snapshot(spark, lake.bronze_researchers, DAY_1)


@query(
    "landing_to_bronze_children",
    f"""
    SELECT 'education' AS child, lattes_id, tipo_formacao AS kind, count(*) AS n
    FROM ({EDUCATION}) WHERE {_IN_ARCHIVE} GROUP BY ALL
    UNION ALL
    SELECT 'areas', lattes_id, NULL, count(*) FROM ({AREAS}) WHERE {_IN_ARCHIVE} GROUP BY ALL
    UNION ALL
    SELECT 'rejects', lpad(CAST(c_custkey AS VARCHAR), 16, '0'), 'malformed XML', 1
    FROM customer WHERE c_custkey % 7 = 3 AND c_custkey % 50 <> 49
    """,
)
def landing_to_bronze_children(spark, sf_dir):
    lake = _bronze(spark, sf_dir)
    education = snapshots.read_snapshot(spark, lake.bronze_education, DAY_1)
    areas = snapshots.read_snapshot(spark, lake.bronze_areas, DAY_1)
    rejects = snapshots.read_snapshot(spark, lake.bronze_rejects, DAY_1)
    rows = (
        education.select(
            F.lit("education").alias("child"), "lattes_id", F.col("tipo_formacao").alias("kind")
        )
        .unionByName(
            areas.select(
                F.lit("areas").alias("child"),
                "lattes_id",
                F.lit(None).cast("string").alias("kind"),
            )
        )
        .unionByName(
            rejects.select(
                F.lit("rejects").alias("child"),
                F.substring_index("entry", ".", 1).alias("lattes_id"),
                F.col("reject").alias("kind"),
            )
        )
    )
    return rows.groupBy("child", "lattes_id", "kind").agg(F.count("*").alias("n"))


@query("documents_to_bronze", RESEARCHERS)
def documents_to_bronze(spark, sf_dir):
    """The landing job for documents that lie in a table, one row each."""
    lake = scratch_location(spark, "lake")
    bronze_of_documents(spark, cv_documents(spark, sf_dir), lake, DAY_1)
    return snapshots.read_snapshot(spark, Lake(lake).bronze_researchers, DAY_1)


@query(
    "documents_to_bronze_children",
    f"""
    SELECT 'education' AS child, lattes_id, count(*) AS n FROM ({EDUCATION}) e GROUP BY lattes_id
    UNION ALL SELECT 'areas', lattes_id, count(*) FROM ({AREAS}) a GROUP BY lattes_id
    UNION ALL SELECT 'rejects', lpad(CAST(c_custkey AS VARCHAR), 16, '0'), 1
    FROM customer WHERE c_custkey % 7 = 3
    """,
)
def documents_to_bronze_children(spark, sf_dir):
    """The other tables of that job: rows of each document."""
    lake = Lake(scratch_location(spark, "lake"))
    bronze_of_documents(spark, cv_documents(spark, sf_dir), lake.bronze_areas.base, DAY_1)
    key = F.substring_index("entry", ".", 1).alias("lattes_id")
    found = None
    for name, target, of in (
        ("education", lake.bronze_education, F.col("lattes_id")),
        ("areas", lake.bronze_areas, F.col("lattes_id")),
        ("rejects", lake.bronze_rejects, key),
    ):
        rows = snapshots.read_snapshot(spark, target, DAY_1).select(F.lit(name).alias("child"), of)
        found = rows if found is None else found.unionByName(rows)
    return found.groupBy("child", "lattes_id").agg(F.count(F.lit(1)).alias("n"))


# --- API pages ----------------------------------------------------------------------------


@query(
    "page_plan",
    """
    SELECT c.c_custkey, p.page
    FROM (SELECT c_custkey, count(o_orderkey) AS n
          FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) c
    JOIN LATERAL (SELECT unnest(generate_series(1, CAST(ceil(c.n / 10.0) AS BIGINT))) AS page) p
      ON c.n > 0
    """,
)
def page_plan(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    counts = customers.join(orders.agg(F.count("*").alias("n")), "c_custkey", "left")
    planned = paging.plan_pages(counts.withColumn("per_page", F.lit(10)), "n")
    return planned.select("c_custkey", "page")


ORDER_RECORD = S.record(
    id=S.WHOLE, customer=S.WHOLE, status=S.TEXT, priority=S.TEXT, absent=S.TEXT
)


def order_records(spark, sf_dir):
    record = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customer"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_totalprice").alias("not_selected"),
        )
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("key"),
        F.col("o_orderkey").alias("id"),
        record.alias("record"),
    )


def order_requests(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return paging.batch_requests(
        customers, "c_custkey", "customer", "/orders", "id,customer,status,priority", per_page=100
    )


@query(
    "page_requests",
    """
    WITH numbered AS (SELECT key, row_number() OVER (
                        ORDER BY CAST('0x' || substr(md5(key), 1, 8) AS BIGINT), key) AS n
                      FROM (SELECT CAST(c_custkey AS VARCHAR) AS key FROM customer))
    SELECT '/orders' AS endpoint, 'customer:' || string_agg(key, '|' ORDER BY key) AS "filter",
           'id,customer,status,priority' AS "select", 100 AS per_page,
           CAST(1 AS BIGINT) AS page
    FROM numbered GROUP BY (n - 1) // 50
    """,
)
def page_requests(spark, sf_dir):
    """The first request of each batch of keys: its filter, field list and page."""
    return order_requests(spark, sf_dir)


@query(
    "page_meta_count",
    """
    SELECT c_custkey, count(o_orderkey) AS total,
           CAST(ceil(count(o_orderkey) / 10.0) AS BIGINT) AS pages
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
    """,
)
def page_meta_count(spark, sf_dir):
    """Page bodies that report their count; customers without orders report none."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    counts = table(spark, sf_dir, "customer").select("c_custkey")
    counts = counts.join(orders.agg(F.count("*").alias("n")), "c_custkey", "left")
    meta = F.coalesce(text('"meta":{"count":', F.col("n"), "},"), F.lit(""))
    bodies = counts.select("c_custkey", text("{", meta, '"results":[]}').alias("body"))
    total = paging.meta_count(F.col("body"))
    return bodies.select(
        "c_custkey", total.alias("total"), paging.page_count(total, 10).alias("pages")
    )


_ORDERS = """
    SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status,
           o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS absent
    FROM orders
"""


def _fetched_orders(spark, sf_dir, **options):
    respond = table_service(order_records(spark, sf_dir), **options)
    staging = scratch_location(spark, "order-pages")
    pages = paging.fetch_all_pages(order_requests(spark, sf_dir), respond, staging)
    return paging.page_records(pages, ORDER_RECORD)


@query("paged_fetch", _ORDERS)
def paged_fetch(spark, sf_dir):
    """A service that never fails, asked once per page."""
    return _fetched_orders(spark, sf_dir, attempts=1)


@query("paged_fetch_retry", _ORDERS)
def paged_fetch_retry(spark, sf_dir):
    """A service that fails up to five times per page."""
    return _fetched_orders(spark, sf_dir, faults=True)


@query(
    "json_results_explode",
    """
    SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, props AS raw
    FROM events
    """,
)
def json_results_explode(spark, sf_dir):
    """Events as pages of one record each: text, a nested record and the same as raw JSON."""
    body = F.concat(
        F.lit('{"meta":{"count":1},"results":[{"event_id":'),
        F.col("event_id"),
        F.lit(',"event_type":"'),
        F.col("event_type"),
        F.lit('","props":'),
        F.col("props"),
        F.lit(',"raw":'),
        F.to_json(F.struct("props")),
        F.lit("}]}"),
    )
    event = S.record(
        event_id=S.WHOLE,
        event_type=S.TEXT,
        props=S.record(k=S.WHOLE),
        raw=S.record(props=S.TEXT),
    )
    pages = table(spark, sf_dir, "events").select(body.alias("body"))
    return paging.page_records(pages, event).select(
        "event_id", "event_type", F.col("props.k").alias("k"), F.col("raw.props").alias("raw")
    )


# What the pages of events are read as: one field of another kind, two that nothing holds.
NARROW_EVENT = S.record(event_id=S.WHOLE, event_type=S.WHOLE, props=S.record(z=S.TEXT), absent=S.FLAG)


def _event_pages(spark, sf_dir):
    """Events as pages of one record each; every third has a list and every fifth a null more."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "k BIGINT").alias("props"), "user_id"
    )
    tags = F.when(F.col("event_id") % 3 == 0, F.array("event_type"))
    note = F.when(F.col("event_id") % 5 == 0, F.lit(',"note":null')).otherwise("")
    record = F.to_json(F.struct("event_id", "event_type", "props", tags.alias("tags")))
    body = text('{"results":[', F.expr("left(rec, length(rec) - 1)"), F.col("note"), "}]}")
    return events.select(record.alias("rec"), note.alias("note")).select(body.alias("body"))


@query(
    "schema_drift",
    """
    WITH fields AS (
      SELECT 'event_id' AS path, 'whole' AS kind FROM events
      UNION ALL SELECT 'event_type', 'text' FROM events
      UNION ALL SELECT 'props', 'object' FROM events
      UNION ALL SELECT 'props.' || key,
             CASE json_type(props, '$.' || key) WHEN 'UBIGINT' THEN 'whole' WHEN 'BIGINT' THEN 'whole'
                  WHEN 'VARCHAR' THEN 'text' WHEN 'DOUBLE' THEN 'number' END
        FROM (SELECT props, unnest(json_keys(props)) AS key FROM events)
      UNION ALL SELECT 'tags', 'list' FROM events WHERE event_id % 3 = 0
      UNION ALL SELECT 'note', 'null' FROM events WHERE event_id % 5 = 0),
    declared(path, declared) AS (
      VALUES ('event_id', 'whole'), ('event_type', 'whole'), ('props', 'object'), ('props.z', 'text'),
             ('absent', 'flag')),
    seen AS (SELECT path, kind, count(*) AS records FROM fields GROUP BY path, kind)
    SELECT coalesce(s.path, d.path) AS path, kind, declared, coalesce(records, 0) AS records,
           CASE WHEN declared IS NULL THEN 'unknown' WHEN kind IS NULL THEN 'missing'
                WHEN kind = declared THEN 'as declared' ELSE 'other kind' END AS status
    FROM seen s FULL JOIN declared d ON s.path = d.path
    """,
)
def schema_drift(spark, sf_dir):
    """Fields of the pages that no schema names, of another kind, or that nothing holds."""
    return drift.field_report(drift.record_variants(_event_pages(spark, sf_dir)), NARROW_EVENT)


@query(
    "undeclared_fields_kept",
    """
    SELECT event_id, CAST(NULL AS BOOLEAN) AS absent,
           CASE WHEN event_id % 3 = 0 THEN event_type END AS first_tag,
           event_id % 3 = 0 OR event_id % 5 = 0 AS has_rest
    FROM events
    """,
)
def undeclared_fields_kept(spark, sf_dir):
    """The declared fields, and out of the variant column what the schema does not name."""
    records = drift.page_records_with_rest(_event_pages(spark, sf_dir), NARROW_EVENT)
    tag = F.try_variant_get("rest", "$.tags[0]", "string")
    return records.select(
        "event_id", "absent", tag.alias("first_tag"), F.col("rest").isNotNull().alias("has_rest")
    )


@query(
    "landed_orders",
    f"""
    SELECT o.*, totals.total FROM ({_ORDERS}) o
    JOIN (SELECT o_custkey, count(*) AS total FROM orders GROUP BY o_custkey) totals
      ON o.customer = totals.o_custkey
    """,
)
def landed_orders(spark, sf_dir):
    """Orders out of landed pages of ten for each customer, with the count that the pages report."""
    orders = table(spark, sf_dir, "orders")
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    numbered = order_records(spark, sf_dir).join(
        orders.select(F.col("o_orderkey").alias("id"), place.alias("number")), "id"
    )
    pages = landed_pages(
        spark, numbered.select(text("customer:", F.col("key")).alias("filter"), "number", "record"), 10, "order-bodies"
    )
    records = paging.page_records(pages, ORDER_RECORD)
    counts = pages.where("page = 1").select(
        F.substring_index("filter", ":", -1).cast("long").alias("customer"),
        paging.meta_count(F.col("body")).alias("total"),
    )
    return records.join(counts, "customer").select(*ORDER_RECORD.names, "total")


@query(
    "landed_works",
    f"""
    SELECT id, doi, display_name, title, n_chars AS cited_by_count, type,
           CASE WHEN doc_id % 17 <> 0 THEN abstract END AS abstract, n_authors
    FROM ({WORKS_WITH_ABSTRACT})
    WHERE n_authors > 0 AND EXISTS (SELECT 1 FROM range(5) r(place)
                                    WHERE place < n_authors AND (doc_id + place) % 9 <> 0)
    """,
)
def landed_works(spark, sf_dir):
    """Works out of landed pages of a hundred for each batch of 50 authors; a work is on the pages of
    every batch that holds one of its authors, and comes once."""
    works = bronze_works(spark, sf_dir, encoded=False)
    batch = F.floor(F.substring_index("author", "/A", -1).cast("long") / 50)
    # Told before the authors are listed, or each of them would have the record made anew.
    served = works.select("id", F.to_json(F.struct(*works.columns)).alias("record"), "authorships.author.id")
    served = served.toDF("id", "record", "authors").select("id", "record", F.explode("authors").alias("author"))
    served = served.where("author IS NOT NULL").groupBy(batch.alias("batch"), "id").agg(F.first("record").alias("record"))
    place = F.row_number().over(Window.partitionBy("batch").orderBy("id")) - 1
    numbered = served.select(text("author.id:", F.col("batch")).alias("filter"), place.alias("number"), "record")
    bronze = work_jobs.works_of_pages(landed_pages(spark, numbered, 100, "work-bodies"))
    return bronze.select(
        "id",
        "doi",
        "display_name",
        "title",
        "cited_by_count",
        "type",
        text_from_inverted_index(F.col("abstract_inverted_index")).alias("abstract"),
        F.coalesce(F.size("authorships"), F.lit(0)).cast("bigint").alias("n_authors"),
    )


@query(
    "authors_to_bronze",
    f"""
    SELECT 'https://api.example.org/' || openalex_id AS id, orcid_id AS orcid,
           indice_h AS h_index, indice_i10 AS i10_index, qtd_producoes AS works_count,
           qtd_citacoes_pesquisador AS cited_by_count, works_api_url
    FROM ({AUTHORS})
    WHERE orcid_id IN (SELECT 'https://orcid.example.org/' || c_custkey FROM customer
                       WHERE c_custkey % 4 <> 3)
    """,
)
def authors_to_bronze(spark, sf_dir):
    """Ask for the authors of all customers that have an ORCID."""
    lake = scratch_location(spark, "lake")
    # Only the key matters here; the other columns of the contract stay null.
    researchers = bronze_researchers(spark, sf_dir)
    absent = [name for name in S.RESEARCHER_COLUMNS if name not in researchers.columns]
    researchers = researchers.withColumns({n: F.lit(None).cast("string") for n in absent})
    snapshots.write_snapshot(researchers, Lake(lake).bronze_researchers, DAY_1)
    authors = bronze_authors(spark, sf_dir)
    served = authors.select(
        F.col("orcid").alias("key"), "id", F.to_json(F.struct(*authors.columns)).alias("record")
    )
    respond = table_service(served, faults=True)
    bronze = author_jobs.authors_to_bronze(spark, lake, DAY_2, respond)
    return bronze.select(
        "id",
        "orcid",
        "summary_stats.*",
        "works_count",
        "cited_by_count",
        "works_api_url",
    )


@query(
    "works_to_bronze",
    f"""
    SELECT id, doi, display_name, title, n_chars AS cited_by_count, type,
           CASE WHEN doc_id % 17 <> 0 THEN abstract END AS abstract, n_authors
    FROM ({WORKS_WITH_ABSTRACT})
    WHERE type IN ('book', 'book-chapter', 'article')
      AND EXISTS (SELECT 1 FROM supplier, range(5) r(place)
                  WHERE place < n_authors AND (doc_id + place) % 9 <> 0
                    AND s_suppkey = doc_id // 10 + place * 3)
    """,
)
def works_to_bronze(spark, sf_dir):
    """Ask for the works of all suppliers; co-authored ones come back in several batches."""
    lake = scratch_location(spark, "lake")
    authors = author_jobs.silver_authors(bronze_authors(spark, sf_dir), RUN_AT)
    snapshots.write_snapshot(authors, Lake(lake).silver_authors, DAY_1)
    works = bronze_works(spark, sf_dir, encoded=False)
    works = works.where(F.col("type").isin(*work_jobs.WORK_TYPES))
    # Told before the authors are listed, or each of them would have the record made anew.
    served = works.select("id", F.to_json(F.struct(*works.columns)).alias("record"), "authorships.author.id")
    served = served.toDF("id", "record", "authors").select("id", "record", F.explode("authors").alias("author"))
    served = served.select(F.substring_index("author", "/", -1).alias("key"), "id", "record")
    bronze = work_jobs.works_to_bronze(spark, lake, DAY_2, table_service(served, faults=True))
    return bronze.select(
        "id",
        "doi",
        "display_name",
        "title",
        "cited_by_count",
        "type",
        text_from_inverted_index(F.col("abstract_inverted_index")).alias("abstract"),
        F.coalesce(F.size("authorships"), F.lit(0)).cast("bigint").alias("n_authors"),
    )


def _stored_works(spark, sf_dir) -> str:
    """A lake that holds bronze works."""
    lake = scratch_location(spark, "lake")
    snapshots.write_snapshot(bronze_works(spark, sf_dir), Lake(lake).bronze_works, DAY_1)
    return lake


@query("works_to_silver", SILVER_WORKS)
def works_to_silver(spark, sf_dir):
    """The job: copies are found by their places in the stored works."""
    works, _ = work_jobs.works_to_silver(spark, _stored_works(spark, sf_dir), DAY_2, RUN_AT, DAY_1)
    return works_as_text(works)


@query("works_to_silver_bridge", BRIDGE_TEXT)
def works_to_silver_bridge(spark, sf_dir):
    """The job's other output."""
    _, bridge = work_jobs.works_to_silver(spark, _stored_works(spark, sf_dir), DAY_2, RUN_AT, DAY_1)
    return flags_as_text(bridge)


# --- Snapshots ----------------------------------------------------------------------------

ORDERS_SCHEMA = S.record(o_orderkey=S.WHOLE, o_custkey=S.WHOLE, o_orderstatus=S.TEXT)


def _order_snapshots(spark, sf_dir) -> snapshots.Table:
    """Orders as of day 1 (without pending ones), all of them on day 2, none on day 3."""
    orders = table(spark, sf_dir, "orders").select(*ORDERS_SCHEMA.names)
    target = snapshots.Table(
        scratch_location(spark, "lake"), snapshots.SILVER, "shop", "orders", ORDERS_SCHEMA
    )
    snapshots.write_snapshot(orders.where("o_orderstatus <> 'P'"), target, DAY_1)
    snapshots.write_snapshot(orders.where("o_orderstatus = 'P'"), target, DAY_2)
    snapshots.write_snapshot(orders, target, DAY_2)
    snapshots.write_snapshot(orders.where("o_orderkey IS NULL"), target, DAY_3)
    return target


@query("snapshot_write_read", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def snapshot_write_read(spark, sf_dir):
    """A second write of the same day replaces the first."""
    return snapshots.read_snapshot(spark, _order_snapshots(spark, sf_dir), DAY_2)


@query(
    "snapshot_read",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
)
def snapshot_read(spark, sf_dir):
    """One named day, through a narrower schema."""
    narrow = S.record(o_orderkey=S.WHOLE, o_orderstatus=S.TEXT)
    return snapshots.read_snapshot(spark, _order_snapshots(spark, sf_dir), DAY_1, narrow)


@query(
    "snapshot_latest",
    """
    SELECT '2024-05-05' AS as_of, o_orderkey FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT '2024-05-09', o_orderkey FROM orders
    """,
)
def snapshot_latest(spark, sf_dir):
    target = _order_snapshots(spark, sf_dir)
    days = [date(2024, 5, 5), DAY_2]
    found = [
        snapshots.read_latest(spark, target, day).select(
            F.lit(day.isoformat()).alias("as_of"), "o_orderkey"
        )
        for day in days
    ]
    return found[0].unionByName(found[1])


@query("snapshot_failed_rerun", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def snapshot_failed_rerun(spark, sf_dir):
    """A rerun of day 2 that fails at its pending orders leaves what was published before."""
    target = _order_snapshots(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(*ORDERS_SCHEMA.names)
    pending = F.when(F.col("o_orderstatus") == "P", F.raise_error(F.lit("a pending order")))
    broken = orders.withColumn("o_orderstatus", F.coalesce(pending, "o_orderstatus"))
    try:
        snapshots.write_snapshot(broken, target, DAY_2)
    except Exception as error:
        if "a pending order" not in str(error):
            raise
    return snapshots.read_snapshot(spark, target, DAY_2)


@query(
    "snapshot_counts",
    """
    SELECT '2024-05-01' AS day, count(*) AS rows, CAST(1 AS BIGINT) AS version
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT '2024-05-09', count(*), 2 FROM orders
    UNION ALL SELECT '2024-06-01', 0, 1
    """,
)
def snapshot_counts(spark, sf_dir):
    """Rows of each day and how often it was published, out of the manifests."""
    target = _order_snapshots(spark, sf_dir)
    manifests = [(day, snapshots.published(spark, target, day)) for day in (DAY_1, DAY_2, DAY_3)]
    return spark.createDataFrame(
        [(day.isoformat(), told.rows, told.version) for day, told in manifests],
        "day string, rows long, version long",
    )


@query(
    "semi_join_keyed_snapshot",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_orderstatus IN ('F', 'O')
      AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 9900)
    """,
)
def semi_join_keyed_snapshot(spark, sf_dir):
    """Few customers' orders out of a snapshot that is kept in order of its customers."""
    target = snapshots.Table(
        scratch_location(spark, "lake"), snapshots.SILVER, "shop", "orders", ORDERS_SCHEMA, key="o_custkey"
    )
    orders = table(spark, sf_dir, "orders").select(*ORDERS_SCHEMA.names)
    snapshots.write_snapshot(orders, target, DAY_1)
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 9900")
    kept = snapshots.read_snapshot(spark, target, DAY_1).where("o_orderstatus IN ('F', 'O')")
    return joins.key_filter(kept, rich.select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@query(
    "guard_nonempty",
    """
    SELECT o_orderkey, o_orderstatus, true AS empty_stops, true AS missing_stops FROM orders
    """,
)
def guard_nonempty(spark, sf_dir):
    target = _order_snapshots(spark, sf_dir)
    full, empty, missing = (
        snapshots.guard_nonempty(snapshots.read_latest(spark, target, day))
        for day in (DAY_2, DAY_3, date(2023, 1, 1))
    )
    return full.select(
        "o_orderkey",
        "o_orderstatus",
        F.lit(empty is None).alias("empty_stops"),
        F.lit(missing is None).alias("missing_stops"),
    )
