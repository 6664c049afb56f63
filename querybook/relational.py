"""Queries over projections, de-duplication, joins, explodes and key batches."""

from pyspark.sql import functions as F

from querybook.derived import (
    bronze_authors,
    bronze_researchers,
    bronze_works,
    orcid_of_customer,
    table,
    text,
)
from querybook.registry import query
from querybook.sql import AUTHORS, AUTHORSHIPS, DEDUPED, RESEARCHERS, WORKS, WORKS_WITH_ABSTRACT
from vitaelake.operators import dedup, enrich, joins, keys, projection, works
from vitaelake.plans.authors import silver_authors
from vitaelake.plans.gold import gold_works as join_gold
from vitaelake.plans.researchers import add_author_metrics, silver_researchers
from vitaelake.plans.works import silver_bridge, silver_works
from vitaelake.session import scratch_location

from querybook.scalar import RUN_AT


@query(
    "select_rename",
    "SELECT c_name AS nome, c_custkey AS chave, c_mktsegment AS segmento FROM customer",
)
def select_rename(spark, sf_dir):
    names = {
        "c_name": "nome", "c_custkey": "chave", "absent": "ausente", "c_mktsegment": "segmento",
    }
    return projection.select_rename(table(spark, sf_dir, "customer"), names, strict=False)


@query(
    "struct_unnest",
    """
    SELECT s_suppkey, s_suppkey % 60 AS h_index, CAST(s_nationkey AS BIGINT) AS i10_index, s_name
    FROM supplier
    """,
)
def struct_unnest(spark, sf_dir):
    packed = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.struct(
            (F.col("s_suppkey") % 60).alias("h_index"),
            F.col("s_nationkey").cast("bigint").alias("i10_index"),
        ).alias("summary_stats"),
        "s_name",
    )
    return projection.unnest_struct(packed, "summary_stats")


@query(
    "record_merge",
    """
    SELECT c_custkey, c_mktsegment AS place, c_name AS name,
           CAST(c_nationkey AS VARCHAR) AS country
    FROM customer
    """,
)
def record_merge(spark, sf_dir):
    packed = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.lit("replaced").alias("place")).alias("general"),
        F.struct(
            F.col("c_mktsegment").alias("place"), text(F.col("c_nationkey")).alias("country")
        ).alias("address"),
    )
    return projection.merge_records(packed, "general", "address")


@query(
    "sort_nulls_last",
    """
    SELECT o_orderkey, priority,
           row_number() OVER (ORDER BY priority NULLS LAST, o_orderkey) AS position
    FROM (SELECT o_orderkey,
                 CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority FROM orders)
    """,
)
def sort_nulls_last(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
    )
    return dedup.sorted_positions(orders, "priority", "o_orderkey")


@query(
    "first_non_null",
    """
    SELECT first(CASE WHEN event_type <> 'error' THEN event_type END ORDER BY event_id)
             FILTER (event_type <> 'error') AS event_type,
           first(CASE WHEN user_id % 7 = 3 THEN user_id END ORDER BY event_id)
             FILTER (user_id % 7 = 3) AS user_id,
           first(CASE WHEN user_id < 0 THEN props END ORDER BY event_id)
             FILTER (user_id < 0) AS props
    FROM events
    """,
)
def first_non_null(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("user_id") % 7 == 3, F.col("user_id")).alias("user_id"),
        F.when(F.col("user_id") < 0, F.col("props")).alias("props"),
    )
    return dedup.first_non_null(events, ["event_type", "user_id", "props"], "event_id")


@query(
    "dedup_keep_first",
    """
    SELECT doc_id, text, source FROM (
      SELECT doc_id, text, CASE WHEN doc_id % 3 <> 0 THEN source END AS source,
             row_number() OVER (PARTITION BY text
               ORDER BY CASE WHEN doc_id % 3 <> 0 THEN source END NULLS LAST, doc_id) AS n
      FROM documents)
    WHERE n = 1
    """,
)
def dedup_keep_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("source")
    )
    return dedup.keep_first(docs, ["text"], ["source", "doc_id"])


@query(
    "dedup_by_places",
    """
    SELECT doc_id, text, source, lang FROM (
      SELECT *, row_number() OVER (PARTITION BY text ORDER BY source NULLS LAST, doc_id) AS n
      FROM documents)
    WHERE n = 1
    """,
)
def dedup_by_places(spark, sf_dir):
    """The first of equal texts, read around the places of the others in the stored table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    folder = scratch_location(spark, "later")
    dedup.later_copies(docs, ["text"], ["source", "doc_id"]).write.parquet(folder)
    return dedup.without_places(docs, spark.read.parquet(folder))


@query(
    "require_columns",
    "SELECT c_custkey, c_name, true AS absent_stops FROM customer",
)
def require_columns(spark, sf_dir):
    """The input itself where the columns are there; an error that names those that are not."""
    customers = projection.require_columns(table(spark, sf_dir, "customer"), ["c_custkey", "c_name"])
    try:
        projection.require_columns(customers, ["c_name", "absent"])
        stopped = False
    except ValueError as error:
        stopped = "absent" in str(error)
    return customers.select("c_custkey", "c_name", F.lit(stopped).alias("absent_stops"))


@query(
    "dedup_keep_null_keys",
    """
    WITH t AS (SELECT o_orderkey, o_custkey,
                      CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS title
               FROM orders),
         r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, title ORDER BY o_orderkey)
                 AS n FROM t)
    SELECT o_orderkey, o_custkey, title FROM r WHERE n = 1 OR title IS NULL
    """,
)
def dedup_keep_null_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("title"),
    )
    return dedup.keep_first(orders, ["o_custkey", "title"], ["o_orderkey"], keep_null_keys=True)


@query(
    "dedup_counts",
    """
    SELECT count(*) AS rows_before,
           count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS rows_after
    FROM (SELECT CASE WHEN doc_id % 11 <> 0 THEN text END AS text FROM documents)
    """,
)
def dedup_counts(spark, sf_dir):
    title = F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("display_name")
    return dedup.dedup_counts(table(spark, sf_dir, "documents").select(title), ["display_name"])


@query(
    "explode_outer_list",
    f"""
    WITH works AS ({WORKS}), works_authors AS ({AUTHORSHIPS})
    SELECT id, author_position, CAST(is_corresponding AS VARCHAR) AS is_corresponding, nome_autor,
           openalex_autor_id, display_name_author, orcid_id, paises, instituicoes
    FROM works_authors
    """,
)
def explode_outer_list(spark, sf_dir):
    exploded = works.explode_authorships(bronze_works(spark, sf_dir))
    return exploded.select(
        "id",
        "author_position",
        F.col("is_corresponding").cast("string").alias("is_corresponding"),
        "nome_autor",
        "openalex_autor_id",
        "display_name_author",
        "orcid_id",
        F.array_join("paises", "|").alias("paises"),
        F.array_join("instituicoes.id", "|").alias("instituicoes"),
    )


BRIDGE = f"""
    WITH works AS ({DEDUPED}), works_authors AS ({AUTHORSHIPS})
    SELECT id AS openalex_producao_id, openalex_autor_id, orcid_id, nome_autor,
           CASE author_position WHEN 'first' THEN 1 WHEN 'middle' THEN 2 WHEN 'last' THEN 3 END
             AS ordem_autoria,
           author_position = 'first' AS autor_principal,
           is_corresponding AS correspondente,
           affiliations AS afiliacao_autor
    FROM works_authors
"""

_BRIDGE_COLUMNS = """openalex_producao_id, openalex_autor_id, orcid_id, nome_autor, ordem_autoria,
    CAST(autor_principal AS VARCHAR) AS autor_principal,
    CAST(correspondente AS VARCHAR) AS correspondente, afiliacao_autor"""


def flags_as_text(df):
    flags = [name for name, kind in df.dtypes if kind == "boolean"]
    return df.withColumns({name: F.col(name).cast("string") for name in flags})


BRIDGE_TEXT = f"SELECT {_BRIDGE_COLUMNS} FROM ({BRIDGE})"


@query("author_work_bridge", BRIDGE_TEXT)
def author_work_bridge(spark, sf_dir):
    return flags_as_text(silver_bridge(bronze_works(spark, sf_dir)))


SILVER_WORKS = f"""
    WITH works AS ({WORKS_WITH_ABSTRACT}), deduped AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY display_name
                                ORDER BY doi NULLS LAST, id) AS n FROM works) WHERE n = 1)
    SELECT id AS openalex_id, doi, title AS titulo, publication_year AS ano_publicacao,
           strftime(publication_day, '%d/%m/%Y') AS data_publicacao, type AS tipo_producao,
           lang AS idioma, abstract, n_chars AS qtd_citacoes_producao,
           doc_id % 40 AS qtd_referencias_producao,
           CASE WHEN doc_id % 5 <> 0 AND doc_id % 7 <> 0 THEN source END AS journal_name,
           CASE WHEN doc_id % 5 <> 0 AND doc_id % 7 <> 0 THEN '1234-' || (doc_id % 90 + 10) END
             AS issn,
           CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE lang || '|<null>|' || source END
             AS palavras_chave,
           strftime(DATE '2010-01-01' + CAST(doc_id % 5000 AS INTEGER), '%d/%m/%Y')
             AS created_at,
           '2024-05-24 09:30:15' AS updated_at
    FROM deduped
"""


def works_as_text(silver):
    return silver.withColumns(
        {
            "palavras_chave": F.array_join("palavras_chave", "|", "<null>"),
            "updated_at": F.col("updated_at").cast("string"),
        }
    )


@query("works_silver", SILVER_WORKS)
def works_silver(spark, sf_dir):
    return works_as_text(silver_works(bronze_works(spark, sf_dir), RUN_AT))


@query(
    "authors_silver",
    f"""
    SELECT openalex_id, orcid_id, indice_h, indice_i10, qtd_producoes, qtd_citacoes_pesquisador,
           works_api_url, '2024-05-24 09:30:15' AS updated_at
    FROM ({AUTHORS})
    """,
)
def authors_silver(spark, sf_dir):
    silver = silver_authors(bronze_authors(spark, sf_dir), RUN_AT)
    return silver.withColumn("updated_at", F.col("updated_at").cast("string"))


@query(
    "left_join_enrich",
    f"""
    SELECT r.lattes_id, r.orcid_id, r.nome_completo, a.openalex_id, a.indice_h, a.indice_i10,
           a.qtd_producoes, a.qtd_citacoes_pesquisador
    FROM ({RESEARCHERS}) r LEFT JOIN ({AUTHORS}) a ON r.orcid_id = a.orcid_id
    """,
)
def left_join_enrich(spark, sf_dir):
    researchers = bronze_researchers(spark, sf_dir).select(
        "lattes_id", "orcid_id", "nome_completo"
    )
    return add_author_metrics(researchers, silver_authors(bronze_authors(spark, sf_dir), RUN_AT))


@query(
    "duplicate_keys",
    f"""
    SELECT orcid_id, count(*) AS rows FROM ({AUTHORS})
    WHERE orcid_id IS NOT NULL GROUP BY orcid_id HAVING count(*) > 1
    """,
)
def duplicate_keys(spark, sf_dir):
    return joins.duplicate_keys(silver_authors(bronze_authors(spark, sf_dir), RUN_AT), "orcid_id")


SILVER_RESEARCHERS = f"""
    SELECT r.lattes_id, r.orcid_id, a.openalex_id, r.nome_completo, r.resumo_cv, a.indice_h,
           a.indice_i10, a.qtd_producoes, a.qtd_citacoes_pesquisador, r.nacionalidade,
           r.instituicao_empresa, r.nome_orgao, r.codigo_instituicao,
           strftime(r.updated, '%Y-%m-%d') AS data_atualizacao_lattes,
           '2024-05-24 09:30:15' AS updated_at
    FROM ({RESEARCHERS}) r LEFT JOIN ({AUTHORS}) a ON r.orcid_id = a.orcid_id
"""


def _researchers_as_text(silver):
    return silver.withColumns(
        {
            "data_atualizacao_lattes": F.col("data_atualizacao_lattes").cast("string"),
            "updated_at": F.col("updated_at").cast("string"),
        }
    )


@query("researchers_silver", SILVER_RESEARCHERS)
def researchers_silver(spark, sf_dir):
    authors = silver_authors(bronze_authors(spark, sf_dir), RUN_AT)
    silver = silver_researchers(bronze_researchers(spark, sf_dir), authors, RUN_AT)
    return _researchers_as_text(silver)


GOLD = f"""
    WITH r AS ({SILVER_RESEARCHERS}), b AS ({BRIDGE}), w AS ({SILVER_WORKS})
    SELECT r.lattes_id, r.nome_completo, r.openalex_id, b.openalex_producao_id, b.ordem_autoria,
           CAST(b.autor_principal AS VARCHAR) AS autor_principal,
           CAST(b.correspondente AS VARCHAR) AS correspondente,
           w.titulo, w.ano_publicacao, w.tipo_producao, w.journal_name, w.qtd_citacoes_producao
    FROM r LEFT JOIN b ON string_split(b.openalex_autor_id, '/')[-1] = r.openalex_id
           LEFT JOIN w ON w.openalex_id = b.openalex_producao_id
"""


@query("gold_works", GOLD)
def gold_works(spark, sf_dir):
    authors = silver_authors(bronze_authors(spark, sf_dir), RUN_AT)
    researchers = silver_researchers(bronze_researchers(spark, sf_dir), authors, RUN_AT)
    bronze = bronze_works(spark, sf_dir)
    return flags_as_text(
        join_gold(researchers, silver_bridge(bronze), silver_works(bronze, RUN_AT))
    )


@query(
    "semi_join_pushdown",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_orderstatus IN ('F', 'O')
      AND EXISTS (SELECT 1 FROM customer
                  WHERE c_custkey = o_custkey AND c_mktsegment IN ('BUILDING', 'MACHINERY'))
    """,
)
def semi_join_pushdown(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customers = table(spark, sf_dir, "customer").where(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    )
    kept = orders.where(F.col("o_orderstatus").isin("F", "O"))
    wanted = customers.select(F.col("c_custkey").alias("o_custkey"))
    return joins.semi_join(kept, wanted, "o_custkey").select(*orders.columns)


@query(
    "key_batch_filter",
    """
    WITH keys AS (SELECT DISTINCT 'https://orcid.example.org/' || o_custkey AS key
                  FROM orders WHERE o_custkey % 4 <> 3),
         numbered AS (SELECT key, row_number() OVER (
                        ORDER BY CAST('0x' || substr(md5(key), 1, 8) AS BIGINT), key) AS n
                      FROM keys)
    SELECT (n - 1) // 50 AS batch, string_agg(key, '|' ORDER BY key) AS batch_keys,
           count(*) AS batch_size
    FROM numbered GROUP BY 1
    """,
)
def key_batch_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return keys.key_batches(orders.select(orcid_of_customer().alias("orcid_id")), "orcid_id", 50)


@query(
    "conditional_enrich",
    """
    SELECT doc_id, lang AS language,
           CASE WHEN lang = 'en' THEN '[pt] ' || abstract ELSE abstract END AS resumo_traduzido
    FROM (SELECT doc_id, CASE WHEN doc_id % 9 <> 0 THEN lang END AS lang,
                 CASE WHEN doc_id % 13 <> 0 THEN text END AS abstract FROM documents)
    """,
)
def conditional_enrich(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 9 != 0, F.col("lang")).alias("language"),
        F.when(F.col("doc_id") % 13 != 0, F.col("text")).alias("abstract"),
    )

    def mark(texts: list[str]) -> list[str]:
        return ["[pt] " + one for one in texts]

    return enrich.conditional_enrich(docs, mark, ["doc_id"]).drop("abstract")
