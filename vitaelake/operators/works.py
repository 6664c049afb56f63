"""Flattening of bibliographic work records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.functions import join_list, project_list, recode
from vitaelake.operators.projection import require_columns

# Place in the author list -> authorship order.
POSITION_ORDER = {"first": 1, "middle": 2, "last": 3}
LEAD_POSITION = "first"


def add_journal(df: DataFrame) -> DataFrame:
    """Journal name, ISSN-L and licence out of ``primary_location``; null where any parent is."""
    require_columns(df, ["primary_location"])
    return df.withColumns(
        {
            "journal_name": F.col("primary_location.source.display_name"),
            "issn_l": F.col("primary_location.source.issn_l"),
            "license": F.col("primary_location.license"),
        }
    )


def add_keyword_names(df: DataFrame) -> DataFrame:
    """``palavras_chave``: the names in the keyword list."""
    require_columns(df, ["keywords"])
    return df.withColumn("palavras_chave", project_list(F.col("keywords"), "display_name"))


def explode_authorships(df: DataFrame) -> DataFrame:
    """One row per authorship with its fields as columns; a work with no authors keeps one row."""
    require_columns(df, ["authorships"])
    exploded = df.withColumn("authorships", F.explode_outer("authorships"))
    fields = {
        "author_position": "author_position",
        "is_corresponding": "is_corresponding",
        "nome_autor": "raw_author_name",
        "raw_affiliation_strings": "raw_affiliation_strings",
        "paises": "countries",
        "instituicoes": "institutions",
        "openalex_autor_id": "author.id",
        "display_name_author": "author.display_name",
        "orcid_id": "author.orcid",
    }
    authorship = df.schema["authorships"].dataType.elementType
    known = set(authorship.names) | {
        f"author.{name}" for name in authorship["author"].dataType.names
    }
    return exploded.withColumns(
        {name: F.col(f"authorships.{path}") for name, path in fields.items() if path in known}
    )


def author_work_bridge(exploded: DataFrame) -> DataFrame:
    """The author-work table out of exploded authorships."""
    position = F.col("author_position")
    return exploded.select(
        F.col("id").alias("openalex_producao_id"),
        "openalex_autor_id",
        "orcid_id",
        "nome_autor",
        recode(position, POSITION_ORDER).alias("ordem_autoria"),
        (position == LEAD_POSITION).alias("autor_principal"),
        F.col("is_corresponding").alias("correspondente"),
        join_list(F.col("raw_affiliation_strings")).alias("afiliacao_autor"),
    )
