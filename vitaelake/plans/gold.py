"""Gold: researchers with their works, over the bridge."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.functions import last_segment
from vitaelake.operators.joins import duplicate_keys, hot_keys, left_join
from vitaelake.plans.lake import Lake, report
from vitaelake.session import drop_scratch, scratch_location, shuffles_sized_for
from vitaelake.sources.snapshots import open_latest, read_snapshot, with_rows, write_counted


def authored_works(bridge: DataFrame) -> DataFrame:
    """The bridge as it is joined to researchers. It holds full author URLs and the researchers
    short ids, so the bridge side is shortened."""
    return bridge.select(
        last_segment(F.col("openalex_autor_id")).alias("openalex_id"),
        "openalex_producao_id",
        "ordem_autoria",
        "autor_principal",
        "correspondente",
    )


def gold_works(
    researchers: DataFrame,
    bridge: DataFrame,
    works: DataFrame,
    hot_authors: DataFrame | None = None,
    unique_works: bool = False,
) -> DataFrame:
    """One row per researcher and work; a researcher without works keeps one row.

    ``hot_authors``: the hot keys of ``authored_works(bridge)``, where they have been measured;
    ``unique_works``: no work id is there twice.
    """
    who = researchers.select("lattes_id", "nome_completo", "openalex_id")
    what = works.select(
        F.col("openalex_id").alias("openalex_producao_id"),
        "titulo",
        "ano_publicacao",
        "tipo_producao",
        "journal_name",
        "qtd_citacoes_producao",
    )
    authored = left_join(who, authored_works(bridge), "openalex_id", hot=hot_authors)
    return left_join(authored, what, "openalex_producao_id", unique_right=unique_works)


def works_to_gold(
    spark: SparkSession, base: str, run_date: date, as_of: date | None = None
) -> DataFrame | None:
    """Silver to gold; None when a silver table is missing or the researchers are empty."""
    lake = Lake(base)
    day = as_of or run_date
    researchers = with_rows(open_latest(spark, lake.silver_researchers, day))
    bridge = open_latest(spark, lake.silver_bridge, day)
    works = open_latest(spark, lake.silver_works, day)
    if researchers is None or bridge is None or works is None:
        return None
    staging = scratch_location(spark, "hot-authors")
    with shuffles_sized_for(spark, researchers.folder, bridge.folder, works.folder):
        hot_keys(authored_works(bridge.read()), "openalex_id").write.parquet(staging)
        hot = spark.read.parquet(staging)
        repeated = duplicate_keys(works.read(), "openalex_id")
        gold = gold_works(
            researchers.read(), bridge.read(), works.read(), hot, unique_works=repeated.isEmpty()
        )
        written = write_counted(gold, lake.gold_works, run_date)
    drop_scratch(spark, staging)
    read = {"researchers": researchers.rows, "author-work rows": bridge.rows, "works": works.rows}
    report("works to gold", read, {"rows": written.rows})
    return read_snapshot(spark, lake.gold_works, run_date)
