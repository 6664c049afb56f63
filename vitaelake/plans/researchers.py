"""Silver researchers: bronze researchers with their author metrics."""

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake import schemas as S
from vitaelake.functions import parse_update_date, run_timestamp
from vitaelake.operators.joins import hot_keys, left_join
from vitaelake.operators.projection import add_if_absent, select_rename
from vitaelake.plans.lake import Lake, report
from vitaelake.session import drop_scratch, scratch_location, shuffles_sized_for
from vitaelake.sources.snapshots import open_latest, read_snapshot, with_rows, write_counted

# The metrics a researcher gets.
METRIC_COLUMNS = [
    "openalex_id", "orcid_id", "indice_h", "indice_i10", "qtd_producoes",
    "qtd_citacoes_pesquisador",
]


def add_author_metrics(
    researchers: DataFrame, authors: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Researchers with the metrics of the author of the same ORCID text, null without one.
    ``hot``: the authors' hot keys, where they have been measured."""
    metrics = authors.select(*METRIC_COLUMNS)
    return left_join(researchers, metrics, "orcid_id", hot=hot)


def silver_researchers(
    researchers: DataFrame,
    authors: DataFrame,
    at: datetime | None = None,
    strict: bool = True,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Researchers with metrics, a real update date and the run time."""
    joined = add_author_metrics(researchers, authors, hot)
    updated = parse_update_date(F.col("data_atualizacao"), strict)
    named = select_rename(joined.withColumn("data_atualizacao", updated), S.RESEARCHER_NAMES)
    return add_if_absent(named, "updated_at", run_timestamp(at))


def researchers_to_silver(
    spark: SparkSession,
    base: str,
    run_date: date,
    at: datetime | None = None,
    as_of: date | None = None,
) -> DataFrame | None:
    """Bronze to silver; None when either input is missing or empty."""
    lake = Lake(base)
    day = as_of or run_date
    researchers = with_rows(open_latest(spark, lake.bronze_researchers, day))
    authors = with_rows(open_latest(spark, lake.silver_authors, day))
    if researchers is None or authors is None:
        return None
    staging = scratch_location(spark, "hot-orcids")
    with shuffles_sized_for(spark, researchers.folder, authors.folder):
        hot_keys(authors.read(), "orcid_id").write.parquet(staging)
        hot = spark.read.parquet(staging)
        silver = silver_researchers(researchers.read(), authors.read(), at, hot=hot)
        written = write_counted(silver, lake.silver_researchers, run_date)
    drop_scratch(spark, staging)
    read = {"researchers": researchers.rows, "authors": authors.rows}
    report("researchers to silver", read, {"researchers": written.rows})
    return read_snapshot(spark, lake.silver_researchers, run_date)
