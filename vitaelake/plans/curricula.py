"""CV archives to the bronze researcher, education and area tables."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.operators import curriculum
from vitaelake.plans.lake import Lake, report
from vitaelake.session import drop_scratch, scratch_location
from vitaelake.sources.archive import read_archives
from vitaelake.sources.snapshots import Manifest, Table, file_rows, write_counted


def stage_documents(
    spark: SparkSession, documents: DataFrame, folder: str | None = None
) -> DataFrame:
    """Parse the documents once and keep the result as a table the three outputs read.

    A written table survives lost executors and lets each output read only its own columns.
    The text itself is kept for documents alone that are rejected, in whole or in part.
    """
    parsed = curriculum.parse_documents(documents)
    odd = F.col("reject").isNotNull() | (F.size("bad_sections") > 0)
    parsed = parsed.withColumn("xml", F.when(odd, F.col("xml")))
    folder = folder or scratch_location(spark, "documents")
    parsed.write.parquet(folder)
    return spark.read.schema(parsed.schema).parquet(folder)


def curricula_to_bronze(
    spark: SparkSession, archives: str, base: str, run_date: date, pattern: str = "*.zip"
) -> dict[str, str]:
    """``documents_to_bronze`` for the documents in zip archives."""
    return documents_to_bronze(spark, read_archives(spark, archives, pattern), base, run_date)


def documents_to_bronze(
    spark: SparkSession, documents: DataFrame, base: str, run_date: date
) -> dict[str, str]:
    """Landing to bronze for documents (``path``, ``entry``, ``xml``, ``error``; all but ``xml`` may be
    absent); gives the folders written. An empty table is an empty snapshot, so a rerun of a day
    leaves nothing of the run before.

    Unreadable documents and sections go to the ``rejects`` table with the reason; the others go on.
    """
    lake = Lake(base)
    staging = scratch_location(spark, "documents")
    absent = [name for name in ("path", "entry", "error") if name not in documents.columns]
    documents = documents.withColumns({name: F.lit(None).cast("string") for name in absent})
    staged = stage_documents(spark, documents, staging)
    count = sum(file_rows(spark, staging, staged.schema).values())
    outputs = {
        lake.bronze_researchers: curriculum.researcher_rows(staged),
        lake.bronze_education: curriculum.education_rows(staged),
        lake.bronze_areas: curriculum.area_rows(staged),
        lake.bronze_rejects: curriculum.rejected(staged),
    }

    @inheritable_thread_target(spark)
    def write(table: Table) -> Manifest:
        return write_counted(outputs[table], table, run_date)

    # The outputs are independent, so the last tasks of one overlap the first of the next.
    with ThreadPoolExecutor(len(outputs)) as pool:
        written = dict(zip(outputs, pool.map(write, outputs)))
    drop_scratch(spark, staging)
    rows = {table.entity: manifest.rows for table, manifest in written.items()}
    report("curricula to bronze", {"documents": count}, rows)
    return {table.entity: manifest.folder for table, manifest in written.items()}
