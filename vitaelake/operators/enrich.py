"""Enrichment of texts through an outside service."""

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.operators.joins import left_join

Translate = Callable[[list[str]], list[str]]


def conditional_enrich(
    df: DataFrame,
    translate: Translate,
    spread_by: list[str],
    text: str = "abstract",
    language: str = "language",
    source_language: str = "en",
    output: str = "resumo_traduzido",
    max_parallel: int | None = None,
    per_call: int = 50,
) -> DataFrame:
    """Texts in one language go through ``translate``; others, null language included, stay.

    Only distinct texts of that language reach the service, each once. ``translate`` takes at
    most ``per_call`` texts and returns as many. ``max_parallel`` bounds the concurrent calls.
    Calls are made when the result is computed: write it once rather than compute it twice.
    """
    is_source = F.col(language) == source_language
    texts = df.where(is_source & F.col(text).isNotNull()).select(F.col(text).alias("_key"))
    tasks = max_parallel or df.sparkSession.sparkContext.defaultParallelism

    def translate_batches(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, per_call):
                originals = batch.column("_key").slice(start, per_call)
                translated = pa.array(translate(originals.to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays([originals, translated], ["_key", "_translated"])

    # By a hash of the key: partitioned by the key itself, the distinct texts would count as
    # spread already, and a small number of them would be gathered into fewer tasks.
    dictionary = (
        texts.distinct()
        .repartition(tasks, F.xxhash64("_key"))
        .mapInArrow(translate_batches, "_key STRING, _translated STRING")
    )
    keyed = df.withColumn("_key", F.when(is_source, F.col(text)))
    joined = left_join(keyed, dictionary, "_key", unique_right=True)
    result = F.when(is_source, F.col("_translated")).otherwise(F.col(text))
    return joined.withColumn(output, result).drop("_key", "_translated")
