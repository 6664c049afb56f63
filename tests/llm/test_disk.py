"""What the steps leave on disk, and comparisons that are cut into parts."""

import glob
import time

import pytest
from conftest import rows
from test_ngram_tiles import components_by_hand, template_texts

import corpus_pipeline
import vitaelake
from vitaelake.llm import ngram_join, suffix_dedup
from vitaelake.llm.native import staged
from vitaelake.session import ship_packages


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship_packages(spark, vitaelake)


def shuffle_files(spark):
    disks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = [glob.glob(f"{folder}/**/shuffle_*", recursive=True) for folder in disks.localDirsString()]
    return {name for names in found for name in names}


def staged_labels(spark):
    folders = glob.glob(f"{spark.conf.get('spark.checkpoint.dir').removeprefix('file://')}/vitaelake/*")
    return {folder.rsplit("/", 1)[1] for folder in folders}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffle_files(spark)
    own = spark.conf.get(key, None)
    table = staged(spark, spark.range(1000).repartition(4, "id").groupBy("id").count(), "no-shuffles")
    wait = time.time() + 20
    while shuffle_files(spark) - before and time.time() < wait:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert table.count() == 1000 and spark.conf.get(key, None) == own


@pytest.mark.parametrize("each", [12, 1000])
def test_components_in_parts_and_what_they_leave(spark, monkeypatch, each):
    parts = []

    def parts_for(size, most, count=ngram_join.parts_for):
        parts.append(count(size, most))
        return parts[-1]

    monkeypatch.setattr(ngram_join, "LEAST_MOVED", 1)
    monkeypatch.setattr(ngram_join, "MOVED_PER_SHINGLE", each)
    monkeypatch.setattr(ngram_join, "parts_for", parts_for)
    texts, before = template_texts(), staged_labels(spark)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = ngram_join.components(docs)
    left = {label.rsplit("-", 1)[0] for label in staged_labels(spark) - before}
    assert left == {"sets", "set-components", "links", "labels"}
    assert {row.doc_id: row.component_id for row in found.collect()} == components_by_hand(texts)
    # Judged, members, judged again, blocks.
    assert (sum(count > 1 for count in parts) >= 3) == (each == 12)


def test_levels_go_with_the_last_batch(spark):
    passage = " ".join(f"word{n}" for n in range(40))
    texts = [(n, f"text {n} {passage} ends {n}") for n in range(30)]
    docs, before = spark.createDataFrame(texts, "doc_id long, text string"), staged_labels(spark)
    found = suffix_dedup.remove_repeats(docs, batches=3)
    left = {label.rsplit("-", 1)[0] for label in staged_labels(spark) - before}
    assert left == {"documents", "spans"}
    lengths = {row.doc_id: len(row.text) for row in found.collect()}
    assert lengths[0] == len(texts[0][1]) and all(lengths[n] < 60 for n in range(1, 30))


def test_pipeline_deletes_what_the_next_stage_has_read(spark, sf_dir, monkeypatch):
    def shorter(spark, docs, sf_dir):
        return docs.where("doc_id % 2 = 0").select("doc_id")

    def summed(spark, docs, sf_dir):
        return docs.selectExpr("sum(doc_id) AS total")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("shorter", shorter), ("same", shorter), ("sum", summed)])
    before = staged_labels(spark)
    found = corpus_pipeline.run(spark, sf_dir)
    left = {label.rsplit("-", 1)[0] for label in staged_labels(spark) - before}
    assert left == {"pipeline-2"}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows(found) == rows(docs.where("doc_id % 2 = 0").selectExpr("sum(doc_id)"))
