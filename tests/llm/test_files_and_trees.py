"""What the token files hold, and trees walked node by node."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import vitaelake
from vitaelake.llm import orc_tokens, quality_trees
from vitaelake.llm.queries import tokenizer_file
from vitaelake.session import hadoop_path, scratch_location, ship_packages


@pytest.fixture(scope="module")
def written(spark):
    """12,000 documents in files of several row groups."""
    ship_packages(spark, vitaelake)
    docs = spark.range(12_000).select(
        (F.col("id") * 3).alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text")
    )
    location = scratch_location(spark, "orc-test")
    orc_tokens.write_documents(docs, location, tokenizer_file())
    return location


def stripe_footers(spark, location):
    """Footers of all stripes of the files, by the format's own reader."""
    jvm = spark.sparkContext._jvm
    path, files = hadoop_path(spark, location)
    footers = []
    for status in files.listStatus(path):
        if not status.getPath().getName().endswith(".orc"):
            continue
        options = jvm.org.apache.orc.OrcFile.readerOptions(spark.sparkContext._jsc.hadoopConfiguration())
        reader = jvm.org.apache.orc.OrcFile.createReader(status.getPath(), options)
        rows = reader.rows()
        footers += [(reader, rows.readStripeFooter(stripe)) for stripe in reader.getStripes()]
    return footers


def test_files_hold_run_lengths_indexes_and_bloom_filters(spark, written):
    footers = stripe_footers(spark, written)
    assert footers
    for reader, footer in footers:
        assert str(reader.getCompressionKind()) == "ZSTD"
        assert reader.getRowIndexStride() == orc_tokens.ROWS_PER_INDEX
        names = list(reader.getSchema().getFieldNames())
        # Column 0 is the row itself; version 2 of the integer run-length encoding.
        encodings = [str(one.getKind()) for one in footer.getColumnsList()]
        assert set(encodings[1:]) == {"DIRECT_V2"}
        streams = {(stream.getColumn(), str(stream.getKind())) for stream in footer.getStreamsList()}
        of_ids = names.index("doc_id") + 1
        assert (of_ids, "ROW_INDEX") in streams and (of_ids, "BLOOM_FILTER_UTF8") in streams
        assert not any(kind.startswith("BLOOM") for column, kind in streams if column != of_ids)


def scanned(df):
    """Rows that the scan of the files gave out."""
    df.collect()
    plans, total = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        plan = plans.pop()
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            plans.append(plan.executedPlan())
            continue
        if plan.nodeName().startswith("Scan orc"):
            total += plan.metrics().get("numOutputRows").get().value()
        plans += [plan.children().apply(at) for at in range(plan.children().size())]
    return total


def test_readers_of_few_documents_pass_over_row_groups(spark, written):
    stored = orc_tokens.read_tokens(spark, written)
    one = stored.where("doc_id = 9000")
    assert [row.doc_id for row in one.collect()] == [9000]
    assert scanned(one) <= 2 * orc_tokens.ROWS_PER_INDEX < scanned(stored) == 12_000
    # Between two ids that are there: within all ranges, so only a Bloom filter tells.
    none = stored.where("doc_id = 9001")
    assert none.collect() == [] and scanned(none) == 0


def test_flat_trees_against_a_plain_walk():
    draw = np.random.default_rng(11)
    rows = draw.normal(size=(400, 6))
    labels = ((rows[:, 0] > 0.2) ^ (rows[:, 3] < -0.5) | (rows[:, 5] > 1.2)).astype(float)
    trees = quality_trees.fit(rows, labels, trees=25, depth=3, bins=16)
    told = trees.probability(rows)

    def walk(tree, row):
        node = 0
        while node < len(trees.feature[tree]):
            right = row[trees.feature[tree][node]] > trees.threshold[tree][node]
            node = 2 * node + (2 if right else 1)
        return trees.leaf[tree][node - len(trees.feature[tree])]

    for row, chance in zip(rows, told):
        odds = trees.start + sum(walk(tree, row) for tree in range(len(trees.leaf)))
        assert chance == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-12)
    assert ((told >= 0.5) == labels).mean() > 0.95
    # Fewer labels than a tree needs, and labels of one kind.
    for some in (labels[:1], np.ones(30), np.zeros(0)):
        few = quality_trees.fit(rows[: len(some)], some)
        assert np.isfinite(few.probability(rows)).all()
