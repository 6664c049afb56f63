"""What the inputs, the stand-in service and the fetching hold and move at once."""

import glob

import pyarrow as pa
from conftest import rows
from pyspark.sql import functions as F

from querybook.derived import index_from_text, spread
from querybook.service import serve
from vitaelake.functions import encode_json, text_from_inverted_index
from vitaelake.sources import paging


def test_one_row_group_is_spread_over_the_tasks(spark, tmp_path):
    """A file of many splits, all rows of which lie in one of them."""
    folder = str(tmp_path / "table")
    spark.range(2000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text")).coalesce(1).write.parquet(folder)
    key, own = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "4096")
    try:
        spread_rows = spread(spark.read.parquet(folder))
        sizes = [row["count"] for row in spread_rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set(key, own)
    assert len(sizes) >= 4 and max(sizes) < 1000 and sum(sizes) == 2000


def test_service_numbers_ids_and_sends_asked_pages(spark):
    records = spark.createDataFrame(
        [("a", 1, "r1"), ("b", 1, "r1"), ("a", 2, "r2"), ("c", None, "r0"), ("a", 2, "r2"), ("b", 3, "r3")],
        "key string, id long, record string",
    )
    requests = spark.createDataFrame([("k:a|b", 2, 1), ("k:a|b", 2, 2), ("k:c", 2, 1), ("k:d", 2, 1)], "filter string, per_page long, page long")
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/vitaelake/matched-*"))
    served = {(row["filter"], row["page"]): row["served"] for row in serve(requests, records).collect()}
    sent = [one for page in (1, 2) for one in served["k:a|b", page].split("[")[1].rstrip("]}").split(",")]
    assert sorted(sent) == ["r1", "r2", "r3"] and '"count":3' in served["k:a|b", 2]
    assert "[r0]" in served["k:c", 1] and '"count":0' in served["k:d", 1]
    (folder,) = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/vitaelake/matched-*")) - before
    assert "record" not in spark.read.parquet(folder).columns


def test_requests_become_python_rows_in_small_parts():
    batch = pa.RecordBatch.from_pydict({"page": list(range(150))})
    parts = list(paging.pieces(iter([batch, batch.slice(0, 0)]), 64))
    assert [one.num_rows for one in parts] == [64, 64, 22]
    assert [page for one in parts for page in one.column(0).to_pylist()] == list(range(150))


def test_index_of_a_text_and_back(spark):
    texts = [None, "", "  ", "b a  b c", "x", "1.5 e7 \"q\" 1.5"]
    df = spark.createDataFrame([(one,) for one in texts], "text string")
    index = encode_json(index_from_text(F.col("text")))
    told = df.select("text", index.alias("index")).select("text", "index", text_from_inverted_index(F.col("index")).alias("told"))
    assert rows(told.where("text LIKE 'b%'").select("index", "told")) == [('{"a":[1],"b":[0,2],"c":[3]}', "b a b c")]
    assert {row["told"] for row in told.collect()} == {None, "b a b c", "x", '1.5 e7 "q" 1.5'}


def test_positions_shared_large_or_odd(spark):
    cases = {
        '{"a":[0],"b":[0]}': "b", '{"a":[2147483648],"b":[3]}': "b a", '{"a":[-1,4],"b":[null,2]}': "b a",
        '{"a":[1],"":[1]}': "", '{"a":[0],"a":[1]}': "a a", '{"a":["1"],"b":[1.5, 2]}': "b", "{}": "", "[": "", "3": "",
    }
    df = spark.createDataFrame(list(cases.items()), "text string, expected string")
    wrong = df.withColumn("told", text_from_inverted_index(F.col("text"))).where("told <> expected")
    assert rows(wrong) == []
