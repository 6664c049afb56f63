import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vitaelake.operators import columns, dedup, enrich, joins, keys, projection, works


def test_select_rename(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT")
    assert projection.select_rename(df, {"c": "z", "a": "x"}).columns == ["z", "x"]
    assert projection.select_rename(df, {"c": "z", "q": "y"}, strict=False).columns == ["z"]
    assert projection.select_rename(df, {"c": "z", "q": "y"}, rename=False).columns == ["c"]
    with pytest.raises(ValueError, match="q"):
        projection.select_rename(df, {"c": "z", "q": "y"})


def test_unnest_struct_in_place(spark):
    df = spark.createDataFrame([(1, (2, 3), 4), (5, None, 6)], "a INT, s STRUCT<x: INT, y: INT>, b INT")
    out = projection.unnest_struct(df, "s")
    assert out.columns == ["a", "x", "y", "b"]
    assert rows(out) == [(1, 2, 3, 4), (5, None, None, 6)]


def test_unnest_struct_clash(spark):
    df = spark.createDataFrame([(1, (2,))], "a INT, s STRUCT<a: INT>")
    with pytest.raises(ValueError, match="duplicate columns: a"):
        projection.unnest_struct(df, "s")


def test_merge_records_right_wins(spark):
    df = spark.createDataFrame(
        [((1, 2), (3, 4), 5)], "l STRUCT<a: INT, b: INT>, r STRUCT<b: INT, c: INT>, k INT"
    )
    out = projection.merge_records(df, "l", "r")
    assert (out.columns, rows(out)) == (["a", "b", "c", "k"], [(1, 3, 4, 5)])


def test_add_and_set_column(spark):
    df = spark.createDataFrame([(1,)], "a INT")
    assert rows(projection.add_if_absent(df, "a", F.lit(9))) == [(1,)]
    assert rows(projection.add_if_absent(df, "b", F.lit(9))) == [(1, 9)]
    assert rows(projection.set_column(df, "a", F.lit(9))) == [(9,)]


def test_required_and_string_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    assert projection.string_columns(df, ["a", "b", "c"]) == ["b"]
    with pytest.raises(ValueError, match="missing columns: c"):
        projection.require_columns(df, ["a", "c"])
    for operator in (works.explode_authorships, works.add_journal, works.add_keyword_names):
        with pytest.raises(ValueError, match="missing columns"):
            operator(df)


TITLES = [
    (1, "t1", None), (2, "t1", "d2"), (3, "t1", "d1"), (4, "t2", None), (5, "t2", None),
    (6, "t3", "d9"), (7, "t3", "d9"), (8, None, "d5"), (9, None, "d4"), (10, "", None),
    (11, "", "d0"),
]


def test_keep_first(spark):
    df = spark.createDataFrame(TITLES, "id INT, display_name STRING, doi STRING")
    kept = dedup.keep_first(df, ["display_name"], ["doi", "id"])
    assert kept.columns == df.columns
    assert sorted(row.id for row in kept.collect()) == [3, 4, 6, 9, 11]
    with_nulls = dedup.keep_first(df, ["display_name"], ["doi", "id"], keep_null_keys=True)
    assert sorted(row.id for row in with_nulls.collect()) == [3, 4, 6, 8, 9, 11]


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame(TITLES, "id INT, display_name STRING, doi STRING")
    kept = dedup.keep_first(df, ["display_name"], ["doi", "id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")  # printed top down


def test_dedup_counts(spark):
    df = spark.createDataFrame(TITLES, "id INT, display_name STRING, doi STRING")
    assert rows(dedup.dedup_counts(df, ["display_name"])) == [(11, 5)]
    assert rows(dedup.dedup_counts(df.limit(0), ["display_name"])) == [(0, 0)]


def test_sort_nulls_last(spark):
    df = spark.createDataFrame(TITLES, "id INT, display_name STRING, doi STRING").repartition(4)
    ordered = [row.id for row in dedup.sort_nulls_last(df, "doi", "id").collect()]
    assert ordered == [11, 3, 2, 9, 8, 6, 7, 1, 4, 5, 10]


def test_first_non_null(spark):
    df = spark.createDataFrame(
        [(3, "c", None), (1, None, None), (2, "b", None)], "id INT, a STRING, n STRING"
    )
    assert rows(dedup.first_non_null(df, ["a", "n"], "id")) == [("b", None)]


LEFT = [(i, key) for i, key in enumerate(["a", "a", "b", None, None, "z", "https://a"])]
RIGHT = [("a", 10), ("b", 20), ("b", 21), (None, 30), ("q", 40)]
JOINED = [
    (0, "a", 10), (1, "a", 10), (2, "b", 20), (2, "b", 21), (3, None, None), (4, None, None),
    (5, "z", None), (6, "https://a", None),
]


def test_left_join(spark):
    left = spark.createDataFrame(LEFT, "id INT, k STRING")
    right = spark.createDataFrame(RIGHT, "k STRING, v INT")
    out = joins.left_join(left, right, "k")
    assert out.columns == ["id", "k", "v"]
    assert rows(out) == sorted(JOINED, key=repr)


def test_left_join_suffix(spark):
    left = spark.createDataFrame([(1, "a")], "v INT, k STRING")
    right = spark.createDataFrame([("a", 2)], "k STRING, v INT")
    assert joins.left_join(left, right, "k").columns == ["v", "k", "v_right"]


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_left_join_with_hot_right_key(spark, broadcast):
    """A third of the right side shares a key; the result must match a plain join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        chosen = random.Random(3)
        right = spark.createDataFrame(
            [(chosen.choice([7, i % 50]), i) for i in range(1500)], "k INT, v INT"
        )
        left = spark.createDataFrame([(i % 60, i) for i in range(200)] + [(None, -1)], "k INT, w INT")
        plain = left.join(right, "k", "left").select("k", "w", "v")
        salted = joins.left_join(left, right, "k")
        assert rows(salted) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_left_join_with_equal_right_rows_and_unique_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id INT, k STRING")
    right = spark.createDataFrame([("a", 5)] * 300, "k STRING, v INT")
    assert rows(joins.left_join(left, right, "k")) == rows(
        left.join(right, "k", "left").select("id", "k", "v")
    )
    once = right.distinct()
    assert rows(joins.left_join(left, once, "k", unique_right=True)) == [
        (1, "a", 5), (2, None, None), (3, "b", None)
    ]


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_left_join_deals_hot_keys_of_either_side(spark, broadcast, stored):
    """Keys that are hot left, right, on both sides and nowhere; nulls and equal rows on both."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        left = [(k, n) for k, count in (("l", 90), ("r", 2), ("both", 40), ("few", 3), ("no", 50),
                                        (None, 70)) for n in range(count)]
        right = [(k, n % 7) for k, count in (("l", 1), ("r", 95), ("both", 45), ("few", 2),
                                             ("other", 60), (None, 30)) for n in range(count)]
        left = spark.createDataFrame(left, "k STRING, w INT").repartition(3)
        right = spark.createDataFrame(right, "k STRING, v INT").repartition(3)
        hot = joins.hot_keys(right, "k", 10)
        assert rows(hot) == [("both", 5), ("other", 6), ("r", 10)]
        dealt = joins.left_join(left, right, "k", hot=hot if stored else None, hot_rows=10)
        assert rows(dealt) == rows(left.join(right, "k", "left").select("k", "w", "v"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def scans(df, column):
    """Scans of the physical plan that read the column."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", plan))


def test_left_join_reads_the_left_side_once(spark, tmp_path):
    for name, columns in (("left", "id AS w"), ("right", "id AS v"), ("third", "id AS u")):
        table = spark.range(20).selectExpr("id % 5 AS k", columns, "id % 3 AS j")
        table.write.parquet(str(tmp_path / name))
    left, right, third = (
        spark.read.parquet(str(tmp_path / name)) for name in ("left", "right", "third")
    )
    once = joins.left_join(left, right.select("k", "v"), "k")
    assert scans(once, "w") == 1 and scans(once, "v") == 1
    twice = joins.left_join(once, third.select("j", "u"), "j")
    assert scans(twice, "w") == 1 and scans(twice, "v") == 1 and scans(twice, "u") == 1
    # With the hot keys measured before, each side is read once in all.
    hot = spark.createDataFrame([], "_hot LONG, salts LONG")
    measured = joins.left_join(left, right.select("k", "v"), "k", hot=hot)
    assert scans(measured, "k") == 2


def test_building_a_left_join_runs_no_job(spark):
    left = spark.createDataFrame(LEFT, "id INT, k STRING")
    right = spark.createDataFrame(RIGHT, "k STRING, v INT")
    spark.sparkContext.setJobGroup("building", "left join")
    try:
        joins.left_join(left, right, "k")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_numbers_do_not_depend_on_buckets(spark, buckets):
    df = spark.range(500).select(F.col("id").cast("string").alias("key"))
    assert rows(keys.number_rows(df, "key", "n", buckets=buckets)) == rows(
        keys.number_rows(df, "key", "n")
    )


def test_duplicate_keys(spark):
    right = spark.createDataFrame(RIGHT + [(None, 31)], "k STRING, v INT")
    assert rows(joins.duplicate_keys(right, "k")) == [("b", 2)]


def test_semi_join(spark):
    left = spark.createDataFrame(LEFT, "id INT, k STRING")
    right = spark.createDataFrame(RIGHT, "k STRING, v INT")
    assert sorted(row.id for row in joins.semi_join(left, right, "k").collect()) == [0, 1, 2]


@pytest.mark.parametrize("count", [0, 1, 50, 51, 173])
def test_key_batches(spark, count):
    values = [f"k{i}" for i in range(count)]
    df = spark.createDataFrame([(v,) for v in values * 2 + [None]], "k STRING")
    batches = keys.key_batches(df, "k", 50).orderBy("batch").collect()
    assert [row.batch for row in batches] == list(range(-(-count // 50)))
    assert [row.batch_size for row in batches][:-1] == [50] * max(0, len(batches) - 1)
    joined = [key for row in batches for key in row.batch_keys.split("|")]
    assert sorted(joined) == sorted(values)


def test_number_rows_in_groups(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id")
    numbered = keys.number_rows(df, "id", "n", ["g"], buckets=8)
    assert numbered.columns == ["g", "id", "n"]
    for group in range(3):
        members = numbered.where(F.col("g") == group).collect()
        assert sorted(row.n for row in members) == list(range(1, len(members) + 1))


AUTHOR = "STRUCT<id: STRING, display_name: STRING, orcid: STRING>"
AUTHORSHIP = (
    "STRUCT<author_position: STRING, is_corresponding: BOOLEAN, raw_author_name: STRING, "
    f"raw_affiliation_strings: ARRAY<STRING>, countries: ARRAY<STRING>, "
    f"institutions: ARRAY<STRUCT<id: STRING>>, author: {AUTHOR}>"
)
WORKS = [
    ("w1", [
        ("first", True, "Ana", ["X", None, "Y"], ["BR"], [("i1",)], ("a1", "Ana", "o1")),
        ("middle", False, "Bia", [], None, None, ("a2", "Bia", None)),
        ("last", None, "Caio", None, None, None, None),
        ("guest", False, None, [None], None, None, None),
        (None, False, None, ["Z"], None, None, None),
        None,
    ]),
    ("w2", []),
    ("w3", None),
]


def test_bridge(spark):
    df = spark.createDataFrame(WORKS, f"id STRING, authorships ARRAY<{AUTHORSHIP}>")
    exploded = works.explode_authorships(df)
    assert exploded.count() == 8
    bridge = works.author_work_bridge(exploded)
    assert bridge.dtypes == [
        ("openalex_producao_id", "string"), ("openalex_autor_id", "string"),
        ("orcid_id", "string"), ("nome_autor", "string"), ("ordem_autoria", "int"),
        ("autor_principal", "boolean"), ("correspondente", "boolean"),
        ("afiliacao_autor", "string"),
    ]
    nothing = (None,) * 7
    assert rows(bridge) == sorted(
        [
            ("w1", "a1", "o1", "Ana", 1, True, True, "X; Y"),
            ("w1", "a2", None, "Bia", 2, False, False, ""),
            ("w1", None, None, "Caio", 3, False, None, None),
            ("w1", None, None, None, None, False, False, ""),
            ("w1", None, None, None, None, None, False, "Z"),
            ("w1", *nothing),
            ("w2", *nothing),
            ("w3", *nothing),
        ],
        key=repr,
    )


def test_journal_and_keywords(spark):
    df = spark.createDataFrame(
        [
            (1, (("J", "1-2"), "cc"), [("k",), None, (None,)]),
            (2, (None, "cc"), []),
            (3, None, None),
        ],
        "id INT, primary_location STRUCT<source: STRUCT<display_name: STRING, issn_l: STRING>, "
        "license: STRING>, keywords ARRAY<STRUCT<display_name: STRING>>",
    )
    out = works.add_keyword_names(works.add_journal(df))
    got = out.select("id", "journal_name", "issn_l", "license", "palavras_chave").orderBy("id")
    assert [tuple(row) for row in got.collect()] == [
        (1, "J", "1-2", "cc", ["k", None, None]),
        (2, None, None, "cc", []),
        (3, None, None, None, None),
    ]


def test_conditional_enrich(spark):
    df = spark.createDataFrame(
        [
            (1, "en", "hello"), (2, "en", "hello"), (3, "pt", "hello"), (4, None, "hello"),
            (5, "en", None), (6, "en", ""), (7, "pt", None),
        ],
        "id INT, language STRING, abstract STRING",
    )
    seen = spark.sparkContext.accumulator(0)

    def upper(texts):
        seen.add(len(texts))
        return [text.upper() + "!" for text in texts]

    out = enrich.conditional_enrich(df, upper, ["id"])
    assert out.columns == ["id", "language", "abstract", "resumo_traduzido"]
    got = {row.id: row.resumo_traduzido for row in out.collect()}
    assert got == {1: "HELLO!", 2: "HELLO!", 3: "hello", 4: "hello", 5: None, 6: "!", 7: None}
    assert seen.value == 2  # each distinct English text once


DATED = [
    (1, None, None, None, None, 5), (2, "2024-02-03", "31/12/2020", "2020-01-02T03:04:05", None, 6),
    (3, "03/02/2024", "01/02/2021", "2020-01-02", None, 7), (4, "2024-02-30", None, "x", None, 8),
    (5, "2024-02-03T01:02:03", "29/02/2024", "2021-05-06T00:00:00", None, 9),
]


@pytest.mark.parametrize("strict", [True, False])
def test_dates_in_the_format_of_a_columns_first_value(spark, strict):
    df = spark.createDataFrame(DATED, "id INT, iso STRING, local STRING, stamp STRING, none STRING, n INT")
    names = ["iso", "local", "stamp", "none", "n", "absent"]
    out = columns.date_columns_by_sample(df.repartition(3), names, "id", strict)
    assert out.dtypes == df.dtypes
    assert rows(out) == sorted([
        (1, None, None, None, None, 5), (2, "03/02/2024", "31/12/2020", "02/01/2020", None, 6),
        (3, None, "01/02/2021", None, None, 7), (4, None, None, None, None, 8),
        (5, None, "29/02/2024", "06/05/2021", None, 9),
    ], key=repr)
    # Another order, another sample: the local format, in which the others are unreadable.
    back = df.where("id IN (2, 3)").withColumn("id", -F.col("id"))
    if strict:
        with pytest.raises(Exception, match="2024-02-03|PARSE"):
            columns.date_columns_by_sample(back, ["iso"], "id", strict).collect()
    else:
        found = columns.date_columns_by_sample(back, ["iso"], "id", strict)
        assert {row.iso for row in found.collect()} == {None, "03/02/2024"}


def test_the_sample_is_part_of_the_same_query(spark):
    df = spark.createDataFrame(DATED, "id INT, iso STRING, local STRING, stamp STRING, none STRING, n INT")
    spark.sparkContext.setJobGroup("sampling", "date sample")
    try:
        columns.date_columns_by_sample(df, ["iso", "local"], "id")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("sampling")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
