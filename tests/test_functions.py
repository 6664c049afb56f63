import json
import random
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitaelake import functions as V


def apply(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    out = df.select("i", function(F.col("v")).alias("r")).orderBy("i")
    return [row.r for row in out.collect()]


def test_last_segment(spark):
    values = ["https://x.org/A1", "A1", "x/", "", None]
    assert apply(spark, values, V.last_segment) == ["A1", "A1", "", "", None]


def test_falsy_coalesce(spark):
    df = spark.createDataFrame(
        [("a", "b"), ("", "b"), (None, "b"), ("", None), (" ", "b")], "a STRING, b STRING"
    )
    got = [r[0] for r in df.select(V.falsy_coalesce(F.col("a"), F.col("b"))).collect()]
    assert got == ["a", "b", "b", None, " "]


def test_join_list_skips_nulls(spark):
    values = [["a", None, "b"], [], None, [None], ["", "x"]]
    assert apply(spark, values, V.join_list, "ARRAY<STRING>") == ["a; b", "", None, "", "; x"]


def test_project_list(spark):
    kind = "ARRAY<STRUCT<display_name: STRING, score: DOUBLE>>"
    values = [[("k", 0.5), None, (None, 1.0)], [], None]
    got = apply(spark, values, lambda c: V.project_list(c, "display_name"), kind)
    assert got == [["k", None, None], [], None]


def test_recode_defaults_to_null(spark):
    codes = {"first": 1, "middle": 2, "last": 3}
    got = apply(spark, ["first", "middle", "last", "FIRST", "", None], lambda c: V.recode(c, codes))
    assert got == [1, 2, 3, None, None, None]


DATES = {
    "2024-05-01": "01/05/2024",
    "2024-05-01T23:59:59": "01/05/2024",
    "01/05/2024": "01/05/2024",
    "2024-02-30": None,
    "2024-05-01T23:59:59.123": None,
    "2024-05": None,
    None: None,
}


@pytest.mark.parametrize("strict", [True, False])
def test_reformat_date_text(spark, strict):
    got = apply(spark, list(DATES), lambda c: V.reformat_date_text(c, strict))
    assert got == list(DATES.values())


def test_reformat_date_text_strictness(spark):
    odd = ["31/02/2024", "", "1/2/2024", "soon"]
    assert apply(spark, odd, lambda c: V.reformat_date_text(c, strict=False)) == [None] * 4
    for text in odd:
        with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed|Invalid date"):
            apply(spark, [text], V.reformat_date_text)


def test_reformat_date_as_date(spark):
    got = apply(spark, ["2024-05-01"], lambda c: V.reformat_date_text(c, as_text=False))
    assert got == [date(2024, 5, 1)]


def test_parse_update_date(spark):
    assert apply(spark, ["01052024", None], V.parse_update_date) == [date(2024, 5, 1), None]
    lenient = apply(spark, ["31022024", "", "x"], lambda c: V.parse_update_date(c, strict=False))
    assert lenient == [None, None, None]
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed|Invalid date"):
        apply(spark, ["31022024"], V.parse_update_date)


def test_run_timestamp(spark):
    at = datetime(2024, 5, 24, 9, 30, 15, 250000)
    df = spark.range(1).select(V.run_timestamp(at).alias("t"), V.run_timestamp().alias("now"))
    assert df.dtypes == [("t", "timestamp_ntz"), ("now", "timestamp_ntz")]
    assert df.first().t == at
    assert abs((df.first().now - datetime.now()).total_seconds()) < 15 * 3600


def test_run_date_text(spark):
    assert spark.range(1).select(V.run_date_text(date(2024, 5, 4))).first()[0] == "04052024"


def expected_text(index_json):
    """Plain restatement of the rule, for comparison."""
    if index_json is None:
        return None
    try:
        index = json.loads(index_json)
    except ValueError:
        return ""
    if not isinstance(index, dict):
        return ""
    placed = {}
    for word, positions in index.items():
        for position in positions:
            if isinstance(position, int) and position >= 0:
                placed[int(position)] = word
    return " ".join(placed[p] for p in sorted(placed) if placed[p])


INDEX_CASES = [
    '{"b": [1], "a": [0, 2]}',
    '{"a": [0], "c": [5]}',
    '{"a": [0], "b": [0, 1]}',
    '{"a": [3], "": [3], "b": [1]}',
    '{"": [0], "x": [1]}',
    '{"a": [-1], "b": [0]}',
    '{"a": [-1]}',
    '{"a": [1.0, 2], "b": [0]}',
    '{"a": ["0"], "b": [1]}',
    '{"a": [true], "b": [false], "c": [2]}',
    '{"a": [null, 1], "b": [[0]], "c": [{"x": 0}]}',
    '{"a": [1e0], "b": [0]}',
    '{"a": []}',
    '{"\\u00e9\\"\\\\": [0], "Ünï/ž": [1]}',
    "{}",
    "[]",
    "null",
    '"text"',
    "12",
    "",
    "  ",
    "{",
    '{"a": [0]',
    '{"a": [0]} x',
    '{"a": [0]} {"b": [1]}',
    '{"a": [0]},{"b": [1]}',
    "{'a': [0]}",
    "{a: [0]}",
    '{"a": [01]}',
    '{"a": [0],}',
    ' {"a": [0]} ',
    None,
]


def test_inverted_index_edges(spark):
    got = apply(spark, INDEX_CASES, V.text_from_inverted_index)
    assert dict(zip(INDEX_CASES, got)) == {case: expected_text(case) for case in INDEX_CASES}


def test_inverted_index_scalar_positions_give_empty_text(spark):
    assert apply(spark, ['{"a": 1}', '{"a": null}'], V.text_from_inverted_index) == ["", ""]


def test_inverted_index_long_text(spark):
    shuffled = random.Random(7)
    words = [f"w{shuffled.randrange(3000)}" for _ in range(20_000)]
    index = {}
    for position, word in enumerate(words):
        index.setdefault(word, []).append(position)
    assert apply(spark, [json.dumps(index)], V.text_from_inverted_index) == [" ".join(words)]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.dictionaries(st.text(max_size=4), st.lists(st.integers(-2, 12), max_size=4), max_size=6),
        min_size=20,
        max_size=40,
    )
)
def test_inverted_index_any_map(spark, maps):
    texts = [json.dumps(one) for one in maps]
    assert apply(spark, texts, V.text_from_inverted_index) == [expected_text(t) for t in texts]


def test_encode_json_and_map_text(spark):
    values = [{"a": [0, 1]}, {}, None]
    assert apply(spark, values, V.encode_json, "MAP<STRING, ARRAY<INT>>") == [
        '{"a":[0,1]}',
        "{}",
        None,
    ]
    raw = ['{"a":[0]}', " {}", "[1]", "text", "", None]
    assert apply(spark, raw, V.map_text_or_null) == ['{"a":[0]}', " {}", None, None, None, None]
