"""Fields that no schema names: reported, kept and inferred."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vitaelake import schemas as S
from vitaelake.sources import drift, paging

SCHEMA = S.record(
    id=S.WHOLE, label=S.TEXT, flag=S.FLAG, absent=S.TEXT,
    stats=S.record(h=S.WHOLE, deep=S.record(x=S.WHOLE)),
    authors=S.T.ArrayType(S.record(name=S.TEXT)), tags=S.T.ArrayType(S.TEXT),
)

RECORDS = [
    {"id": 1, "label": "a", "flag": True, "stats": {"h": 2, "new": 1.5}, "authors": [{"name": "x"}, {"name": "y", "orcid": None}]},
    {"id": "two", "label": {"nested": [1]}, "tags": ["t"], "added": {"x": 1}, "authors": [{"orcid": "o"}, {"orcid": "p"}]},
    {"id": None, "added": 3, "stats": "odd", "authors": None, "odd.name": 1, "it's": 2},
    {"stats": {"deep": {"x": 1, "y": [2]}}, "authors": "none", "flag": 0},
    {},
]


def pages(spark):
    bodies = [json.dumps({"results": RECORDS[:2]}), json.dumps({"results": RECORDS[2:]}), '{"results": []}']
    return spark.createDataFrame([(body,) for body in bodies], "body STRING").repartition(2)


REPORT = [
    ("id", "whole", "whole", 1, "as declared"), ("id", "text", "whole", 1, "other kind"),
    ("id", "null", "whole", 1, "as declared"), ("label", "text", "text", 1, "as declared"),
    ("label", "object", "text", 1, "as declared"), ("flag", "flag", "flag", 1, "as declared"),
    ("flag", "whole", "flag", 1, "other kind"), ("absent", None, "text", 0, "missing"),
    ("stats", "object", "object", 2, "as declared"), ("stats", "text", "object", 1, "other kind"),
    ("stats.h", "whole", "whole", 1, "as declared"), ("stats.new", "number", None, 1, "unknown"),
    ("stats.deep", "object", "object", 1, "as declared"), ("stats.deep.x", "whole", "whole", 1, "as declared"),
    ("stats.deep.y", "list", None, 1, "unknown"), ("authors", "list", "list", 2, "as declared"),
    ("authors", "null", "list", 1, "as declared"), ("authors", "text", "list", 1, "other kind"),
    ("authors[].name", "text", "text", 1, "as declared"), ("authors[].orcid", "null", None, 1, "unknown"),
    ("authors[].orcid", "text", None, 1, "unknown"), ("tags", "list", "list", 1, "as declared"),
    ("added", "object", None, 1, "unknown"), ("added", "whole", None, 1, "unknown"),
    ("odd.name", "whole", None, 1, "unknown"), ("it's", "whole", None, 1, "unknown"),
]


def test_field_report(spark):
    report = drift.field_report(drift.record_variants(pages(spark)), SCHEMA)
    assert report.columns == ["path", "kind", "declared", "records", "status"]
    assert rows(report) == sorted(REPORT, key=repr)


def test_report_of_nothing_names_what_is_missing(spark):
    report = drift.field_report(drift.record_variants(pages(spark).limit(0)), SCHEMA)
    assert {row.status for row in report.collect()} == {"missing"}
    assert report.count() == len(drift.declared_fields(SCHEMA))


def test_pages_are_parsed_once_for_the_report(spark):
    report = drift.field_report(drift.record_variants(pages(spark)), SCHEMA)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 1


def test_rest_of_records(spark):
    found = drift.page_records_with_rest(pages(spark), SCHEMA)
    assert found.columns == [*SCHEMA.names, "rest"]
    rest = [row[0] and json.loads(row[0]) for row in found.select(F.to_json("rest")).collect()]
    assert sorted(rest, key=repr) == sorted(
        [None, {"added": {"x": 1}}, {"added": 3, "odd.name": 1, "it's": 2}, None, None], key=repr
    )
    declared = paging.page_records(pages(spark), SCHEMA)
    assert rows(found.drop("rest")) == rows(declared)


def test_rest_is_stored_and_read_again(spark, tmp_path):
    drift.page_records_with_rest(pages(spark), SCHEMA).write.parquet(str(tmp_path / "records"))
    found = spark.read.parquet(str(tmp_path / "records"))
    added = F.try_variant_get("rest", "$.added", "string")
    assert found.where(added.isNotNull()).count() == 2


def test_pages_without_results_are_errors(spark):
    broken = spark.createDataFrame([('{"meta":{}}',)], "body STRING")
    for rows_of in (drift.record_variants, lambda df: drift.page_records_with_rest(df, SCHEMA)):
        with pytest.raises(Exception, match="page without results"):
            rows_of(broken).collect()


def test_inferred_schema(spark):
    records = [{"id": 1, "a": {"x": 1}}, {"id": 2, "a": {"y": "t"}, "list": [1]}, {"list": [{"z": True}], "b": 1.5}]
    body = spark.createDataFrame([(json.dumps({"results": records}),)], "body STRING")
    found = drift.inferred_schema(drift.record_variants(body))
    assert found["id"].dataType == S.WHOLE and set(found["a"].dataType.names) == {"x", "y"}
    assert set(found.names) == {"id", "a", "list", "b"}
    read = paging.page_records(body, found)
    assert [row.id for row in read.collect()] == [1, 2, None]
