"""What pages hold beyond the declared schema: a report, an inferred schema, and the rest of records.

Records are declared, so a field that the service adds is not read. Here it is not lost without a
word either: ``field_report`` counts what records hold against the schema, ``page_records_with_rest``
keeps undeclared fields in one variant column, and ``inferred_schema`` gives the type that all records
of all pages have together. A page is parsed once for each.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIELD = "array<struct<path:string,kind:string>>"

# Kinds of JSON values by Spark's name of a variant's type.
KINDS = {
    "VOID": "null", "BOOLEAN": "flag", "BIGINT": "whole", "DECIMAL": "number", "DOUBLE": "number",
    "STRING": "text", "OBJECT": "object", "ARRAY": "list",
}


def record_variants(responses: DataFrame, body: str = "body") -> DataFrame:
    """The records of every page as ``record``, a variant. A page without results is an error."""
    page = F.try_parse_json(F.col(body))
    results = F.try_variant_get(page, "$.results", "array<variant>")
    fault = F.raise_error(F.concat(F.lit("page without results: "), F.col(body))).cast("array<variant>")
    return responses.select(F.explode(F.coalesce(results, fault)).alias("record"))


def value_kind(value: Column) -> Column:
    """null, flag, whole, number, text, object or list."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    named = [part for pair in KINDS.items() for part in map(F.lit, pair)]
    return F.coalesce(F.element_at(F.create_map(*named), name), F.lower(name))


def _fields(value: Column) -> Column:
    """The fields of an object as a map; none of anything else."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))
    return F.coalesce(F.try_variant_get(value, "$", "map<string,variant>"), none)


def _paths(value: Column, schema: T.StructType, prefix: str) -> Column:
    """path and kind of each field of an object, and of those inside its declared objects and lists
    of objects."""
    own = F.transform(
        F.map_entries(_fields(value)),
        lambda entry: F.struct(
            F.concat(F.lit(prefix), entry["key"]).alias("path"), value_kind(entry["value"]).alias("kind")
        ),
    )
    parts = [own]
    for field in schema.fields:
        # A name may hold a dot or a quote, so it is looked up rather than put into a path.
        inner = F.element_at(_fields(value), F.lit(field.name))
        if isinstance(field.dataType, T.StructType):
            parts.append(_paths(inner, field.dataType, f"{prefix}{field.name}."))
        elif isinstance(field.dataType, T.ArrayType) and isinstance(
            field.dataType.elementType, T.StructType
        ):
            members = F.coalesce(
                F.try_variant_get(inner, "$", "array<variant>"), F.array().cast("array<variant>")
            )
            element, path = field.dataType.elementType, f"{prefix}{field.name}[]."
            # Called at once, with the element and path of this field.
            parts.append(F.flatten(F.transform(members, lambda member: _paths(member, element, path))))
    return F.concat(*[part.cast(_FIELD) for part in parts])


def declared_fields(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """Path and kind of every field that a schema names; text takes any value, as it was sent."""
    found = []
    for field in schema.fields:
        kind, inner = field.dataType, None
        if isinstance(kind, T.StructType):
            name, inner, below = "object", kind, "."
        elif isinstance(kind, T.ArrayType):
            name, below = "list", "[]."
            inner = kind.elementType if isinstance(kind.elementType, T.StructType) else None
        else:
            name = {"string": "text", "bigint": "whole", "boolean": "flag"}.get(
                kind.simpleString(), "number"
            )
        found.append((prefix + field.name, name))
        if inner is not None:
            found += declared_fields(inner, f"{prefix}{field.name}{below}")
    return found


def field_report(records: DataFrame, schema: T.StructType, record: str = "record") -> DataFrame:
    """path, kind, declared, records, status of each field and kind of value that records hold, and
    of each declared field that none holds.

    status: ``as declared``, ``other kind`` (the declared column is null for such values),
    ``unknown`` (no schema names the field) or ``missing``. A record counts once for a path and kind,
    however many members of a list have it; counts are added up before the shuffle, and there are
    as many rows as distinct paths.
    """
    spark = records.sparkSession
    paths = F.array_distinct(_paths(F.col(record), schema, ""))
    seen = records.select(F.explode(paths).alias("field")).groupBy("field.path", "field.kind")
    seen = seen.agg(F.count(F.lit(1)).alias("records"))
    named = spark.createDataFrame(declared_fields(schema), "path string, declared string")
    fits = (
        (F.col("kind") == F.col("declared"))
        | F.col("kind").isin("null")
        | (F.col("declared") == "text")
        | ((F.col("declared") == "number") & (F.col("kind") == "whole"))
    )
    status = (
        F.when(F.col("declared").isNull(), "unknown")
        .when(F.col("kind").isNull(), "missing")
        .when(fits, "as declared")
        .otherwise("other kind")
    )
    return seen.join(named, "path", "full").select(
        "path", "kind", "declared", F.coalesce("records", F.lit(0)).alias("records"), status.alias("status")
    )


def inferred_schema(records: DataFrame, record: str = "record") -> T.DataType:
    """The type that all records have together: every field that one of them holds. One aggregation
    of the types, whatever the number of records."""
    told = records.agg(F.schema_of_variant_agg(record)).first()[0]
    return T.DataType.fromDDL(told.replace("OBJECT<", "STRUCT<"))


def page_records_with_rest(
    responses: DataFrame, schema: T.StructType, rest: str = "rest", body: str = "body"
) -> DataFrame:
    """The declared fields of every record, as ``page_records`` gives them, and the undeclared ones
    as an object in the variant column ``rest``; null where there are none."""
    page = F.from_json(F.col(body), T.StructType([T.StructField("results", T.ArrayType(schema))]))
    sent = F.try_variant_get(F.try_parse_json(F.col(body)), "$.results", "array<variant>")
    fault = F.raise_error(F.concat(F.lit("page without results: "), F.col(body)))
    results = F.coalesce(page["results"], fault.cast(T.ArrayType(schema)))
    both = F.transform(results, lambda one, at: F.struct(one.alias("record"), F.get(sent, at).alias("sent")))
    known = reduce(F.array_append, [F.lit(name) for name in schema.names], F.array().cast("array<string>"))
    others = F.map_filter(_fields(F.col("sent")), lambda name, _: ~F.array_contains(known, name))
    kept = F.when(F.size(others) > 0, F.to_variant_object(others))
    return responses.select(F.inline(both)).select("record.*", kept.alias(rest))
