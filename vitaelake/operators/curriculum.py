"""CV documents (XML text) to researcher, education and area rows.

What cannot be read is set apart as narrowly as it can be: a document that is no CV gives a reject
and nothing else; a section of the wrong shape (text where entries belong, or the section twice)
gives a reject of that section, while the researcher and the other sections go on.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitaelake import schemas as S
from vitaelake.functions import falsy_coalesce
from vitaelake.operators.projection import merge_records

_XML_OPTIONS = {
    "attributePrefix": "@",
    "ignoreSurroundingSpaces": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": S.CORRUPT_RECORD,
    "valueTag": S.TEXT_VALUE,
}
_ROOT_TAG = rf"^\s*(?:<\?[\s\S]*?\?>\s*|<!--[\s\S]*?-->\s*|<!DOCTYPE[^>]*>\s*)*<{S.CV_ROOT}[\s/>]"
_PARSED = T.StructType([*S.CV_XML.fields, T.StructField(S.CORRUPT_RECORD, T.StringType())])


def parse_documents(documents: DataFrame) -> DataFrame:
    """Add ``cv`` (the document as a struct), ``reject`` (why it could not be read) and
    ``bad_sections`` (section and reason of each that has the wrong shape).

    One of the first two is null. A readable document with another root element gives a ``cv`` whose
    fields are null. Values are kept as written, spaces included. Documents are independent: a
    bad one never stops the others.
    """
    xml = F.col("xml")
    read_error = F.col("error") if "error" in documents.columns else F.lit(None).cast("string")
    parsed = documents.withColumn("_cv", F.from_xml(xml, _PARSED, _XML_OPTIONS))
    ends_in_markup = F.endswith(F.expr("rtrim(' \\t\\r\\n', xml)"), F.lit(">"))
    reject = F.coalesce(
        read_error,
        F.when(xml.isNull(), F.lit("document is empty")),
        F.when(F.col(f"_cv.{S.CORRUPT_RECORD}").isNotNull(), F.lit("malformed XML")),
        F.when(~ends_in_markup, F.lit("text after the root element")),
    )
    own_root = xml.rlike(_ROOT_TAG)
    fields = [
        F.when(own_root, F.col("_cv").getField(name)).alias(name) for name in S.CV_XML.names
    ]
    judged = parsed.withColumns({"reject": reject, "_fields": F.struct(*fields)})
    cv = F.when(F.col("reject").isNull(), F.col("_fields"))
    read = judged.withColumn("cv", cv).drop("_cv", "_fields")
    return read.withColumn("bad_sections", _bad_sections(F.col("cv").getField("DADOS-GERAIS")))


def _section_fault(node: Column, entries: Sequence[str]) -> Column:
    """Why a section (a list of its occurrences) cannot be read; null where it can, or is absent."""
    section = F.get(node, 0)
    lists = [section.getField(name) for name in entries]

    def is_text(entry: Column) -> Column:
        return entry.getField(S.TEXT_VALUE).isNotNull()

    text_entry = [F.coalesce(F.exists(members, is_text), F.lit(False)) for members in lists]
    return (
        F.when(F.size(node) > 1, F.lit("section occurs twice"))
        .when(section.getField(S.TEXT_VALUE).isNotNull(), F.lit("text in place of entries"))
        .when(F.greatest(*text_entry, F.lit(False)), F.lit("text in place of an entry's attributes"))
    )


def _bad_sections(general: Column) -> Column:
    faults = [
        F.struct(
            F.lit(name).alias("section"),
            _section_fault(general.getField(name), entries).alias("reason"),
        )
        for name, entries in S.SECTIONS.items()
    ]
    return F.filter(F.array(*faults), lambda fault: fault["reason"].isNotNull())


def _sound_section(name: str) -> Column:
    """The section where its shape is right, else null."""
    node = F.col("cv").getField("DADOS-GERAIS").getField(name)
    return F.when(_section_fault(node, S.SECTIONS[name]).isNull(), F.get(node, 0))


def _rows_where(condition: Column, *row: Column) -> Column:
    """Generator of one row where the condition holds, none elsewhere.

    A plain filter on a parsed column would be pushed below the parse and parse every document
    a second time; a generator is not.
    """
    return F.inline(F.when(condition, F.array(F.struct(*row))))


def rejected(parsed: DataFrame) -> DataFrame:
    """Documents and sections that could not be read, with the reason; ``section`` is null for a
    whole document. All but the struct is kept."""
    kept = [F.col(name) for name in parsed.columns if name not in ("cv", "reject", "bad_sections")]
    whole = F.struct(F.lit(None).cast("string").alias("section"), F.col("reject").alias("reason"))
    faults = F.when(F.col("reject").isNotNull(), F.array(whole)).otherwise(F.col("bad_sections"))
    told = parsed.select(*kept, F.inline(faults))
    return told.select(*[F.col(name) for name in told.columns if name not in ("section", "reason")],
                       F.col("reason").alias("reject"), "section")


def _attributes(node: Column, mapping: Mapping[str, str]) -> list[Column]:
    return [node.getField(attribute).alias(column) for column, attribute in mapping.items()]


def researcher_rows(parsed: DataFrame) -> DataFrame:
    """One row of 23 columns per document: general data merged with the work address."""
    root = F.col("cv")
    general = root.getField("DADOS-GERAIS")
    address = general.getField("ENDERECO").getField("ENDERECO-PROFISSIONAL")
    values = dict(zip(S.GENERAL_ATTRIBUTES, _attributes(general, S.GENERAL_ATTRIBUTES)))
    for column, attribute in S.ROOT_ATTRIBUTES.items():
        own = root.getField(attribute)
        values[column] = falsy_coalesce(own, values[column]) if column in values else own
    for column, attribute in S.SUMMARY_ATTRIBUTES.items():
        values[column] = general.getField("RESUMO-CV").getField(attribute)
    general_columns = [name for name in S.RESEARCHER_COLUMNS if name in values]
    records = parsed.select(
        _rows_where(
            root.isNotNull(),
            F.struct(*[values[name].alias(name) for name in general_columns]).alias("general"),
            F.struct(*_attributes(address, S.ADDRESS_ATTRIBUTES)).alias("address"),
        )
    )
    return merge_records(records, "general", "address").select(*S.RESEARCHER_COLUMNS)


def _member_rows(members: Column, mapping: Mapping[str, str], columns, **fixed: str) -> Column:
    """A list of children as row structs with all of ``columns``; empty children are skipped."""

    def filled(member: Column) -> Column:
        return F.coalesce(*[member.getField(a) for a in mapping.values()]).isNotNull()

    def row(member: Column) -> Column:
        cells = {name: F.lit(value) for name, value in fixed.items()}
        cells |= {name: member.getField(attribute) for name, attribute in mapping.items()}
        absent = F.lit(None).cast("string")
        return F.struct(*[cells.get(name, absent).cast("string").alias(name) for name in columns])

    return F.transform(F.filter(F.coalesce(members, F.array()), filled), row)


def education_rows(parsed: DataFrame) -> DataFrame:
    """All degrees of all kinds, each document read once; columns a kind lacks are null."""
    node = _sound_section("FORMACAO-ACADEMICA-TITULACAO")
    kinds = [
        _member_rows(node.getField(kind), mapping, S.EDUCATION_COLUMNS, tipo_formacao=kind)
        for kind, mapping in S.EDUCATION_ATTRIBUTES.items()
    ]
    return _with_document_key(parsed, F.concat(*kinds), S.EDUCATION_COLUMNS)


def area_rows(parsed: DataFrame) -> DataFrame:
    """All areas of expertise."""
    node = _sound_section("AREAS-DE-ATUACAO")
    rows = _member_rows(node.getField("AREA-DE-ATUACAO"), S.AREA_ATTRIBUTES, S.AREA_ATTRIBUTES)
    return _with_document_key(parsed, rows, S.AREA_ATTRIBUTES)


def _with_document_key(parsed: DataFrame, rows: Column, columns) -> DataFrame:
    """Rows of a document with its key. A rejected document has neither."""
    key = F.col("cv").getField(S.ROOT_ATTRIBUTES["lattes_id"]).alias("lattes_id")
    return parsed.select(key, F.inline(rows)).select(*columns, "lattes_id")
