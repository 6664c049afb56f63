"""Scholarly inputs derived from the given tables, row by row."""

import zipfile

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.functions import encode_json
from vitaelake.session import scratch_location
from vitaelake.sources.archive import file_system

API = "https://api.example.org/"
ORCID = "https://orcid.example.org/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, several parts for each, as a file of one row group is one task's however
    many splits it has, and long texts are not dealt alike."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(df.rdd.getNumPartitions(), 4 * cores)
    return df.repartition(parts, F.xxhash64(*df.columns))


def text(*parts) -> Column:
    """Concatenation of columns and literals as text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def day(start: str, days: Column, pattern: str) -> Column:
    return F.date_format(F.date_add(F.lit(start).cast("date"), days.cast("int")), pattern)


def _bind(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def index_from_text(words_text: Column) -> Column:
    """Inverted index (map of word -> positions) of a text's blank-separated words."""
    words = F.filter(F.split(words_text, " "), lambda word: word != "")
    placed = F.sort_array(
        F.transform(words, lambda word, i: F.struct(word.alias("word"), i.alias("position")))
    )

    def grouped(sorted_words: Column) -> Column:
        words, count = sorted_words["word"], F.size(sorted_words)
        positions = sorted_words["position"].cast("array<bigint>")
        return _bind(F.struct(words.alias("words"), positions.alias("positions")), lambda both: _bind(
            F.filter(
                F.sequence(F.lit(0), count - 1),
                lambda i: (i == 0) | (F.get(both["words"], i) != F.get(both["words"], i - 1)),
            ),
            lambda firsts: F.map_from_arrays(
                F.transform(firsts, lambda first: F.get(both["words"], first)),
                F.transform(
                    firsts,
                    lambda first, k: F.slice(
                        both["positions"],
                        first + 1,
                        F.coalesce(F.get(firsts, k + 1), count) - first,
                    ),
                ),
            ),
        ))

    return _bind(placed, lambda ws: F.when(F.size(ws) > 0, grouped(ws)))


def author_number(key: Column, place: Column) -> Column:
    """Numbers over the suppliers' keys, of which there are a tenth as many as documents."""
    return F.floor(key / 10) + place * 3


def authorships(key: Column, source: Column, lang: Column) -> Column:
    """0 to 4 authors, or none at all, with every kind of gap."""

    def authorship(place: Column) -> Column:
        number = author_number(key, place)
        return F.struct(
            F.when((place == 1) & (key % 8 == 0), F.lit(None))
            .otherwise(F.element_at(F.array(*map(F.lit, ["first", "middle", "last", "guest"])),
                                    (place + 1).cast("int")))
            .alias("author_position"),
            F.when(place == 0, True).when(place == 1, False).alias("is_corresponding"),
            text("Author ", number).alias("raw_author_name"),
            F.when(place % 3 == 0, F.array(source, F.lit(None).cast("string"), lang))
            .when(place % 3 == 1, F.array().cast("array<string>"))
            .alias("raw_affiliation_strings"),
            F.array(lang).alias("countries"),
            F.array(F.struct(source.alias("id"), source.alias("display_name"))).alias(
                "institutions"
            ),
            F.when(
                (key + place) % 9 != 0,
                F.struct(
                    text(API + "A", number).alias("id"),
                    text("Author ", number).alias("display_name"),
                    F.when(number % 10 != 9, text(ORCID, number)).alias("orcid"),
                ),
            ).alias("author"),
        )

    count = key % 5
    places = F.when(count > 0, F.sequence(F.lit(0).cast("bigint"), count - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.when(key % 6 != 5, F.transform(places, authorship))


def bronze_works(spark: SparkSession, sf_dir: str, encoded: bool = True) -> DataFrame:
    """Every document as a bronze work: its text is the title and, indexed, the abstract.

    The index is JSON text, some of it cut short, or the map the service sends.
    """
    docs = spread(table(spark, sf_dir, "documents"))
    key, body, lang, source = (F.col(name) for name in ("doc_id", "text", "lang", "source"))
    index = index_from_text(body)
    if encoded:
        index = F.when(key % 17 == 0, F.lit('{"cut": [0')).otherwise(encode_json(index))
    else:
        index = F.when(key % 17 != 0, index)
    journal = F.when(
        key % 7 != 0,
        F.struct(source.alias("display_name"), text("1234-", key % 90 + 10).alias("issn_l")),
    )
    return docs.select(
        text(API + "W", key).alias("id"),
        F.when(key % 3 != 0, text("https://doi.example.org/", F.floor(key / 4))).alias("doi"),
        F.when(key % 11 != 0, body).alias("display_name"),
        text(source, "-", key).alias("title"),
        (key % 35 + 1990).alias("publication_year"),
        F.when(key % 10 != 0, day("2000-01-01", key % 9000, "yyyy-MM-dd")).alias(
            "publication_date"
        ),
        F.element_at(F.array(*map(F.lit, ["article", "book", "book-chapter", "dataset"])),
                     (key % 4 + 1).cast("int")).alias("type"),
        lang.alias("language"),
        F.when(key % 13 != 0, index).alias("abstract_inverted_index"),
        F.col("n_chars").alias("cited_by_count"),
        F.lit("{}").alias("open_access"),
        F.when(key % 5 != 0, F.struct(journal.alias("source"), F.lit("cc-by").alias("license")))
        .alias("primary_location"),
        F.lit("{}").alias("best_oa_location"),
        authorships(key, source, lang).alias("authorships"),
        F.lit("{}").alias("ids"),
        F.lit("{}").alias("biblio"),
        text(day("2010-01-01", key % 5000, "yyyy-MM-dd"), "T10:20:30").alias("created_date"),
        F.lit("2024-05-01").alias("updated_date"),
        F.when(key % 4 == 1, F.array().cast("array<struct<display_name:string>>"))
        .when(
            key % 4 != 0,
            F.array(
                F.struct(lang.alias("display_name")),
                F.lit(None).cast("struct<display_name:string>"),
                F.struct(source.alias("display_name")),
            ),
        )
        .alias("keywords"),
        F.lit("[]").alias("topics"),
        (key % 40).alias("referenced_works_count"),
    )


def bronze_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a bronze author; some share an ORCID, some have none."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey").cast("bigint")
    shared = F.when(key % 20 == 1, key - 1).otherwise(key)
    return table(spark, sf_dir, "supplier").select(
        text(API + "A", key).alias("id"),
        F.when(key % 10 != 9, text(ORCID, shared)).alias("orcid"),
        F.col("s_name").alias("display_name"),
        F.col("s_name").alias("full_name"),
        (nation * 10).alias("works_count"),
        (nation * 100 + key).alias("cited_by_count"),
        F.struct((key % 60).alias("h_index"), nation.alias("i10_index")).alias("summary_stats"),
        F.lit("2024-05-01").alias("updated_date"),
        text(API + "works?filter=A", key).alias("works_api_url"),
    )


def orcid_of_customer() -> Column:
    key = F.col("c_custkey")
    return F.when(key % 4 != 3, text(ORCID, key))


def bronze_researchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a bronze researcher (the columns silver reads); a quarter have no
    ORCID."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.lpad(key.cast("string"), 16, "0").alias("lattes_id"),
        orcid_of_customer().alias("orcid_id"),
        F.col("c_name").alias("nome_completo"),
        text("Country ", F.col("c_nationkey")).alias("nacionalidade"),
        day("2020-01-01", key % 1500, "ddMMyyyy").alias("data_atualizacao"),
        text("CV of ", F.col("c_name")).alias("texto_resumo_cv"),
        F.col("c_mktsegment").alias("instituicao_empresa"),
        text("Unit ", key % 9).alias("nome_orgao"),
        text(key % 100).alias("codigo_instituicao"),
    )


def landed_pages(spark: SparkSession, records: DataFrame, per_page: int, label: str) -> DataFrame:
    """Records (``filter``, ``number`` from 0 within it, ``record`` as JSON) as a stored table of page
    bodies, as they come from a paged service: filter, page, body."""
    page = (F.floor(F.col("number") / per_page) + 1).alias("page")
    total = records.groupBy("filter").agg(F.count(F.lit(1)).alias("total"))
    listed = F.sort_array(F.collect_list(F.struct("number", "record")))
    pages = records.groupBy("filter", page).agg(
        F.array_join(F.transform(listed, lambda one: one["record"]), ",").alias("results")
    )
    body = text('{"meta":{"count":', F.col("total"), '},"results":[', F.col("results"), "]}")
    folder = scratch_location(spark, label)
    pages.join(total, "filter").select("filter", "page", body.alias("body")).write.parquet(folder)
    return spark.read.schema("filter string, page long, body string").parquet(folder)


# --- CV documents -------------------------------------------------------------------------


def _degrees(count: Column, key: Column, attributes: dict[str, str]) -> Column:
    places = F.when(count > 0, F.sequence(F.lit(1).cast("bigint"), count)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.transform(
        places,
        lambda place: F.struct(
            *[text(label, " ", key, "/", place).alias(name) for name, label in attributes.items()]
        ),
    )


def cv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a CV document: ``entry``, ``xml`` (every 7th one cut short)."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("bigint")
    own_date = (
        F.when(key % 5 == 0, F.lit(""))
        .when(key % 5 != 1, day("2020-01-01", key % 1500, "ddMMyyyy"))
    )
    general = F.struct(
        orcid_of_customer().alias("@ORCID-ID"),
        F.col("c_name").alias("@NOME-COMPLETO"),
        text("Country ", nation).alias("@PAIS-DE-NACIONALIDADE"),
        F.lit("São Luís").alias("@CIDADE-NASCIMENTO"),
        F.lit("31122019").alias("@DATA-ATUALIZACAO"),
        F.lit("101112").alias("@DATA-HORA-ATUALIZACAO"),
        F.when(
            key % 3 != 0,
            F.struct(
                text(" <", F.col("c_name"), "> & \"", F.col("c_mktsegment"), "\" é ").alias(
                    "@TEXTO-RESUMO-CV-RH"
                )
            ),
        ).alias("RESUMO-CV"),
        F.when(
            key % 6 != 0,
            F.struct(
                F.struct(
                    F.col("c_mktsegment").alias("@NOME-INSTITUICAO-EMPRESA"),
                    text(key % 100).alias("@CODIGO-INSTITUICAO-EMPRESA"),
                    text("mail", key, "@example.org").alias("@E-MAIL"),
                ).alias("ENDERECO-PROFISSIONAL")
            ),
        ).alias("ENDERECO"),
        F.when(
            key % 8 != 0,
            F.struct(
                _degrees(key % 3, key, {
                    "@CODIGO-CURSO": "c", "@NOME-CURSO": "Course", "@STATUS-DO-CURSO": "s",
                    "@TITULO-DO-TRABALHO-DE-CONCLUSAO-DE-CURSO": "Work",
                    "@NOME-DO-ORIENTADOR": "Advisor",
                }).alias("GRADUACAO"),
                _degrees(nation % 2, key, {
                    "@NOME-CURSO": "Master", "@TITULO-DA-DISSERTACAO-TESE": "Dissertation",
                    "@NOME-COMPLETO-DO-ORIENTADOR": "Advisor", "@NOME-AGENCIA": "Agency",
                }).alias("MESTRADO"),
                _degrees(key % 2, key, {
                    "@NOME-CURSO": "Doctor", "@TITULO-DA-DISSERTACAO-TESE": "Thesis",
                    "@NOME-COMPLETO-DO-ORIENTADOR": "Advisor",
                }).alias("DOUTORADO"),
                _degrees(nation % 3, key, {
                    "@STATUS-DO-ESTAGIO": "stage", "@NOME-DA-AGENCIA": "Agency",
                }).alias("POS-DOUTORADO"),
            ),
        ).alias("FORMACAO-ACADEMICA-TITULACAO"),
        F.when(
            key % 9 != 0,
            F.struct(
                _degrees(key % 4, key, {
                    "@SEQUENCIA-AREA-DE-ATUACAO": "n",
                    "@NOME-GRANDE-AREA-DO-CONHECIMENTO": "Field",
                    "@NOME-DA-ESPECIALIDADE": "Topic",
                }).alias("AREA-DE-ATUACAO")
            ),
        ).alias("AREAS-DE-ATUACAO"),
    )
    document = F.struct(
        F.lpad(key.cast("string"), 16, "0").alias("@NUMERO-IDENTIFICADOR"),
        own_date.alias("@DATA-ATUALIZACAO"),
        general.alias("DADOS-GERAIS"),
    )
    xml = F.to_xml(document, {"rowTag": "CURRICULO-VITAE", "attributePrefix": "@"})
    whole = text(
        F.when(key % 2 == 0, '<?xml version="1.0" encoding="UTF-8"?>')
        .otherwise('<?xml version="1.0" encoding="ISO-8859-1" standalone="no"?>'),
        "\n",
        xml,
    )
    extension = F.when(key % 50 == 49, ".XML").otherwise(".xml")
    return spread(table(spark, sf_dir, "customer")).select(
        F.concat(F.lpad(key.cast("string"), 16, "0"), extension).alias("entry"),
        F.when(key % 7 == 3, F.left(whole, F.length(whole) - 20)).otherwise(whole).alias("xml"),
    )


def odd_section_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cv_documents`` with sections of the wrong shape: a text instead of all education (every
    10th, from 4), the areas twice (from 6), a degree that is a text beside the others (from 8)."""
    documents = cv_documents(spark, sf_dir)
    key, xml = F.substring_index("entry", ".", 1).cast("long"), F.col("xml")
    education, areas = "FORMACAO-ACADEMICA-TITULACAO", "AREAS-DE-ATUACAO"
    whole = rf"(?s)<{education}>.*</{education}>"
    twice = rf"(?s)(<{areas}>.*</{areas}>)"
    odd = (
        F.when(key % 10 == 4, F.regexp_replace(xml, whole, f"<{education}>see annex</{education}>"))
        .when(key % 10 == 6, F.regexp_replace(xml, twice, "$1$1"))
        .when(
            key % 10 == 8,
            F.regexp_replace(xml, f"</{education}>", f"<MESTRADO>lost</MESTRADO></{education}>"),
        )
        .otherwise(xml)
    )
    return documents.withColumn("xml", odd)


def write_archives(documents: DataFrame, folder: str) -> None:
    """Pack documents (``entry``, ``xml``) into zip files, one per task, each with a stray
    non-XML entry. A retried task writes the same file again."""

    def pack(batches):
        filesystem, root = file_system(folder)
        filesystem.create_dir(root, recursive=True)
        number = TaskContext.get().partitionId()
        name = f"{root}/curricula-{number:05d}.zip"
        count = 0
        with filesystem.open_output_stream(name) as out, zipfile.ZipFile(
            out, "w", zipfile.ZIP_DEFLATED
        ) as archive:
            archive.writestr("readme.txt", "not a document")
            for batch in batches:
                for row in batch.to_pylist():
                    charset = "iso-8859-1" if 'encoding="ISO-8859-1"' in row["xml"] else "utf-8"
                    archive.writestr(row["entry"], row["xml"].encode(charset))
                    count += 1
        yield pa.RecordBatch.from_pydict({"documents": [count]})

    packed = documents.mapInArrow(pack, "documents BIGINT")
    packed.write.format("noop").mode("overwrite").save()
