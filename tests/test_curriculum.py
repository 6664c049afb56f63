import zipfile

import pytest
from conftest import rows

from vitaelake import schemas as S
from vitaelake.operators import curriculum
from vitaelake.sources import archive

GENERAL = """<DADOS-GERAIS ORCID-ID="o1" NOME-COMPLETO=" Ana Sá " NOME-EM-CITACOES-BIBLIOGRAFICAS="SÁ, A."
  PAIS-DE-NACIONALIDADE="Brasil" PAIS-DE-NASCIMENTO="Brasil" UF-NASCIMENTO="SP" CIDADE-NASCIMENTO="Itu"
  DATA-ATUALIZACAO="02022020" DATA-HORA-ATUALIZACAO="202020" SIGLA-PAIS-NACIONALIDADE="BRA">"""

FULL = f"""<?xml version="1.0" encoding="ISO-8859-1" standalone="no"?>
<CURRICULO-VITAE NUMERO-IDENTIFICADOR="1" DATA-ATUALIZACAO="01012020" HORA-ATUALIZACAO="">
{GENERAL}
<RESUMO-CV TEXTO-RESUMO-CV-RH="A &amp; B &lt;c&gt;"/>
<ENDERECO FLAG="x"><ENDERECO-PROFISSIONAL NOME-INSTITUICAO-EMPRESA="USP" CODIGO-INSTITUICAO-EMPRESA="9"
  NOME-ORGAO="IME" NOME-UNIDADE="U" LOGRADOURO-COMPLEMENTO="R" PAIS="Brasil" UF="SP" CIDADE="São Paulo"
  BAIRRO="B" E-MAIL="e" HOME-PAGE="h"/></ENDERECO>
<FORMACAO-ACADEMICA-TITULACAO>
  <GRADUACAO CODIGO-CURSO="c" NOME-CURSO="n" CODIGO-INSTITUICAO="ci" NOME-INSTITUICAO="ni"
    STATUS-DO-CURSO="s" ANO-DE-INICIO="2000" ANO-DE-CONCLUSAO="" TITULO-DO-TRABALHO-DE-CONCLUSAO-DE-CURSO="t"
    NOME-DO-ORIENTADOR="o"><CHILD A="1"/></GRADUACAO>
  <GRADUACAO NOME-CURSO="second"/>
  <GRADUACAO/>
  <MESTRADO NOME-CURSO="m" TITULO-DA-DISSERTACAO-TESE="d" NOME-COMPLETO-DO-ORIENTADOR="mo"
    CODIGO-AGENCIA-FINANCIADORA="ca" NOME-AGENCIA="na"/>
  <DOUTORADO NOME-CURSO="d" TITULO-DA-DISSERTACAO-TESE="tt" NOME-COMPLETO-DO-ORIENTADOR="do"/>
  <POS-DOUTORADO STATUS-DO-ESTAGIO="st" NOME-DA-AGENCIA="pa" NOME-CURSO="ignored"/>
</FORMACAO-ACADEMICA-TITULACAO>
<AREAS-DE-ATUACAO>
  <AREA-DE-ATUACAO SEQUENCIA-AREA-DE-ATUACAO="1" NOME-GRANDE-AREA-DO-CONHECIMENTO="g"
    CODIGO-GRANDE-AREA-DO-CONHECIMENTO="cg" NOME-DA-AREA-DO-CONHECIMENTO="a" CODIGO-DA-AREA-DO-CONHECIMENTO="ca"
    NOME-DA-SUB-AREA-DO-CONHECIMENTO="sa" CODIGO-DA-SUB-AREA-DO-CONHECIMENTO="cs" NOME-DA-ESPECIALIDADE="e"
    CODIGO-DA-ESPECIALIDADE="ce"/>
  <AREA-DE-ATUACAO SEQUENCIA-AREA-DE-ATUACAO="2"/>
</AREAS-DE-ATUACAO>
</DADOS-GERAIS></CURRICULO-VITAE>
"""
BARE = '<CURRICULO-VITAE NUMERO-IDENTIFICADOR="2"/>'
EMPTY_NODES = (
    '<CURRICULO-VITAE NUMERO-IDENTIFICADOR="3"><DADOS-GERAIS DATA-ATUALIZACAO="03032020">'
    "<RESUMO-CV/><ENDERECO/><FORMACAO-ACADEMICA-TITULACAO/><AREAS-DE-ATUACAO/>"
    "</DADOS-GERAIS></CURRICULO-VITAE>"
)
POST_DOC_ONLY = (
    '<!-- note --><CURRICULO-VITAE NUMERO-IDENTIFICADOR="4"><DADOS-GERAIS>'
    '<FORMACAO-ACADEMICA-TITULACAO><POS-DOUTORADO ANO-DE-INICIO="2001"/>'
    "</FORMACAO-ACADEMICA-TITULACAO></DADOS-GERAIS></CURRICULO-VITAE>"
)
OTHER_ROOT = '<OTHER NUMERO-IDENTIFICADOR="5"><DADOS-GERAIS ORCID-ID="o"/></OTHER>'
GOOD = [FULL, BARE, EMPTY_NODES, POST_DOC_ONLY, OTHER_ROOT]
BAD = {
    FULL[:900]: "malformed XML",
    BARE.replace("/>", ">"): "malformed XML",
    BARE + "junk": "text after the root element",
    "": "malformed XML",
    '<CURRICULO-VITAE A="1" A="2"/>': "malformed XML",
}


@pytest.fixture(scope="module")
def parsed(spark):
    documents = [(text,) for text in [*GOOD, *BAD, None]]
    return curriculum.parse_documents(spark.createDataFrame(documents, "xml STRING")).cache()


def test_rejects(parsed):
    got = curriculum.rejected(parsed).select("xml", "reject")
    assert rows(got) == sorted([*BAD.items(), (None, "document is empty")], key=repr)


def test_researchers(parsed):
    out = curriculum.researcher_rows(parsed)
    assert out.columns == S.RESEARCHER_COLUMNS and len(out.columns) == 23
    got = {row.lattes_id: row.asDict() for row in out.collect()}
    assert set(got) == {"1", "2", "3", "4", None}
    assert list(got["1"].values()) == [
        "1", "o1", " Ana Sá ", "SÁ, A.", "Brasil", "Brasil", "SP", "Itu", "01012020", "202020",
        "BRA", "A & B <c>", "USP", "9", "IME", "U", "R", "Brasil", "SP", "São Paulo", "B", "e",
        "h",
    ]
    assert [v for v in got["2"].values() if v is not None] == ["2"]
    assert [v for v in got["3"].values() if v is not None] == ["3", "03032020"]
    assert set(got[None].values()) == {None}


def test_education(parsed):
    out = curriculum.education_rows(parsed)
    assert out.columns == [*S.EDUCATION_COLUMNS, "lattes_id"] and len(out.columns) == 15
    absent = {name: None for name in out.columns}
    expected = [
        dict(
            tipo_formacao="GRADUACAO", codigo_curso="c", nome_curso="n", codigo_instituicao="ci",
            nome_instituicao="ni", status="s", ano_inicio="2000", ano_conclusao="",
            titulo_trabalho="t", nome_orientador="o", lattes_id="1",
        ),
        dict(tipo_formacao="GRADUACAO", nome_curso="second", lattes_id="1"),
        dict(
            tipo_formacao="MESTRADO", nome_curso="m", titulo_dissertacao="d",
            nome_orientador="mo", codigo_agencia_financiadora="ca", nome_agencia="na",
            lattes_id="1",
        ),
        dict(
            tipo_formacao="DOUTORADO", nome_curso="d", titulo_tese="tt", nome_orientador="do",
            lattes_id="1",
        ),
        dict(tipo_formacao="POS-DOUTORADO", status="st", nome_agencia="pa", lattes_id="1"),
        dict(tipo_formacao="POS-DOUTORADO", ano_inicio="2001", lattes_id="4"),
    ]
    assert rows(out) == sorted([tuple((absent | e).values()) for e in expected], key=repr)


def test_areas(parsed):
    out = curriculum.area_rows(parsed)
    assert out.columns == [*S.AREA_ATTRIBUTES, "lattes_id"] and len(out.columns) == 10
    assert rows(out) == sorted(
        [
            ("1", "g", "cg", "a", "ca", "sa", "cs", "e", "ce", "1"),
            ("2", *[None] * 8, "1"),
        ],
        key=repr,
    )


def sectioned(key, education="", areas=""):
    return (
        f'<CURRICULO-VITAE NUMERO-IDENTIFICADOR="{key}"><DADOS-GERAIS NOME-COMPLETO="n{key}">\n'
        f"{education}\n{areas}\n</DADOS-GERAIS></CURRICULO-VITAE>"
    )


DEGREE = '<GRADUACAO NOME-CURSO="c"/>'
AREA = '<AREAS-DE-ATUACAO>\n <AREA-DE-ATUACAO SEQUENCIA-AREA-DE-ATUACAO="1"/>\n</AREAS-DE-ATUACAO>'


def education(inside):
    return f"<FORMACAO-ACADEMICA-TITULACAO>{inside}</FORMACAO-ACADEMICA-TITULACAO>"


def test_sections_of_the_wrong_shape_are_set_apart(spark):
    """The researcher and the other section stay."""
    documents = [
        sectioned(1, education(DEGREE), AREA),
        sectioned(2, education("see annex"), AREA),
        sectioned(3, education(DEGREE + "<MESTRADO>lost</MESTRADO>"), AREA),
        sectioned(4, education(DEGREE) * 2, AREA),
        sectioned(5, education(DEGREE), AREA * 2),
        sectioned(6, education(DEGREE), "<AREAS-DE-ATUACAO>none</AREAS-DE-ATUACAO>"),
        sectioned(7, education("a"), "<AREAS-DE-ATUACAO>b</AREAS-DE-ATUACAO>"),
        sectioned(8, education("<GRADUACAO/><MESTRADO/>"), "<AREAS-DE-ATUACAO><AREA-DE-ATUACAO/></AREAS-DE-ATUACAO>"),
        sectioned(9, education(DEGREE)[:50], AREA),
    ]
    parsed = curriculum.parse_documents(
        spark.createDataFrame([(text, "t") for text in documents], "xml STRING, other STRING")
    ).cache()
    assert [row.lattes_id for row in curriculum.researcher_rows(parsed).orderBy("lattes_id").collect()] == list("12345678")
    assert sorted(row.lattes_id for row in curriculum.education_rows(parsed).collect()) == ["1", "5", "6"]
    assert sorted(row.lattes_id for row in curriculum.area_rows(parsed).collect()) == ["1", "2", "3", "4"]
    rejects = curriculum.rejected(parsed)
    assert rejects.columns == ["xml", "other", "reject", "section"]
    part, areas = "FORMACAO-ACADEMICA-TITULACAO", "AREAS-DE-ATUACAO"
    text, twice = "text in place of entries", "section occurs twice"
    expected = [
        (documents[1], text, part), (documents[2], "text in place of an entry's attributes", part),
        (documents[3], twice, part), (documents[4], twice, areas), (documents[5], text, areas),
        (documents[6], text, part), (documents[6], text, areas), (documents[8], "malformed XML", None),
    ]
    assert rows(rejects.select("xml", "reject", "section")) == sorted(expected, key=repr)


def test_each_document_is_parsed_once(spark):
    documents = curriculum.parse_documents(spark.createDataFrame([(BARE,)], "xml STRING"))
    for table in (
        curriculum.researcher_rows(documents),
        curriculum.education_rows(documents),
        curriculum.area_rows(documents),
        curriculum.rejected(documents),
    ):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_xml(") == 1


ENTRIES = {
    "a.xml": FULL.encode("iso-8859-1"),
    "deep/b.xml": BARE.encode(),
    "c.XML": BARE.encode(),
    "d.txt": b"no",
    "bom.xml": b"\xef\xbb\xbf" + BARE.encode(),
    "wide.xml": BARE.encode("utf-16"),
    "nome-é.xml": BARE.encode(),
    "bad-bytes.xml": b'<CURRICULO-VITAE A="\xff"/>',
    "unknown.xml": b"<?xml version='1.0' encoding='no-such'?><CURRICULO-VITAE/>",
    "empty.xml": b"",
}


@pytest.fixture()
def archives(tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as one:
        for name, data in ENTRIES.items():
            one.writestr(name, data)
    with open(tmp_path / "two.zip", "wb") as out:
        out.write(b"self-extracting prefix")
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as two:
            two.comment = b"a note"
            for i in range(300):
                two.writestr(f"{i:04}.xml", BARE.encode())
    with zipfile.ZipFile(tmp_path / "wide.zip", "w") as three:
        with three.open("big.xml", "w", force_zip64=True) as entry:
            entry.write(BARE.encode())
    zipfile.ZipFile(tmp_path / "none.zip", "w").close()
    (tmp_path / "other.dat").write_bytes(b"not an archive")
    return tmp_path


def test_entry_listing_matches_the_standard_library(spark, archives):
    listed = archive.list_entries(archive.archive_files(spark, str(archives)))
    got = {(row.path.rsplit("/", 1)[1], row.entry, row.size, row.packed_size, row.crc)
           for row in listed.collect()}
    expected = set()
    for path in archives.glob("*.zip"):
        with zipfile.ZipFile(path) as one:
            expected |= {
                (path.name, i.filename, i.file_size, i.compress_size, i.CRC)
                for i in one.infolist()
            }
    assert got == expected


def test_archive_documents(spark, archives):
    documents = archive.read_archives(spark, str(archives))
    got = {(row.path.rsplit("/", 1)[1], row.entry): (row.xml, row.error)
           for row in documents.collect()}
    one = {entry: value for (path, entry), value in got.items() if path == "one.zip"}
    assert set(one) == {name for name in ENTRIES if name.endswith(".xml")}
    assert one["a.xml"] == (FULL, None)
    assert one["bom.xml"] == one["wide.xml"] == one["nome-é.xml"] == (BARE, None)
    assert one["empty.xml"] == ("", None)
    assert one["bad-bytes.xml"][0] is None and "UnicodeDecodeError" in one["bad-bytes.xml"][1]
    assert one["unknown.xml"][0] is None and "LookupError" in one["unknown.xml"][1]
    assert [value for (path, _), value in got.items() if path == "two.zip"] == [(BARE, None)] * 300
    assert got["wide.zip", "big.xml"] == (BARE, None)


def test_damaged_entry_is_reported_alone(spark, tmp_path):
    path = tmp_path / "hurt.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as one:
        one.writestr("a.xml", BARE.encode())
        one.writestr("b.xml", BARE.encode())
    data = bytearray(path.read_bytes())
    data[data.index(b"VITAE")] = ord("W")
    path.write_bytes(bytes(data))
    documents = archive.read_archives(spark, str(tmp_path))
    got = {row.entry: (row.xml, row.error) for row in documents.collect()}
    assert got["a.xml"] == (None, "ValueError: entry checksum differs")
    assert got["b.xml"] == (BARE, None)


def test_directory_is_streamed(tmp_path):
    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w") as many:
        for i in range(20_000):
            many.writestr(f"{'x' * 100}{i}.xml", b"")
    with archive._open(str(path)) as handle:
        names = [entry[0] for entry in archive.directory_entries(handle)]
    assert len(set(names)) == 20_000


def test_one_archive_is_read_by_many_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_STORED) as one:
        for i in range(40):
            one.writestr(f"{i}.xml", b"<CURRICULO-VITAE/>" + b" " * (1 << 20))
    documents = archive.read_archives(spark, str(tmp_path))
    parts = {row[0] for row in documents.selectExpr("spark_partition_id()").collect()}
    assert len(parts) > 1
    assert documents.count() == 40


def test_many_small_archives_need_no_shuffle(spark, tmp_path):
    for i in range(12):
        with zipfile.ZipFile(tmp_path / f"{i:02}.zip", "w", zipfile.ZIP_STORED) as one:
            one.writestr("a.xml", BARE.encode())
            one.writestr("b.txt", b"no")
    documents = archive.read_archives(spark, str(tmp_path))
    assert "Exchange" not in documents._jdf.queryExecution().executedPlan().toString()
    assert documents.count() == 12


def test_split_and_whole_reading_agree(spark, archives):
    def read(bytes_per_task):
        found = archive.read_archives(spark, str(archives), bytes_per_task=bytes_per_task)
        return rows(found)

    assert read(2000) == read(1 << 30)
