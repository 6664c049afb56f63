"""Declared schemas and table contracts.

The element, attribute, field and column names below are fixed values: they belong to the
public CV and bibliographic record formats and to the bronze and silver table contracts.
"""

from pyspark.sql import types as T

# --- CV document (XML) --------------------------------------------------------------------

CV_ROOT = "CURRICULO-VITAE"

# Bronze column <- attribute of each place in the document.
GENERAL_ATTRIBUTES = {
    "orcid_id": "@ORCID-ID",
    "nome_completo": "@NOME-COMPLETO",
    "nome_citacao": "@NOME-EM-CITACOES-BIBLIOGRAFICAS",
    "nacionalidade": "@PAIS-DE-NACIONALIDADE",
    "pais_nascimento": "@PAIS-DE-NASCIMENTO",
    "uf_nascimento": "@UF-NASCIMENTO",
    "cidade_nascimento": "@CIDADE-NASCIMENTO",
    "data_atualizacao": "@DATA-ATUALIZACAO",
    "data_hora_atualizacao": "@DATA-HORA-ATUALIZACAO",
    "sigla_pais_nacionalidade": "@SIGLA-PAIS-NACIONALIDADE",
}
# The root's own attribute is preferred for these two columns.
ROOT_ATTRIBUTES = {
    "lattes_id": "@NUMERO-IDENTIFICADOR",
    "data_atualizacao": "@DATA-ATUALIZACAO",
    "data_hora_atualizacao": "@HORA-ATUALIZACAO",
}
SUMMARY_ATTRIBUTES = {"texto_resumo_cv": "@TEXTO-RESUMO-CV-RH"}
ADDRESS_ATTRIBUTES = {
    "instituicao_empresa": "@NOME-INSTITUICAO-EMPRESA",
    "codigo_instituicao": "@CODIGO-INSTITUICAO-EMPRESA",
    "nome_orgao": "@NOME-ORGAO",
    "nome_unidade": "@NOME-UNIDADE",
    "logradouro": "@LOGRADOURO-COMPLEMENTO",
    "pais": "@PAIS",
    "uf": "@UF",
    "cidade": "@CIDADE",
    "bairro": "@BAIRRO",
    "email": "@E-MAIL",
    "home_page": "@HOME-PAGE",
}
_COURSE = {
    "codigo_curso": "@CODIGO-CURSO",
    "nome_curso": "@NOME-CURSO",
    "codigo_instituicao": "@CODIGO-INSTITUICAO",
    "nome_instituicao": "@NOME-INSTITUICAO",
    "status": "@STATUS-DO-CURSO",
    "ano_inicio": "@ANO-DE-INICIO",
    "ano_conclusao": "@ANO-DE-CONCLUSAO",
}
_GRADUATE = {
    "nome_orientador": "@NOME-COMPLETO-DO-ORIENTADOR",
    "codigo_agencia_financiadora": "@CODIGO-AGENCIA-FINANCIADORA",
    "nome_agencia": "@NOME-AGENCIA",
}
# Kind of education (also its element name) -> column <- attribute.
EDUCATION_ATTRIBUTES = {
    "GRADUACAO": {
        **_COURSE,
        "titulo_trabalho": "@TITULO-DO-TRABALHO-DE-CONCLUSAO-DE-CURSO",
        "nome_orientador": "@NOME-DO-ORIENTADOR",
    },
    "MESTRADO": {**_COURSE, "titulo_dissertacao": "@TITULO-DA-DISSERTACAO-TESE", **_GRADUATE},
    "DOUTORADO": {**_COURSE, "titulo_tese": "@TITULO-DA-DISSERTACAO-TESE", **_GRADUATE},
    "POS-DOUTORADO": {
        "codigo_instituicao": "@CODIGO-INSTITUICAO",
        "nome_instituicao": "@NOME-INSTITUICAO",
        "status": "@STATUS-DO-ESTAGIO",
        "ano_inicio": "@ANO-DE-INICIO",
        "ano_conclusao": "@ANO-DE-CONCLUSAO",
        "codigo_agencia_financiadora": "@CODIGO-AGENCIA-FINANCIADORA",
        "nome_agencia": "@NOME-DA-AGENCIA",
    },
}
AREA_ATTRIBUTES = {
    "sequencia": "@SEQUENCIA-AREA-DE-ATUACAO",
    "nome_grande_area": "@NOME-GRANDE-AREA-DO-CONHECIMENTO",
    "codigo_grande_area": "@CODIGO-GRANDE-AREA-DO-CONHECIMENTO",
    "nome_area": "@NOME-DA-AREA-DO-CONHECIMENTO",
    "codigo_area": "@CODIGO-DA-AREA-DO-CONHECIMENTO",
    "nome_sub_area": "@NOME-DA-SUB-AREA-DO-CONHECIMENTO",
    "codigo_sub_area": "@CODIGO-DA-SUB-AREA-DO-CONHECIMENTO",
    "nome_especialidade": "@NOME-DA-ESPECIALIDADE",
    "codigo_especialidade": "@CODIGO-DA-ESPECIALIDADE",
}

EDUCATION_COLUMNS = [
    "tipo_formacao",
    "codigo_curso",
    "nome_curso",
    "codigo_instituicao",
    "nome_instituicao",
    "status",
    "ano_inicio",
    "ano_conclusao",
    "titulo_trabalho",
    "titulo_dissertacao",
    "titulo_tese",
    "nome_orientador",
    "codigo_agencia_financiadora",
    "nome_agencia",
]

CORRUPT_RECORD = "_corrupt_record"
# Where the text of an element goes that holds text rather than attributes and children.
TEXT_VALUE = "_text"

# Sections that a researcher row does without, and the entries that each may hold.
SECTIONS = {
    "FORMACAO-ACADEMICA-TITULACAO": tuple(EDUCATION_ATTRIBUTES),
    "AREAS-DE-ATUACAO": ("AREA-DE-ATUACAO",),
}


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _children(**nodes) -> list[T.StructField]:
    return [T.StructField(name, type_) for name, type_ in nodes.items()]


def _section(**entries) -> T.ArrayType:
    """A section as often as it occurs, with text where there is some in place of its entries."""
    lists = {
        name: T.ArrayType(_strings([TEXT_VALUE, *attributes])) for name, attributes in entries.items()
    }
    return T.ArrayType(T.StructType(_strings([TEXT_VALUE]).fields + _children(**lists)))


CV_XML = T.StructType(
    _strings(ROOT_ATTRIBUTES.values()).fields
    + _children(
        **{
            "DADOS-GERAIS": T.StructType(
                _strings(GENERAL_ATTRIBUTES.values()).fields
                + _children(
                    **{
                        "RESUMO-CV": _strings(SUMMARY_ATTRIBUTES.values()),
                        "ENDERECO": T.StructType(
                            _children(
                                **{"ENDERECO-PROFISSIONAL": _strings(ADDRESS_ATTRIBUTES.values())}
                            )
                        ),
                        "FORMACAO-ACADEMICA-TITULACAO": _section(
                            **{
                                kind: attributes.values()
                                for kind, attributes in EDUCATION_ATTRIBUTES.items()
                            }
                        ),
                        "AREAS-DE-ATUACAO": _section(
                            **{"AREA-DE-ATUACAO": AREA_ATTRIBUTES.values()}
                        ),
                    }
                )
            )
        }
    )
)

# --- Bibliographic records (JSON) ---------------------------------------------------------


TEXT, WHOLE, FLAG = T.StringType(), T.LongType(), T.BooleanType()
RUN_TIME = T.TimestampNTZType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


BRONZE_AUTHORS = record(
    id=TEXT,
    orcid=TEXT,
    display_name=TEXT,
    full_name=TEXT,
    works_count=WHOLE,
    cited_by_count=WHOLE,
    summary_stats=record(h_index=WHOLE, i10_index=WHOLE),
    updated_date=TEXT,
    works_api_url=TEXT,
)

# Records no job reads (open_access, best_oa_location, ids, biblio, topics) stay JSON text,
# and so does the inverted index, which bronze stores as text.
BRONZE_WORKS = record(
    id=TEXT,
    doi=TEXT,
    display_name=TEXT,
    title=TEXT,
    publication_year=WHOLE,
    publication_date=TEXT,
    type=TEXT,
    language=TEXT,
    abstract_inverted_index=TEXT,
    cited_by_count=WHOLE,
    open_access=TEXT,
    primary_location=record(source=record(display_name=TEXT, issn_l=TEXT), license=TEXT),
    best_oa_location=TEXT,
    authorships=T.ArrayType(
        record(
            author_position=TEXT,
            is_corresponding=FLAG,
            raw_author_name=TEXT,
            raw_affiliation_strings=T.ArrayType(TEXT),
            countries=T.ArrayType(TEXT),
            institutions=T.ArrayType(record(id=TEXT, display_name=TEXT)),
            author=record(id=TEXT, display_name=TEXT, orcid=TEXT),
        )
    ),
    ids=TEXT,
    biblio=TEXT,
    created_date=TEXT,
    updated_date=TEXT,
    keywords=T.ArrayType(record(display_name=TEXT)),
    topics=TEXT,
    referenced_works_count=WHOLE,
)

# The two halves of the works job read only what they need of a bronze work.
BRONZE_WORKS_FOR_BRIDGE = record(
    id=TEXT,
    doi=TEXT,
    display_name=TEXT,
    authorships=T.ArrayType(
        record(
            author_position=TEXT,
            is_corresponding=FLAG,
            raw_author_name=TEXT,
            raw_affiliation_strings=T.ArrayType(TEXT),
            author=record(id=TEXT, orcid=TEXT),
        )
    ),
)
BRONZE_WORKS_FOR_SILVER = T.StructType(
    [
        BRONZE_WORKS[name]
        for name in (
            "id", "doi", "display_name", "title", "publication_year", "publication_date", "type",
            "language", "abstract_inverted_index", "cited_by_count", "primary_location",
            "created_date", "keywords", "referenced_works_count",
        )
    ]
)

# --- Bronze CV tables ---------------------------------------------------------------------

RESEARCHER_COLUMNS = [
    "lattes_id", "orcid_id", "nome_completo", "nome_citacao", "nacionalidade", "pais_nascimento",
    "uf_nascimento", "cidade_nascimento", "data_atualizacao", "data_hora_atualizacao",
    "sigla_pais_nacionalidade", "texto_resumo_cv", *ADDRESS_ATTRIBUTES,
]

BRONZE_RESEARCHERS = _strings(RESEARCHER_COLUMNS)
BRONZE_EDUCATION = _strings([*EDUCATION_COLUMNS, "lattes_id"])
BRONZE_AREAS = _strings([*AREA_ATTRIBUTES, "lattes_id"])
BRONZE_REJECTS = _strings(["path", "entry", "xml", "error", "reject", "section"])

# --- Silver name maps (fixed values: source column -> silver column, in order) -------------

AUTHOR_NAMES = {
    "openalex_id": "openalex_id",
    "orcid": "orcid_id",
    "h_index": "indice_h",
    "i10_index": "indice_i10",
    "works_count": "qtd_producoes",
    "cited_by_count": "qtd_citacoes_pesquisador",
    "works_api_url": "works_api_url",
    "updated_date": "updated_at",
}
WORK_NAMES = {
    "id": "openalex_id",
    "doi": "doi",
    "title": "titulo",
    "publication_year": "ano_publicacao",
    "publication_date": "data_publicacao",
    "type": "tipo_producao",
    "language": "idioma",
    "abstract": "abstract",
    "cited_by_count": "qtd_citacoes_producao",
    "referenced_works_count": "qtd_referencias_producao",
    "journal_name": "journal_name",
    "issn_l": "issn",
    "palavras_chave": "palavras_chave",
    "created_date": "created_at",
}
RESEARCHER_NAMES = {
    "lattes_id": "lattes_id",
    "orcid_id": "orcid_id",
    "openalex_id": "openalex_id",
    "nome_completo": "nome_completo",
    "texto_resumo_cv": "resumo_cv",
    "indice_h": "indice_h",
    "indice_i10": "indice_i10",
    "qtd_producoes": "qtd_producoes",
    "qtd_citacoes_pesquisador": "qtd_citacoes_pesquisador",
    "nacionalidade": "nacionalidade",
    "instituicao_empresa": "instituicao_empresa",
    "nome_orgao": "nome_orgao",
    "codigo_instituicao": "codigo_instituicao",
    "data_atualizacao": "data_atualizacao_lattes",
}

SILVER_AUTHORS = record(
    openalex_id=TEXT,
    orcid_id=TEXT,
    indice_h=WHOLE,
    indice_i10=WHOLE,
    qtd_producoes=WHOLE,
    qtd_citacoes_pesquisador=WHOLE,
    works_api_url=TEXT,
    updated_at=RUN_TIME,
)
SILVER_WORKS = record(
    openalex_id=TEXT,
    doi=TEXT,
    titulo=TEXT,
    ano_publicacao=WHOLE,
    data_publicacao=TEXT,
    tipo_producao=TEXT,
    idioma=TEXT,
    abstract=TEXT,
    qtd_citacoes_producao=WHOLE,
    qtd_referencias_producao=WHOLE,
    journal_name=TEXT,
    issn=TEXT,
    palavras_chave=T.ArrayType(TEXT),
    created_at=TEXT,
    updated_at=RUN_TIME,
)
SILVER_BRIDGE = record(
    openalex_producao_id=TEXT,
    openalex_autor_id=TEXT,
    orcid_id=TEXT,
    nome_autor=TEXT,
    ordem_autoria=T.IntegerType(),
    autor_principal=FLAG,
    correspondente=FLAG,
    afiliacao_autor=TEXT,
)
SILVER_RESEARCHERS = record(
    lattes_id=TEXT,
    orcid_id=TEXT,
    openalex_id=TEXT,
    nome_completo=TEXT,
    resumo_cv=TEXT,
    indice_h=WHOLE,
    indice_i10=WHOLE,
    qtd_producoes=WHOLE,
    qtd_citacoes_pesquisador=WHOLE,
    nacionalidade=TEXT,
    instituicao_empresa=TEXT,
    nome_orgao=TEXT,
    codigo_instituicao=TEXT,
    data_atualizacao_lattes=T.DateType(),
    updated_at=RUN_TIME,
)
GOLD_WORKS = T.StructType(
    [
        *[SILVER_RESEARCHERS[name] for name in ("lattes_id", "nome_completo", "openalex_id")],
        *[
            SILVER_BRIDGE[name]
            for name in (
                "openalex_producao_id", "ordem_autoria", "autor_principal", "correspondente",
            )
        ],
        *[
            SILVER_WORKS[name]
            for name in (
                "titulo", "ano_publicacao", "tipo_producao", "journal_name",
                "qtd_citacoes_producao",
            )
        ],
    ]
)
