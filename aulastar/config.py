"""Configuration objects and the fixed values of the yearly-statistics domain.

Operators never name a domain table or column directly: they read them from
an :class:`IngestProfile` (ingest side) or a :class:`StarConfig` (models,
marts, checks).  ``DOMAIN`` below is the configuration for yearly
enrolment / teacher spreadsheets; ``aulastar.plans.bindings`` builds a second
one over the driver's TPC-H-like tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from types import MappingProxyType
from typing import Mapping

# =============================================================================
# FIXED VALUES — must equal the source data conventions for right results.
# Header aliases (keys are already normalised: upper case, no accents, no
# "( ) .", single spaces), required columns, file catalog entries and the
# domain defaults (place pattern, accepted "caracter" values, sector variants,
# quality-flag thresholds and labels, BI labels).
# =============================================================================

ALIASES_SHARED = {
    "CODIGO DE LA INSTITUCION": "codigo_institucion",
    "CODIGO INSTITUCION": "codigo_institucion",
    "CODIGO IES": "codigo_institucion",
    "ID IES": "codigo_institucion",
    "IES PADRE": "ies_padre",
    "INSTITUCION DE EDUCACION SUPERIOR IES": "institucion_educacion_superior_ies",
    "INSTITUCION DE EDUCACION SUPERIOR": "institucion_educacion_superior_ies",
    "IES": "institucion_educacion_superior_ies",
    "NOMBRE IES": "institucion_educacion_superior_ies",
    "PRINCIPAL O SECCIONAL": "tipo_ies",
    "TIPO IES": "tipo_ies",
    "TIPO SEDE": "tipo_ies",
    "ID SECTOR IES": "id_sector_ies",
    "ID SECTOR": "id_sector_ies",
    "SECTOR IES": "sector_ies",
    "SECTOR": "sector_ies",
    "ID CARACTER": "id_caracter",
    "ID CARACTER IES": "id_caracter",
    "CARACTER IES": "caracter_ies",
    "CARACTER": "caracter_ies",
    "CARACTER ACADEMICO": "caracter_ies",
    "CODIGO DEL DEPARTAMENTO IES": "codigo_departamento_ies",
    "CODIGO DEL DEPARTAMENTO": "codigo_departamento_ies",
    "DEPARTAMENTO DE DOMICILIO DE LA IES": "departamento_domicilio_ies",
    "DEPARTAMENTO DE DOMICILIO IES": "departamento_domicilio_ies",
    "DEPARTAMENTO DE DOMICILIO": "departamento_domicilio_ies",
    "DEPARTAMENTO IES": "departamento_domicilio_ies",
    "CODIGO DEL MUNICIPIO IES": "codigo_municipio_ies",
    "CODIGO DEL MUNICIPIO": "codigo_municipio_ies",
    "MUNICIPIO DE DOMICILIO DE LA IES": "municipio_domicilio_ies",
    "MUNICIPIO DE DOMICILIO IES": "municipio_domicilio_ies",
    "MUNICIPIO DE DOMICILIO": "municipio_domicilio_ies",
    "MUNICIPIO IES": "municipio_domicilio_ies",
    "IES ACREDITADA": "ies_acreditada",
    "ANO": "anio",
    "ANIO": "anio",
    "SEMESTRE": "semestre",
}

ALIASES_MATRICULADOS = {
    "MATRICULADOS": "matriculados",
    "TOTAL MATRICULADOS": "matriculados",
    "ESTUDIANTES MATRICULADOS": "matriculados",
    "CODIGO SNIES DEL PROGRAMA": "codigo_snies_programa",
    "CODIGO DEL PROGRAMA": "codigo_snies_programa",
    "PROGRAMA ACADEMICO": "programa_academico",
    "PROGRAMA": "programa_academico",
    "PROGRAMA ACREDITADO": "programa_acreditado",
    "ID NIVEL ACADEMICO": "id_nivel_academico",
    "NIVEL ACADEMICO": "nivel_academico",
    "ID NIVEL DE FORMACION": "id_nivel_formacion",
    "NIVEL DE FORMACION": "nivel_formacion",
    "ID MODALIDAD": "id_modalidad",
    "MODALIDAD": "modalidad",
    "ID AREA": "id_area",
    "AREA DE CONOCIMIENTO": "area_conocimiento",
    "ID NUCLEO": "id_nucleo",
    "NUCLEO BASICO DEL CONOCIMIENTO NBC": "nucleo_basico_conocimiento",
    "NUCLEO BASICO DEL CONOCIMIENTO": "nucleo_basico_conocimiento",
    "ID CINE CAMPO AMPLIO": "id_cine_campo_amplio",
    "DESC CINE CAMPO AMPLIO": "cine_campo_amplio",
    "ID CINE CAMPO ESPECIFICO": "id_cine_campo_especifico",
    "DESC CINE CAMPO ESPECIFICO": "cine_campo_especifico",
    "ID CINE CAMPO DETALLADO": "id_cine_campo_detallado",
    "DESC CINE CAMPO DETALLADO": "cine_campo_detallado",
    "CODIGO DEL DEPARTAMENTO PROGRAMA": "codigo_departamento_programa",
    "DEPARTAMENTO DE OFERTA DEL PROGRAMA": "departamento_oferta_programa",
    "CODIGO DEL MUNICIPIO PROGRAMA": "codigo_municipio_programa",
    "MUNICIPIO DE OFERTA DEL PROGRAMA": "municipio_oferta_programa",
    "ID SEXO": "id_sexo",
    "SEXO": "sexo",
}

ALIASES_DOCENTES = {
    "DOCENTES": "docentes",
    "NO DE DOCENTES": "docentes",
    "NUMERO DE DOCENTES": "docentes",
    "TOTAL DOCENTES": "docentes",
    "SEXO DEL DOCENTE": "sexo_docente",
    "ID MAXIMO NIVEL DE FORMACION DEL DOCENTE": "id_nivel_formacion_docente",
    "MAXIMO NIVEL DE FORMACION DEL DOCENTE": "nivel_formacion_docente",
    "NIVEL DE FORMACION ALTO": "nivel_formacion_docente",
    "MAXIMO NIVEL DE FORMACION": "nivel_formacion_docente",
    "NIVEL CINE": "nivel_cine",
    "ID TIEMPO DE DEDICACION": "id_tiempo_dedicacion",
    "TIEMPO DE DEDICACION DEL DOCENTE": "tiempo_dedicacion_docente",
    "TIEMPO DE DEDICACION": "tiempo_dedicacion_docente",
    "DEDICACION": "tiempo_dedicacion_docente",
    "ID TIPO DE CONTRATO": "id_tipo_contrato",
    "TIPO DE CONTRATO DEL DOCENTE": "tipo_contrato",
    "TIPO DE CONTRATO": "tipo_contrato",
}

REQUIRED_MATRICULADOS = (
    "codigo_institucion",
    "institucion_educacion_superior_ies",
    "departamento_domicilio_ies",
    "anio",
    "semestre",
    "matriculados",
)

REQUIRED_DOCENTES = (
    "codigo_institucion",
    "institucion_educacion_superior_ies",
    "departamento_domicilio_ies",
    "anio",
    "semestre",
    "docentes",
)

# (year, profile, sheet, header row (0-based), file name)
CATALOG_ENTRIES = (
    (2022, "matriculados", "Matriculados E.S. 2022", 7, "matriculados_2022.xlsx"),
    (2022, "docentes", "Docentes 2022", 7, "docentes_2022.xlsx"),
    (2023, "matriculados", "1.", 5, "matriculados_2023.xlsx"),
    (2023, "docentes", "1.", 5, "docentes_2023.xlsx"),
    (2024, "matriculados", "1.", 5, "matriculados_2024.xlsx"),
    (2024, "docentes", "1.", 5, "docentes_2024.xlsx"),
)

PLACE_PATTERN = "BOGOT%"
CARACTER_VALUES = ("Universidad", "Institución Universitaria/Escuela Tecnológica")
CARACTER_ACCEPTED = (
    "Universidad",
    "Institución Universitaria",
    "Institución Universitaria/Escuela Tecnológica",
)
SECTOR_CANON = (
    ("Privada", ("PRIVADO", "PRIVADA")),
    ("Oficial", ("OFICIAL", "PÚBLICO", "PUBLICO")),
)
SECTOR_ACCEPTED = ("Oficial", "Privada")
FLAG_NO_DENOMINATOR = "sin_docentes"
FLAG_NO_NUMERATOR = "sin_matriculados"
FLAG_LOW_DENOMINATOR = "docentes_bajos"
FLAG_LOW_NUMERATOR = "matriculados_bajos"
FLAG_OK = "ok"
LOW_DENOMINATOR = 10
LOW_NUMERATOR = 100
NULL_TOKENS = ("", "nan", "NaN", "None")
# Texts that the tabular reader takes for a missing cell.
READER_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
MISSING_HASH_TEXT = "nan"
HASH_SEPARATOR = "||"
DEFAULT_ACCREDITED = "No"
HEADER_SCAN_ROWS = 20
HEADER_MIN_SCORE = 4
LOG_MESSAGE_LIMIT = 2000
FRESHNESS_WARN_DAYS = 400
FRESHNESS_ERROR_DAYS = 800
ACCEPTED_YEARS = (2022, 2023, 2024)
LINEAGE_COLUMNS = ("_ingested_at", "_source_url", "_source_file", "_row_hash", "_dag_run_id")

LABEL_MEMBER_STAR = "⭐ SUE"
LABEL_MEMBER_GROUP = "SUE (públicas)"
LABEL_NON_MEMBER_GROUP = "No SUE (privadas)"
LABEL_MEMBER_MARK = "⭐"
TREND_BETTER = "✓ Mejoró"
TREND_WORSE = "✗ Empeoró"
TREND_SAME = "= Estable"
OUTLIER_HIGH = "Muy alto (posible virtual)"
OUTLIER_LOW = "Muy bajo (posgrado/especializada)"
OUTLIER_REVIEW = "Requiere revisión"
OUTLIER_NORMAL = "Normal"
OUTLIER_HIGH_RATIO = 50
OUTLIER_LOW_RATIO = 3
BEST_MIN_DENOMINATOR = 50
FOCUS_YEAR = 2024
PIVOT_FIRST_YEAR = 2022
PIVOT_LAST_YEAR = 2024
TOP_BEST = 10
TOP_WORST = 10
TOP_LARGEST = 20

# =============================================================================
# end of fixed values
# =============================================================================


def _frozen(d: Mapping[str, str]) -> Mapping[str, str]:
    return MappingProxyType(dict(d))


@dataclass(frozen=True)
class IngestProfile:
    """One kind of source file ("perfil"): its Bronze table, header aliases,
    required canonical columns and measure column."""

    name: str
    table: str
    aliases: Mapping[str, str]
    required: tuple[str, ...]
    measure: str
    key: str = "codigo_institucion"


PROFILES: dict[str, IngestProfile] = {
    "matriculados": IngestProfile(
        name="matriculados",
        table="matriculados_raw",
        aliases=_frozen({**ALIASES_SHARED, **ALIASES_MATRICULADOS}),
        required=REQUIRED_MATRICULADOS,
        measure="matriculados",
    ),
    "docentes": IngestProfile(
        name="docentes",
        table="docentes_raw",
        aliases=_frozen({**ALIASES_SHARED, **ALIASES_DOCENTES}),
        required=REQUIRED_DOCENTES,
        measure="docentes",
    ),
}


@dataclass(frozen=True)
class MeasureSpec:
    """A yearly measure: the raw text column and the name of its yearly total."""

    raw: str
    total: str


@dataclass(frozen=True)
class StarConfig:
    """Everything the Silver/Gold/mart/quality operators need to know about
    a domain.  Column names refer to the Bronze (all-text) tables."""

    # Bronze columns
    code: str = "codigo_institucion"
    name: str = "institucion_educacion_superior_ies"
    kind: str = "tipo_ies"
    sector: str = "sector_ies"
    caracter: str = "caracter_ies"
    place: str = "departamento_domicilio_ies"
    town: str = "municipio_domicilio_ies"
    accredited: str = "ies_acreditada"
    year: str = "anio"
    semester: str = "semestre"
    numerator: MeasureSpec = MeasureSpec("matriculados", "total_matriculados")
    denominator: MeasureSpec = MeasureSpec("docentes", "total_docentes")
    ratio: str = "ratio_estudiante_docente"
    flag: str = "flag_calidad"

    # filters and canonicalisation
    place_pattern: str = PLACE_PATTERN
    caracter_values: tuple[str, ...] = CARACTER_VALUES
    sector_canon: tuple[tuple[str, tuple[str, ...]], ...] = SECTOR_CANON
    default_accredited: str = DEFAULT_ACCREDITED

    # quality flag thresholds
    low_denominator: int = LOW_DENOMINATOR
    low_numerator: int = LOW_NUMERATOR

    # data-quality contract
    accepted_years: tuple[int, ...] = ACCEPTED_YEARS
    sector_accepted: tuple[str, ...] = SECTOR_ACCEPTED
    caracter_accepted: tuple[str, ...] = CARACTER_ACCEPTED
    semester_range: tuple[int, int] = (1, 2)
    freshness_warn_days: int = FRESHNESS_WARN_DAYS
    freshness_error_days: int = FRESHNESS_ERROR_DAYS

    # seed (membership lookup)
    seed_key: str = "codigo_snies"

    # marts
    focus_year: int = FOCUS_YEAR
    pivot_first_year: int = PIVOT_FIRST_YEAR
    pivot_last_year: int = PIVOT_LAST_YEAR
    best_min_denominator: int = BEST_MIN_DENOMINATOR
    outlier_high: float = OUTLIER_HIGH_RATIO
    outlier_low: float = OUTLIER_LOW_RATIO
    top_best: int = TOP_BEST
    top_worst: int = TOP_WORST
    top_largest: int = TOP_LARGEST

    @property
    def flags(self) -> tuple[str, ...]:
        return (FLAG_OK, FLAG_NO_DENOMINATOR, FLAG_NO_NUMERATOR, FLAG_LOW_DENOMINATOR, FLAG_LOW_NUMERATOR)


DOMAIN = StarConfig()


@dataclass(frozen=True)
class SourceEntry:
    """One catalog entry: which file holds a (year, profile) and where its
    header row is."""

    anio: int
    perfil: str
    sheet_name: str
    header_row: int
    filename: str
    url: str | None = None


def default_catalog(base_url: str | None = None, export_ext: str | None = None) -> list[SourceEntry]:
    """The catalog of the domain; ``base_url`` (a folder or URL prefix) is
    joined with each file name to give ``url``.  ``export_ext`` (e.g.
    ``".csv"``) replaces the workbook extension for delimited exports."""
    out = []
    for anio, perfil, sheet, header_row, filename in CATALOG_ENTRIES:
        if export_ext:
            filename = filename.rsplit(".", 1)[0] + export_ext
        url = None if base_url is None else f"{base_url.rstrip('/')}/{filename}"
        out.append(SourceEntry(anio, perfil, sheet, header_row, filename, url))
    return out
