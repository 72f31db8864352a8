import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aulastar.session import get_spark  # noqa: E402

RAW_COLUMNS = (
    "codigo_institucion", "institucion_educacion_superior_ies", "tipo_ies", "sector_ies", "caracter_ies",
    "departamento_domicilio_ies", "municipio_domicilio_ies", "ies_acreditada", "anio", "semestre",
)
UNI = "Universidad"
BOG = "Bogotá D.C."


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", "aulastar-tests", {"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="aulastar-test-", dir="/tmp")


def raw_rows(spark, measure, rows):
    """Bronze-like frame: every column text.  ``rows`` are dicts; missing
    keys take domain defaults."""
    defaults = {"codigo_institucion": "1101", "institucion_educacion_superior_ies": "UNIVERSIDAD A",
                "tipo_ies": "Principal", "sector_ies": "Oficial", "caracter_ies": UNI,
                "departamento_domicilio_ies": BOG, "municipio_domicilio_ies": "Bogotá D.C.",
                "ies_acreditada": "Si", "anio": "2022", "semestre": "1", measure: "100"}
    cols = list(RAW_COLUMNS) + [measure]
    data = [tuple({**defaults, **r}.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
