"""Typed tables of record, their keys and the references between them.

Column names are fixed values: data written by an existing wildfire register uses them.
FLOAT columns are kept as DOUBLE, clock times as seconds of day and durations as seconds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

AGE_BANDS = [
    "r_00_04", "r_05_09", "r_10_14", "r_15_19", "r_20_24", "r_25_29", "r_30_34", "r_35_39", "r_40_44",
    "r_45_49", "r_50_54", "r_55_59", "r_60_64", "r_65_69", "r_70_74", "r_75_79", "r_80_84", "r_85_mm",
]

DAMAGE_PARTS = ["hojarasca", "arbustivo", "herbaceo", "arbolado_adulto", "renuevo"]

_DDL = {
    "diccionario": "id_variable string, fuente string, nombre_completo string, unidad_de_medida string",
    "estado": "id_clave_ent int, region string, estado string",
    "vegetacion": "id_vegetacion int, regimen_del_fuego string, tipo_de_vegetacion string",
    "causa": "id_causa int, causa string, causa_especifica string",
    "municipios": "id_cvegeo string, id_clave_ent int, nombre_municipio string",
    "incendios": "id_clave_inc string, id_cvegeo string, id_causa int, id_vegetacion int, latitud double, "
    "longitud double, fecha_inicio date, tipo_de_incendio string, anio int",
    "demografia": "id_cvegeo string, anio int, sexo string, pob_total int, "
    + ", ".join(f"{band} int" for band in AGE_BANDS),
    "danos": "id_clave_inc string, " + ", ".join(f"{part} double" for part in DAMAGE_PARTS) + ", tamanio string",
    "operaciones": "id_clave_inc string, fecha_termino date, hora_deteccion_s int, hora_llegada_s int, "
    "duracion_s bigint, duracion_dias int",
    "climatologia": "id_registro bigint, id_variable string, id_clave_inc string, fecha_de_observacion date, "
    "resultado_numerico double",
}

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(),
}


def _schema(ddl: str) -> T.StructType:
    """Schema from `name type, ...` without needing a running session."""
    pairs = [column.split() for column in ddl.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {name: _schema(ddl) for name, ddl in _DDL.items()}

# Logical keys: what identifies a row when duplicates are looked for.
KEYS: dict[str, list[str]] = {
    "diccionario": ["id_variable"],
    "estado": ["id_clave_ent"],
    "vegetacion": ["id_vegetacion"],
    "causa": ["id_causa"],
    "municipios": ["id_cvegeo"],
    "incendios": ["id_clave_inc"],
    "demografia": ["id_cvegeo", "anio", "sexo"],
    "danos": ["id_clave_inc"],
    "operaciones": ["id_clave_inc"],
    "climatologia": ["id_variable", "id_clave_inc", "fecha_de_observacion"],
}


@dataclass(frozen=True)
class Reference:
    """A declared foreign key: `child.column` must exist in `parent.parent_column`."""

    child: str
    column: str
    parent: str
    parent_column: str

    @property
    def label(self) -> str:
        return f"{self.child}.{self.column} -> {self.parent}.{self.parent_column}"


REFERENCES = [
    Reference("municipios", "id_clave_ent", "estado", "id_clave_ent"),
    Reference("incendios", "id_cvegeo", "municipios", "id_cvegeo"),
    Reference("incendios", "id_causa", "causa", "id_causa"),
    Reference("incendios", "id_vegetacion", "vegetacion", "id_vegetacion"),
    Reference("demografia", "id_cvegeo", "municipios", "id_cvegeo"),
    Reference("danos", "id_clave_inc", "incendios", "id_clave_inc"),
    Reference("operaciones", "id_clave_inc", "incendios", "id_clave_inc"),
    Reference("climatologia", "id_variable", "diccionario", "id_variable"),
    Reference("climatologia", "id_clave_inc", "incendios", "id_clave_inc"),
]

# Text columns that are folded to plain lower case.
TEXT_COLUMNS: dict[str, list[str]] = {
    "diccionario": ["fuente", "nombre_completo", "unidad_de_medida"],
    "estado": ["region", "estado"],
    "vegetacion": ["regimen_del_fuego", "tipo_de_vegetacion"],
    "causa": ["causa", "causa_especifica"],
    "municipios": ["nombre_municipio"],
    "incendios": ["tipo_de_incendio"],
    "demografia": ["sexo"],
    "danos": ["tamanio"],
}
