"""Declared schemas and tenant settings."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import types as T

TYPES: dict[str, T.DataType] = {
    "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
    "timestamp": T.TimestampNTZType(), "date": T.DateType(), "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class TableSpec:
    """A table's declaration: column types by name, keys, the column that says how fresh a row is, and renames of source columns."""

    name: str
    columns: dict[str, str]
    keys: tuple[str, ...] = ()
    watermark: str | None = None
    partition_by: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    formats: dict[str, str] = field(default_factory=dict)
    pk_from: tuple[str, ...] = ()
    site_column: str | None = None

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(c, TYPES[t]) for c, t in self.columns.items()])

    def errors(self, schema: T.StructType) -> list[str]:
        """What a frame's schema lacks or has with another type."""
        have = {f.name: f.dataType for f in schema}
        out = [f"missing: {c}" for c in self.columns if c not in have]
        return out + [f"{c}: {have[c].simpleString()}, not {TYPES[t].simpleString()}" for c, t in self.columns.items() if c in have and have[c] != TYPES[t]]


@dataclass(frozen=True)
class TenantConfig:
    """What differs from tenant to tenant: exclusions, fallback zone, school-year rule, start dates."""

    name: str = "default"
    excluded_organizations: tuple[int, ...] = ()
    excluded_sessions: tuple[int, ...] = ()
    excluded_users: tuple[int, ...] = ()
    fallback_zone: str = "C"
    year_starts_in: int = 9
    start_date: str = "2020-01-01"
    tranches: tuple[str, ...] = tuple("ABCDEFGH")


def snake_case(name: str) -> str:
    """Column name without accents, camel case split, in lower case, a leading id set apart: idUser, iduser -> id_user, IdX -> id_x."""
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    plain = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", plain.strip())
    plain = re.sub(r"[^0-9A-Za-z]+", "_", plain).strip("_").lower()
    return plain if plain == "id" or plain.startswith("id_") or not plain.startswith("id") else f"id_{plain[2:]}"
