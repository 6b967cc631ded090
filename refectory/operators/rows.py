"""Projections, predicates and row normalisation (P)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..spec import TableSpec, snake_case


def normalize(df: DataFrame, spec: TableSpec, site: Column | None = None) -> DataFrame:
    """One select that renames, cleans, types and keys raw text rows as the spec declares. Columns it lacks are null."""
    source = {spec.renames.get(snake_case(c), snake_case(c)): F.col(f"`{c}`") for c in df.columns}
    if site is not None and spec.site_column:
        source[spec.site_column] = site
    typed = {c: S.to_type(source[c], t, spec.formats.get(c)) if c in source else F.lit(None).cast("string").try_cast(t if t != "timestamp" else "timestamp_ntz") for c, t in spec.columns.items() if c != "pk"}
    if "pk" in spec.columns:
        typed["pk"] = S.key_of(*(typed[c] for c in spec.pk_from))
    return df.select(*(typed[c].alias(c) for c in spec.columns))


def rejected(df: DataFrame, mandatory: list[str]) -> tuple[DataFrame, DataFrame]:
    """P5: rows with all mandatory values, and the others with the reason. Nested names are allowed."""
    missing = F.concat_ws(", ", *(F.when(F.col(c).isNull(), F.lit(c)) for c in mandatory))
    return df.where(missing == ""), df.withColumn("reason", F.concat(F.lit("missing "), missing)).where(missing != "")


def bad_codes(df: DataFrame, c: str) -> DataFrame:
    """Distinct codes that aren't digits only."""
    return df.select(c).where(~F.col(c).rlike("^[0-9]*$")).distinct()


def excluded(df: DataFrame, c: str, values: tuple) -> DataFrame:
    """Rows not on a tenant's exclusion list; null values stay."""
    return df.where(F.col(c).isNull() | ~F.col(c).isin(list(values))) if values else df


def matches(columns: list[str], *, ids: tuple[str, list] | None = None, names: tuple[str, list] | None = None, equals: dict[str, list] | None = None, between: dict[str, tuple] | None = None, dates: tuple[str, str | None, str | None] | None = None) -> Column:
    """Ids or names, and each of equals, and ranges (both ends in; null out), and dates from the first to before the second.

    A criterion on a column that isn't there is ignored.
    """
    tests = []
    either = [F.col(c).isin(v) for x in (ids, names) if x and x[0] in columns and x[1] for c, v in (x,)]
    if either:
        tests.append(reduce(lambda a, b: a | b, either))
    tests += [F.col(c).isin(v) for c, v in (equals or {}).items() if c in columns and v]
    tests += [F.col(c).between(*v) for c, v in (between or {}).items() if c in columns]
    if dates and dates[0] in columns:
        tests += [F.col(dates[0]) >= F.lit(dates[1]).cast("timestamp")] * bool(dates[1]) + [F.col(dates[0]) < F.lit(dates[2]).cast("timestamp")] * bool(dates[2])
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def active_sites(df: DataFrame, profile: str = "profil", fictitious: str = "fictif", name: str = "nometabs", marker: str = "DEMO]") -> DataFrame:
    """Profile 2, not fictitious, no demo."""
    return df.where((F.col(profile) == 2) & ~F.coalesce(F.col(fictitious), F.lit(False)) & ~F.coalesce(F.contains(F.col(name), F.lit(marker)), F.lit(False)))


def recent(df: DataFrame, c: str, as_of: str, months: int = 12) -> DataFrame:
    """Not older than so many months; null stays."""
    return df.where(F.col(c).isNull() | (F.col(c) >= F.add_months(F.lit(as_of).cast("date"), -months)))


def automatic(df: DataFrame, origin: str = "origine") -> DataFrame:
    """P10: rows whose origin is there and isn't manual."""
    o = F.trim(F.col(origin))
    return df.where(F.coalesce((o != "") & ~F.upper(o).startswith("MANUEL"), F.lit(False)))


def split_by_date(df: DataFrame, c: str, days: int) -> tuple[DataFrame, DataFrame]:
    """Rows up to `days` before the latest date, and those after."""
    last = df.agg(F.max(F.to_date(c)).alias("__last"))
    both = df.crossJoin(F.broadcast(last))
    cut = F.date_sub("__last", days)
    return both.where(F.to_date(c) <= cut).drop("__last"), both.where(F.to_date(c) > cut).drop("__last")
