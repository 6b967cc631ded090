"""Column functions: lenient typing, codes, labels, JSON lists, guarded arithmetic. None raises under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"


def clean_text(c: Column) -> Column:
    """trimmed; blank and the text nan are null."""
    t = F.trim(c.cast("string"))
    return F.when((t == "") | (t == "nan"), None).otherwise(t)


def to_type(c: Column, kind: str, fmt: str | None = None) -> Column:
    """a text as one of the declared types; what doesn't parse is null."""
    t = clean_text(c)
    if kind == "boolean":
        return to_boolean(t)
    if kind in ("timestamp", "date"):
        at = F.try_to_timestamp(t, F.lit(fmt)) if fmt else t.try_cast("timestamp")
        return at.cast("date") if kind == "date" else at.cast("timestamp_ntz")
    if kind in ("int", "long"):  # "3.0" is 3
        return F.coalesce(t.try_cast(kind), F.when(t.try_cast("double") % 1 == 0, t.try_cast("double").try_cast(kind)))
    return t.try_cast(kind)


def to_boolean(c: Column) -> Column:
    """true/1/yes/oui and false/0/no/non, in any case; else null."""
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("true", "1", "yes", "oui"), True).when(t.isin("false", "0", "no", "non"), False)


def decimal_comma(c: Column) -> Column:
    """S2: "106,9" as 106.9."""
    return F.regexp_replace(F.trim(c), ",", ".").try_cast("double")


def code(c: Column) -> Column:
    """a numeric code without spaces and leading zeros; others are null."""
    return F.trim(c.cast("string")).try_cast("int").cast("string")


def padded(c: Column, n: int = 2) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def iso_week(c: Column) -> Column:
    """two-digit ISO week."""
    return padded(F.weekofyear(c))


def iso_year(c: Column) -> Column:
    """the year that the ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), c).cast("int")


def normal_name(c: Column) -> Column:
    """upper case without accents and outer spaces."""
    return F.upper(F.translate(F.trim(c), ACCENTED, PLAIN))


def safe_identifier(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.translate(c, ACCENTED, PLAIN), "[^0-9A-Za-z]+", "_"))


def key_of(*cols: Column, null: str = "nan") -> Column:
    """F8: parts joined by underscores; a null part is a fixed token."""
    return F.concat_ws("_", *(F.coalesce(c.cast("string"), F.lit(null)) for c in cols))


def before_last(c: Column, sep: str = "-") -> Column:
    """the text up to its last separator; whole if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(c, f"^(.*){sep}[^{sep}]*$", 1), F.lit("")), c)


def after_last(c: Column, sep: str = "-") -> Column:
    return F.regexp_extract(c, f"^.*{sep}([^{sep}]*)$", 1)


def tail_date(c: Column) -> Column:
    """the date at a composite key's end."""
    return F.try_to_timestamp(F.right(c, F.lit(10)), F.lit("yyyy-MM-dd")).cast("date")


def name_with_city(name: Column, city: Column) -> Column:
    """the city appended to a name that doesn't hold it."""
    n, c = F.rtrim(name, F.lit(" -_")), F.ltrim(city, F.lit(" -_"))
    return F.when(city.isNull() | (c == "") | F.contains(F.lower(n), F.lower(c)), n).otherwise(F.concat_ws(" - ", n, c))


def billing_class(label: Column, classes: dict[str, str], default: str = "autre") -> Column:
    """the class of a label, by its lower-case form."""
    return labelled(F.lower(F.trim(label)), classes, default)


def labelled(c: Column, labels: dict, default: str | None = None) -> Column:
    """code to label."""
    return F.coalesce(reduce(lambda x, kv: x.when(c == kv[0], F.lit(kv[1])), labels.items(), F.when(F.lit(False), F.lit(None).cast("string"))), F.lit(default))


def effective(*order: Column) -> Column:
    """the first that is there, in the order given."""
    return F.coalesce(*order)


def greatest_or_null(*cols: Column) -> Column:
    """the largest; null if any is null."""
    return F.when(reduce(lambda a, b: a | b, (c.isNull() for c in cols)), None).otherwise(F.greatest(*cols))


def school_year(c: Column, starts_in: int = 9) -> Column:
    """F16: "2023-2024", the year turning in the given month."""
    first = F.year(c) - F.when(F.month(c) >= starts_in, 0).otherwise(1)
    return F.concat_ws("-", first.cast("string"), (first + 1).cast("string"))


def json_list(c: Column, kind: str = "string") -> Column:
    """a JSON list as array; Python's True, False and None count as JSON's."""
    fixed = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\bTrue\b", "true"), r"\bFalse\b", "false"), r"\bNone\b", "null")
    return F.from_json(fixed, f"array<{kind}>")


def json_columns(c: Column, n: int = 5, kind: str = "long") -> list[Column]:
    """the first n elements of a JSON list, typed leniently; booleans are 1 and 0."""
    items = json_list(c)
    item = lambda i: F.get(items, F.lit(i))
    return [F.when(item(i).isin("true", "false"), (item(i) == "true").cast("int").cast(kind)).otherwise(item(i).try_cast(kind)) for i in range(n)]


def json_kth(c: Column, k: Column, most: int = 15) -> Column:
    """the k-th number, from 1; 0 where k is outside 1 to most, or nothing is there."""
    return F.when(k.between(1, most), F.coalesce(F.get(json_list(c, "double"), (k - 1).cast("int")), F.lit(0.0))).otherwise(F.lit(0.0))


def origin_flags(article: Column, movement: Column, supplier: Column) -> Column:
    """a flag of three values: the movement's own decides, else article or supplier."""
    return F.coalesce(movement, F.coalesce(article, F.lit(False)) | F.coalesce(supplier, F.lit(False)))


def amount(qty: Column, price: Column, vat: Column | None = None) -> Column:
    """quantity times price, with VAT in percent if given; null parts count as 0."""
    z = lambda c: F.coalesce(c, F.lit(0.0))
    net = z(qty) * z(price)
    return net if vat is None else net * (1 + z(vat) / 100)


def in_unit(qty: Column, factor: Column, unit: Column) -> Column:
    """a quantity in kilograms: as it is for KG, else times the factor, 0 meaning none."""
    return F.when(F.upper(unit) == "KG", qty).otherwise(qty * F.when(F.coalesce(factor, F.lit(0.0)) == 0, 1.0).otherwise(factor))


def horizon_bin(days: Column, edges: Sequence[int] = (7, 14, 21), closed: str = "right") -> Column:
    """labels of horizons; closed="right": up to 7, 14, 21 days and beyond; "left": below 7, 14, 21 and from there."""
    inside = (lambda e: days <= e) if closed == "right" else (lambda e: days < e)
    sign = "<=" if closed == "right" else "<"
    out = reduce(lambda x, e: x.when(inside(e), f"{sign}{e}"), edges[1:], F.when(inside(edges[0]), f"{sign}{edges[0]}"))
    return out.otherwise((">" if closed == "right" else ">=") + str(edges[-1]))


def letter(n: Column, letters: str = "ABCDEFGHIJKLMN") -> Column:
    """1 to A, 2 to B."""
    return F.get(F.array(*map(F.lit, letters)), (n - 1).cast("int"))


def finite(c: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def ratio(a: Column, b: Column, scale: float = 1.0, digits: int | None = 2) -> Column:
    """A / b * scale, 0 where b is 0 or either is null."""
    r = F.try_divide(a.cast("double"), b.cast("double")) * scale
    return F.coalesce(F.round(r, digits) if digits is not None else r, F.lit(0.0))
