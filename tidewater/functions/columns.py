"""Column functions: Column in, Column out, all inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
WEEKEND = (1, 7)      # dayofweek(): Sunday = 1, Saturday = 7


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(part: Column, whole: Column) -> Column:
    """Division that yields null for a zero or null denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def pct(part: Column, whole: Column, digits: int = 6) -> Column:
    """Percentage, rounded, null when the whole is zero."""
    return F.round(ratio(part, whole) * 100, digits)


def growth(current: Column, previous: Column, digits: int = 6) -> Column:
    """Change against the previous value in percent."""
    return pct(current - previous, previous, digits)


def net(price: Column, discount: Column) -> Column:
    """Price after a fractional discount."""
    return price * (1 - discount)


def month(c: Column | str) -> Column:
    return F.trunc(F.to_date(_col(c)), "MM")


def text_day(c: Column | str) -> Column:
    """Date as yyyy-MM-dd text."""
    return F.to_date(_col(c)).cast("string")


def epoch(c: Column | str) -> Column:
    """Whole seconds since the epoch."""
    return F.unix_timestamp(_col(c))


def is_weekend(c: Column | str) -> Column:
    return F.dayofweek(_col(c)).isin(*WEEKEND)


def business_days(start: Column, end: Column, holidays: list[str] | None = None) -> Column:
    """Monday–Friday days from start to end, both inclusive, minus weekday holidays.

    Closed form on whole weeks plus the remainder, so no day list is built per row.
    """
    def upto(d: Column) -> Column:
        days = F.datediff(d, F.lit("1970-01-05").cast("date")) + 1      # Monday is day 1
        weeks = F.floor(days / 7)
        return weeks * 5 + F.least(days - weeks * 7, F.lit(5))
    count = upto(end) - upto(F.date_sub(start, 1))
    for day in holidays or []:
        d = F.lit(day).cast("date")
        count = count - F.when(~is_weekend(d) & d.between(start, end), 1).otherwise(0)
    return F.when(end < start, F.lit(0)).otherwise(count).cast("long")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def grid_cell(lat: Column, lon: Column, size: float) -> Column:
    return F.concat_ws(":", F.floor(lat / size).cast("string"), F.floor(lon / size).cast("string"))


def parse_date(c: Column | str, formats: tuple[str, ...] = ("yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy")) -> Column:
    """First format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(f)).cast("date") for f in formats])


def salted_hash(c: Column, salt: str) -> Column:
    """SHA-256 of salt and value; a salt is required."""
    if not salt:
        raise ValueError("a salt is required")
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def mask_email(c: Column) -> Column:
    return F.regexp_replace(c, r"^[^@]+", "***")


def mask_digits(c: Column, keep: int = 4) -> Column:
    """Replace all but the last ``keep`` digits, as for card and identity numbers."""
    return F.regexp_replace(c, rf"\d(?=(?:\D*\d){{{keep}}})", "*")


def xml_escape(c: Column) -> Column:
    out = c.cast("string")
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def xml_row(tag: str, **fields: Column) -> Column:
    """``<tag><name>value</name>…</tag>`` with escaped text."""
    parts = [F.lit(f"<{tag}>")]
    for name, c in fields.items():
        parts += [F.lit(f"<{name}>"), xml_escape(c), F.lit(f"</{name}>")]
    return F.concat(*parts, F.lit(f"</{tag}>"))


def bands(c: Column, *edges: tuple[float, str], other: str) -> Column:
    """Label of the first upper edge the value is below; null has no label."""
    chain = F.when(c.isNull(), F.lit(None).cast("string"))
    for limit, label in edges:
        chain = chain.when(c < limit, label)
    return chain.otherwise(other)


def pair_low(a: Column, b: Column) -> Column:
    return F.least(a, b)


def pair_high(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def line_revenue() -> Column:
    """Net revenue of an order line."""
    return net(F.col("l_extendedprice"), F.col("l_discount"))
