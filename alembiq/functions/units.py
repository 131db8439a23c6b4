"""Quantities with units, and bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import strip

# Seconds and pascals of one unit.
SECONDS = {
    "s": 1.0, "sec": 1.0, "secs": 1.0, "second": 1.0, "seconds": 1.0,
    "m": 60.0, "min": 60.0, "mins": 60.0, "minute": 60.0, "minutes": 60.0,
    "h": 3600.0, "hr": 3600.0, "hrs": 3600.0, "hour": 3600.0, "hours": 3600.0,
    "day": 86400.0, "days": 86400.0,
}
PASCALS = {"pa": 1.0, "kpa": 1e3, "mpa": 1e6, "bar": 1e5, "mbar": 1e2, "atm": 101325.0, "torr": 133.322, "psi": 6894.757}

# Fixed value: the number at the start of a text and the unit after it.
NUMBER = r"^([-+]?\d*\.?\d+(?:[eE][-+]?\d+)?)\s*([A-Za-z°%]+)?"


def value_and_unit(c: Column) -> tuple[Column, Column]:
    """(number at the start of the text, lower-case unit after it); null where absent."""
    s = strip(c.cast("string"))
    number = F.nullif(F.regexp_extract(s, NUMBER, 1), F.lit("")).try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number, F.lower(F.nullif(F.regexp_extract(s, NUMBER, 2), F.lit("")))


def kelvin(v: Column, u: Column) -> Column:
    """Kelvin; a missing or unknown unit, degree signs included, is Celsius."""
    return F.when(u == "k", v).when(u == "f", (v - 32) * 5.0 / 9.0 + 273.15).otherwise(v + 273.15)


def scaled(v: Column, u: Column, factors: dict[str, float]) -> Column:
    """``v`` times the factor of its unit; a missing or unknown unit has factor 1."""
    factor = F.lit(1.0)
    for f in sorted(set(factors.values())):
        factor = F.when(u.isin([k for k, x in factors.items() if x == f]), F.lit(f)).otherwise(factor)
    return v * factor


def plain_number(c: Column) -> Column:
    """The text as a number, no unit allowed; NaN is null."""
    v = strip(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(v), v)


def _label(low: Column, high: Column) -> Column:
    return F.concat(low.cast("long").cast("string"), F.lit("-"), high.cast("long").cast("string"))


def bin_temperature(v: Column) -> Column:
    """Bins of 10 K up to 400 K, of 25 K from 400 K above."""
    low = F.when(v <= 400, F.floor(v / 10) * 10).otherwise(F.floor((v - 400) / 25) * 25 + 400)
    return _label(low, low + F.when(v <= 400, 10).otherwise(25))


def bin_decade(v: Column) -> Column:
    """Decades; what is not positive is 0-1. Labels are cut to whole numbers."""
    low = F.floor(F.log10(F.when(v > 0, v)))
    return F.when(v <= 0, F.lit("0-1")).otherwise(_label(F.pow(F.lit(10.0), low), F.pow(F.lit(10.0), low + 1)))


def bin_ph(v: Column) -> Column:
    """Unit bins over 0 to 14, values outside moved to the ends."""
    low = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(14.0), v)))
    return F.when(v.isNotNull(), _label(low, F.least(F.lit(14), low + 1)))


def temperature_label(c: Column) -> Column:
    """Whole kelvin, half to even, as ``298K``; text that is no number stays."""
    text = strip(c.cast("string"))
    v = text.try_cast("double")
    return F.when(F.isnan(v), None).when(v.isNotNull(), F.concat(F.bround(v).cast("long").cast("string"), F.lit("K"))).otherwise(text)


def event_bucket(n: Column) -> Column:
    return F.when(n <= 1, "one").when(n <= 4, "few").otherwise("many")


def tanimoto(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; two empty sets are equal."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)
