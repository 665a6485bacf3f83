"""Dates in text, years, durations and coverage windows as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlens.functions.text import bound, normalize_text

# Spanish months by number.
SPANISH_MONTHS = {
    "enero": "01", "febrero": "02", "marzo": "03", "abril": "04", "mayo": "05", "junio": "06", "julio": "07", "agosto": "08",
    "septiembre": "09", "setiembre": "09", "octubre": "10", "noviembre": "11", "diciembre": "12",
}
_MONTH_NUMBERS = {m: f"{k:02d}" for k, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)}


def parse_date(c: Column, day_first: bool | None = None, resolved: bool = False) -> Column:
    """A date in any of the notations met, as DATE; null where none applies.

    Dates with slashes whose order is unknown (``day_first`` None) are null, as they could be read two ways.
    A month without a day is its first day, a year its first of January.  Two-digit years honour
    ``day_first`` as well.
    """
    t = F.regexp_replace(normalize_text(c, resolved), r"\s*\([^)]*\)\s*$", "")
    low = F.regexp_replace(F.lower(F.translate(t, "，", ",")), r",(?=\S)", ", ")
    for name, number in SPANISH_MONTHS.items():
        low = F.regexp_replace(low, rf"\b{name}\b", number)
    return bound(low, lambda x: _read(x, day_first))


def _read(low: Column, day_first: bool | None) -> Column:
    month = F.regexp_extract(low, r"\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\b", 1)
    mm = F.lit(None).cast("string")
    for name, number in _MONTH_NUMBERS.items():
        mm = F.when(month == name, F.lit(number)).otherwise(mm)
    named = F.regexp_replace(low, r"\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\b", "#")
    return bound(F.struct(named.alias("n"), mm.alias("m")), lambda x: _match(x["n"], x["m"], day_first))


def _match(named: Column, mm: Column, day_first: bool | None) -> Column:
    def group(pattern: str, *order: int) -> list[Column]:
        return [F.nullif(F.regexp_extract(named, pattern, k), F.lit("")) for k in order]

    def made(y: Column, m: Column, d: Column) -> Column:
        return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")

    def when(pattern: str, y: Column, m: Column, d: Column) -> Column:
        return F.when(named.rlike(pattern), made(y, m, d))

    iso = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})(?:[t ].*)?$"
    dmy = r"^(\d{1,2})[ -]#[ ,-]*(\d{4})$"
    mdy = r"^# (\d{1,2}), (\d{4})$"
    my = r"^#,? (\d{4})$"
    dnum = r"^(\d{1,2})[ -](?:de )?(\d{1,2})[ -](?:de )?(\d{4})$"
    slash = r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})$"
    y, m, d = group(iso, 1, 2, 3)
    out = [when(iso, y, m, d)]
    d, y = group(dmy, 1, 2)
    out.append(when(dmy, y, mm, d))
    d, y = group(mdy, 1, 2)
    out.append(when(mdy, y, mm, d))
    (y,) = group(my, 1)
    out.append(when(my, y, mm, F.lit("01")))
    d, m, y = group(dnum, 1, 2, 3)
    out.append(when(dnum, y, m, d))
    if day_first is not None:
        a, b, y = group(slash, 1, 2, 3)
        century = F.when(F.length(y) == 2, F.concat(F.when(y.try_cast("int") < 69, F.lit("20")).otherwise(F.lit("19")), y)).otherwise(y)
        out.append(when(slash, century, *((b, a) if day_first else (a, b))))
        out.append(when(slash, century, *((a, b) if day_first else (b, a))))
    (y,) = group(r"^(\d{4})$", 1)
    out.append(F.when(named.rlike(r"^\d{4}$"), F.concat(y, F.lit("-01-01")).try_cast("date")))
    return F.coalesce(*out)


def pivot_date(c: Column, pivot: int = 60) -> Column:
    """``d-MMM-yy`` with two-digit years from ``pivot`` on in the last century."""
    t = F.lower(F.trim(c))
    yy = F.regexp_extract(t, r"-(\d{2})$", 1).try_cast("int")
    mm = F.lit(None).cast("string")
    for name, number in _MONTH_NUMBERS.items():
        mm = F.when(F.regexp_extract(t, r"-([a-z]{3})", 1) == name, F.lit(number)).otherwise(mm)
    year = F.when(yy >= pivot, 1900 + yy).otherwise(2000 + yy)
    return F.concat_ws("-", year.cast("string"), mm, F.lpad(F.regexp_extract(t, r"^(\d{1,2})-", 1), 2, "0")).try_cast("date")


def extract_year(*values: Column) -> Column:
    """The first year from 1900 to 2199 in the values, one after the other."""
    return F.coalesce(*[F.regexp_extract(v.cast("string"), r"\b(19\d{2}|20\d{2}|21\d{2})\b", 1).try_cast("int") for v in values])


def duration_years(start: Column, end: Column) -> Column:
    """Years between two dates, three places half-even; null where the end comes first."""
    days = F.datediff(end, start)
    return F.when(days >= 0, F.bround(days.cast("decimal(12,4)") / F.lit("365.2425").cast("decimal(8,4)"), 3).cast("decimal(9,3)"))


def stale(latest: Column, newest_year: Column, today: str, days: int = 274) -> Column:
    """Whether the newest date is older than ``days`` and no year is today's."""
    t = F.lit(today).cast("date")
    return (F.datediff(t, latest) > days) & (newest_year < F.year(t))


def window_bounds(start: Column, end: Column, seen: Column, least: int, most: int) -> tuple[Column, Column]:
    """First and last covered year: the declared window inside the scope, open ends closed by the last year seen."""
    return F.greatest(F.lit(least), F.coalesce(start, F.lit(least))), F.least(F.lit(most), F.coalesce(end, seen, F.lit(most)))
