"""Numbers and money in text: soft-failing parsers built from column expressions (no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlens.functions.text import bound, normalize_text

# Currency signs and names, tried in this order, and active currency codes with two units of account.
CURRENCY_SIGNS = [("US$", "USD"), ("€", "EUR"), ("£", "GBP")]
CURRENCY_NAMES = [
    ("US DOLLAR", "USD"), ("US DOLLARS", "USD"), ("EURO", "EUR"), ("EUROS", "EUR"),
    ("SPECIAL DRAWING RIGHTS", "XDR"), ("SDR", "XDR"), ("UA", "XUA"), ("RMB", "CNY"),
]
CURRENCY_CODES = (
    "AED AFN ALL AMD ANG AOA ARS AUD AWG AZN BAM BBD BDT BGN BHD BIF BMD BND BOB BRL BSD BTN BWP BYN BZD CAD CDF CHF CLP CNY COP CRC "
    "CUP CVE CZK DJF DKK DOP DZD EGP ERN ETB EUR FJD FKP GBP GEL GHS GIP GMD GNF GTQ GYD HKD HNL HTG HUF IDR ILS INR IQD IRR ISK JMD "
    "JOD JPY KES KGS KHR KMF KPW KRW KWD KYD KZT LAK LBP LKR LRD LSL LYD MAD MDL MGA MKD MMK MNT MOP MRU MUR MVR MWK MXN MYR MZN NAD "
    "NGN NIO NOK NPR NZD OMR PAB PEN PGK PHP PKR PLN PYG QAR RON RSD RUB RWF SAR SBD SCR SDG SEK SGD SHP SLE SLL SOS SRD SSP STN SVC "
    "SYP SZL THB TJS TMT TND TOP TRY TTD TWD TZS UAH UGX USD UYU UZS VES VND VUV WST XAF XCD XCG XOF XPF YER ZAR ZMW ZWG ZWL XDR XUA"
).split()
# Words of magnitude; the Spanish ones keep the rule for grouping dots.
MAGNITUDES = {
    "k": 3, "thousand": 3, "mil": 3, "m": 6, "mn": 6, "million": 6, "millions": 6, "millon": 6, "millones": 6,
    "b": 9, "bn": 9, "billion": 9, "billions": 9,
}
SPANISH = ["mil", "millon", "millones"]


def plain_number(token: Column, dot_is_decimal: Column | None = None) -> Column:
    """A number token with a point as the only separator.

    With both separators the later one is the decimal; a single comma or dot before exactly three digits
    groups (a dot not if ``dot_is_decimal``); repeated ones group.
    """
    t = F.regexp_replace(token, r"[\s '  ]", "")
    commas, dots = F.regexp_count(t, F.lit(",")), F.regexp_count(t, F.lit(r"\."))
    no_dot, no_comma = F.regexp_replace(t, r"\.", ""), F.regexp_replace(t, ",", "")
    comma_last = F.length(F.substring_index(t, ",", -1)) < F.length(F.substring_index(t, ".", -1))
    point = F.lit(False) if dot_is_decimal is None else dot_is_decimal
    return (
        F.when((commas > 0) & (dots > 0), F.when(comma_last, F.regexp_replace(no_dot, ",", ".")).otherwise(no_comma))
        .when(commas == 1, F.when(F.length(F.substring_index(t, ",", -1)) == 3, no_comma).otherwise(F.regexp_replace(t, ",", ".")))
        .when(commas > 1, no_comma)
        .when((dots == 1) & ~point & t.rlike(r"^[-+]?\d+\.\d{3}$"), no_dot)
        .when(dots > 1, no_dot)
        .otherwise(t)
    )


def parse_decimal(c: Column, dot_is_decimal: Column | None = None, resolved: bool = False) -> Column:
    """The first number of a text as DECIMAL(38,10); brackets around the text negate; null where there is none."""
    point = F.lit(False) if dot_is_decimal is None else dot_is_decimal
    return bound(F.struct(normalize_text(c, resolved).alias("t"), point.alias("p")), lambda x: _decimal(x["t"], x["p"]))


def _decimal(t: Column, dot_is_decimal: Column) -> Column:
    run = F.regexp_extract(t, r"([-+]?\d[\d\s.,'  ]*)", 1)
    n = bound(run, lambda r: F.regexp_replace(plain_number(r, dot_is_decimal), r"^\+|\.$", "").try_cast("decimal(38,10)"))
    return F.when(t.rlike(r"^\(.*\)$"), -n).otherwise(n)


def detect_currency(c: Column, default: Column | None = None, resolved: bool = False) -> Column:
    """The currency a text names by sign, name or code, in this order, else the default; null where neither."""
    other = F.lit(None).cast("string") if default is None else F.nullif(F.upper(default), F.lit(""))
    return bound(F.struct(normalize_text(c, resolved).alias("t"), other.alias("d")), lambda x: _currency(x["t"], x["d"]))


def _currency(t: Column, out: Column) -> Column:
    up = F.upper(t)
    codes = F.filter(F.regexp_extract_all(up, F.lit(r"(?<![A-Z])([A-Z]{3})(?![A-Z])"), F.lit(1)), lambda x: x.isin(CURRENCY_CODES))
    out = F.coalesce(F.get(codes, 0), out)
    for name, code in reversed(CURRENCY_NAMES):
        out = F.when(up.rlike(rf"(?<![A-Z]){name}(?![A-Z])"), F.lit(code)).otherwise(out)
    for sign, code in reversed(CURRENCY_SIGNS):
        out = F.when(F.contains(t, F.lit(sign)), F.lit(code)).otherwise(out)
    return out


def parse_amount(c: Column, default: Column | None = None, dot_is_decimal: bool = False, resolved: bool = False) -> Column:
    """``struct<amount decimal(38,4), currency string>``; magnitude words multiply, an English one makes a lone dot decimal."""
    t = F.lower(F.translate(normalize_text(c, resolved), "áéíóúÁÉÍÓÚñ", "aeiouAEIOUn"))
    word = F.regexp_extract(t, r"[\d\s](millon(?:es)?|millions?|billions?|thousand|mil|mn|bn|k|m|b)\b", 1)
    english = F.lit(True) if dot_is_decimal else (word != "") & ~word.isin(SPANISH)
    n = parse_decimal(c, english, resolved)
    factor = F.lit(1).cast("decimal(12,0)")
    for w, p in MAGNITUDES.items():
        factor = F.when(word == w, F.lit(10**p).cast("decimal(12,0)")).otherwise(factor)
    return F.struct((n.cast("decimal(25,8)") * factor).cast("decimal(38,4)").alias("amount"), detect_currency(c, default, resolved).alias("currency"))


def parse_coordinate(c: Column, resolved: bool = False) -> Column:
    """A coordinate as DECIMAL(12,8); a comma is a decimal comma, three decimals never group."""
    t = F.regexp_replace(normalize_text(c, resolved), "[  ]", "")
    return F.translate(F.regexp_extract(t, r"([-+]?\d+(?:[.,]\d+)?)", 1), ",", ".").try_cast("decimal(12,8)")
