"""Money in exact cents: conversion to nominal, constant-price and purchasing-power dollars.

Quotients are taken over whole numbers (cents, scaled rates) and rounded half-even from quotient and
remainder, so that every cent is exact without leaving generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect

_BIG = "decimal(38,0)"


def half_even(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as a whole number, half to even; null for a null or zero denominator.

    With q the whole part of twice the quotient, (q + 1) div 2 rounds half up; an exact half (q odd and no
    rest) that this made odd goes down by one.  No branches, so generated code computes each part once.
    """
    twice, d = F.abs(numerator).cast(_BIG) * 2, F.nullif(denominator.cast(_BIG), F.lit(0).cast(_BIG))
    rest = (twice % d).cast(_BIG)
    q = ((twice - rest) / d).cast(_BIG)
    up = F.floor((q + 1) / 2).cast("bigint")
    tie = ((rest == 0) & (q % 2 == 1) & (up % 2 == 1)).cast("bigint")
    return (up - tie) * F.signum(numerator).cast("bigint")


def scaled(c: Column, places: int, precision: int = 28) -> Column:
    """A number times 10^places as a whole number."""
    return (c.cast(f"decimal({precision},{places})") * F.lit(10**places).cast("decimal(10,0)")).cast(_BIG)


def convert(
    rows: DataFrame,
    fx: DataFrame,
    deflator: DataFrame,
    price_levels: DataFrame,
    pegs: DataFrame | None = None,
    areas: DataFrame | None = None,
    *,
    base_year: int = 2025,
    suspect_amount: float = 1e9,
    suspect_rate: float = 10.0,
) -> DataFrame:
    """Add analysis year, conversion status and the dollar columns (in cents) to canonical records.

    ``rows``: loan_amount, loan_currency, loan_amount_usd, approval_year, commitment_year, country_code,
    loan_type, official_source_id.  ``fx``: series_code, fx_year, units_per_usd.  ``deflator``: year,
    deflator.  ``price_levels``: code, year, gdp_usd, gdp_ppp.  ``pegs`` (optional): currency, series
    of a currency quoted by another's rate.  ``areas`` (optional): area, series, ord; the first series of an
    area in order is its local currency.  All are lists of bounded size that the optimiser broadcasts.

    A reported dollar amount is taken unrounded and wins; a dollar amount that is likely in local currency
    (not official, non-sovereign, above ``suspect_amount``, local rate at least ``suspect_rate``) is left
    out; other currencies take the year's rate.  A null amount or year leaves everything null with a status.
    """
    rates = fx.groupBy("series_code", "fx_year").agg(F.first("units_per_usd").alias("units_per_usd"))
    own = rates.select(F.col("series_code").alias("__series"), F.col("fx_year").alias("__year"), F.col("units_per_usd").alias("__rate"))
    df = rows.withColumn("__year", F.coalesce("approval_year", "commitment_year")).withColumn("__cur", F.upper(F.trim("loan_currency")))
    if pegs is not None:
        df = df.join(pegs.select(F.col("currency").alias("__cur"), F.col("series").alias("__peg")), "__cur", "left")
    df = df.withColumn("__series", F.coalesce("__peg", "__cur") if pegs is not None else F.col("__cur"))
    if areas is not None:
        first = areas.groupBy("area").agg(F.min_by("series", "ord").alias("__s"))
        local = first.join(rates, F.col("__s") == F.col("series_code")).select(F.col("area").alias("country_code"), F.col("fx_year").alias("__year"), F.col("units_per_usd").alias("__local"))
        df = df.join(local, ["country_code", "__year"], "left")
    else:
        df = df.withColumn("__local", F.lit(None).cast("double"))
    df = df.join(own, ["__series", "__year"], "left")
    df = df.join(deflator.select(F.col("year").alias("__year"), scaled(F.col("deflator"), 3).alias("__d")), "__year", "left")
    base = bounded_collect(deflator.where(F.col("year") == base_year).agg(F.max(F.col("deflator").cast("decimal(12,3)")).alias("b")), 1, "base year")[0]["b"]
    df = df.withColumn("__base", F.lit(None if base is None else int(base * 1000)).cast("decimal(12,0)"))
    level = price_levels.select(F.col("code").alias("country_code"), F.col("year").alias("__year"), scaled(F.col("gdp_usd"), 2).alias("__gu"), scaled(F.col("gdp_ppp"), 2).alias("__gp"))
    df = df.join(level, ["country_code", "__year"], "left")

    amount, usd = F.col("loan_amount"), F.col("loan_amount_usd")
    tested = F.coalesce(F.when(usd != 0, usd), amount)
    dollars = usd.isNotNull() | (F.col("__cur") == "USD")
    suspect = dollars & F.col("official_source_id").isNull() & (F.col("loan_type") == "Non-sovereign") & (tested > suspect_amount) & (F.col("__local") >= suspect_rate)
    status = (
        F.when(amount.isNull(), F.lit("no-amount"))
        .when(F.col("__year").isNull(), "no-year")
        .when(F.coalesce(suspect, F.lit(False)), "excluded-currency-suspect")
        .when(dollars, "source-usd")
        .when(F.col("__rate") > 0, "annual-average")
        .otherwise("unconverted")
    )
    df = df.withColumn("conversion", status).withColumn("analysis_year", F.col("__year"))
    cents = F.when(F.col("conversion") == "source-usd", half_even(scaled(F.coalesce(usd, amount), 4), F.lit(100))).when(
        F.col("conversion") == "annual-average", half_even(scaled(amount, 4) * F.lit(10_000), scaled(F.col("__rate"), 6))
    )
    df = df.withColumn("nominal_cents", cents)
    n = F.col("nominal_cents").cast("decimal(20,0)")
    ppp = (F.col("__gu") > 0) & (F.col("__gp") > 0)
    df = (
        df.withColumn("constant_cents", half_even(n * F.col("__base").cast("decimal(9,0)"), F.col("__d")))
        .withColumn("ppp_cents", F.when(ppp, half_even(n * F.col("__gp").cast("decimal(17,0)"), F.col("__gu"))))
        .withColumn(
            "ppp_constant_cents",
            F.when(ppp, half_even(n * F.col("__base").cast("decimal(6,0)") * F.col("__gp").cast("decimal(11,0)"), F.col("__d").cast("decimal(6,0)") * F.col("__gu").cast("decimal(13,0)"))),
        )
    )
    return df.select(*rows.columns, "analysis_year", "conversion", "nominal_cents", "constant_cents", "ppp_cents", "ppp_constant_cents")
