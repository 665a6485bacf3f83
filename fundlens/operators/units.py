"""Quantities in different units: a unit grammar, exponent vectors and conversion to canonical units.

A unit expression such as ``USD '000``, ``km/h``, ``Mrd. QTN`` or ``10^9 EUR`` is parsed by a small
recursive-descent grammar::

    expr   := factor (('*' | '·' | juxtaposition | '/' | 'per') factor)*
    factor := atom ('^' INTEGER)?
    atom   := NUMBER | SCALE | UNIT | '(' expr ')'

The value is a :class:`Unit`: a vector of exponents over base dimensions, a power of ten, a further scale
and an offset (for temperatures).  Two units are convertible exactly when their vectors agree.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.core.tables import bounded_collect

# Words for powers of ten, as printed in English, French, Spanish, German and Indian usage.
SCALE_WORDS = {
    "cent": -2, "cents": -2, "minor units": -2,
    "k": 3, "000": 3, "thousand": 3, "thousands": 3, "millier": 3, "milliers": 3, "mil": 3, "mille": 3, "miles": 3,
    "tsd": 3, "lakh": 5, "lakhs": 5,
    "m": 6, "mn": 6, "mln": 6, "mio": 6, "million": 6, "millions": 6, "millon": 6, "millones": 6, "millionen": 6,
    "cr": 7, "crore": 7, "crores": 7,
    "bn": 9, "billion": 9, "billions": 9, "milliard": 9, "milliards": 9, "mrd": 9,
}
# Spellings of currencies that are not their code.
CURRENCY_WORDS = {
    "us$": "USD", "$": "USD", "us dollar": "USD", "us dollars": "USD", "u.s. dollar": "USD", "u.s. dollars": "USD",
    "dollar": "USD", "dollars": "USD", "€": "EUR", "euro": "EUR", "euros": "EUR", "sdr": "XDR", "sdrs": "XDR",
    "£": "GBP", "¥": "JPY",
}
# Physical units as (dimension exponents, scale to the base unit, offset).
PHYSICAL = {
    "m": ({"L": 1}, 1.0, 0.0), "km": ({"L": 1}, 1e3, 0.0), "cm": ({"L": 1}, 1e-2, 0.0), "mile": ({"L": 1}, 1609.344, 0.0),
    "ft": ({"L": 1}, 0.3048, 0.0), "ha": ({"L": 2}, 1e4, 0.0), "acre": ({"L": 2}, 4046.8564224, 0.0), "l": ({"L": 3}, 1e-3, 0.0),
    "kg": ({"M": 1}, 1.0, 0.0), "g": ({"M": 1}, 1e-3, 0.0), "t": ({"M": 1}, 1e3, 0.0), "lb": ({"M": 1}, 0.45359237, 0.0),
    "s": ({"T": 1}, 1.0, 0.0), "min": ({"T": 1}, 60.0, 0.0), "h": ({"T": 1}, 3600.0, 0.0), "day": ({"T": 1}, 86400.0, 0.0),
    "k": ({"K": 1}, 1.0, 0.0), "degc": ({"K": 1}, 1.0, 273.15), "degf": ({"K": 1}, 5 / 9, 459.67 * 5 / 9),
    "w": ({"M": 1, "L": 2, "T": -3}, 1.0, 0.0), "kw": ({"M": 1, "L": 2, "T": -3}, 1e3, 0.0), "mw": ({"M": 1, "L": 2, "T": -3}, 1e6, 0.0),
    "kwh": ({"M": 1, "L": 2, "T": -2}, 3.6e6, 0.0), "%": ({}, 1e-2, 0.0),
}
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|u\.s\.\s*dollars?|us\s+dollars?|minor units|per\s?cent\b|us\$|[^\W\d_]+|[$€£¥%*·/^()]")
#: Tokens that join the parts of a unit.
_JOINING = {"*", "·", "of", "de", "/", "per", "(", ")", "^"}
_RESTATED = re.compile(r"\b(already|converted|full units|scaled up|single|full dollars)\b")


@dataclass(frozen=True)
class Unit:
    """Exponents over base dimensions, 10^exp10 x scale and an additive offset, all to the base units."""

    dims: tuple[tuple[str, int], ...] = ()
    exp10: int = 0
    scale: float = 1.0
    offset: float = 0.0

    def combine(self, other: "Unit", sign: int) -> "Unit":
        sums: dict[str, int] = dict(self.dims)
        for dim, power in other.dims:
            sums[dim] = sums.get(dim, 0) + sign * power
        return Unit(
            tuple(sorted((d, p) for d, p in sums.items() if p)),
            self.exp10 + sign * other.exp10,
            self.scale * other.scale**sign,
            self.offset or other.offset,
        )

    def to_base(self, value: float) -> float:
        return value * self.scale * 10.0**self.exp10 + self.offset


@dataclass
class Grammar:
    """The grammar over one set of currency codes; ``money_only`` leaves the physical units out."""

    codes: frozenset[str]
    money_only: bool = True
    _at: int = field(default=0, repr=False)

    def tokens(self, text: str) -> list[str]:
        out: list[str] = []
        for tok in _TOKEN.findall(text.casefold()):
            tok = re.sub(r"\s+", " ", tok)
            if tok not in SCALE_WORDS and self.currency(tok) is None and tok.endswith("k") and self.currency(tok[:-1]):
                out += [tok[:-1], "k"]  # "USDk"
            else:
                out.append(tok)
        return out

    def currency(self, tok: str) -> str | None:
        if tok.upper() in self.codes:
            return tok.upper()
        return CURRENCY_WORDS.get(tok)

    def atom(self, tok: str) -> Unit | None:
        code = self.currency(tok)
        if code is not None:
            return Unit(((code, 1),))
        if not self.money_only and tok in PHYSICAL:
            dims, scale, offset = PHYSICAL[tok]
            return Unit(tuple(sorted(dims.items())), 0, scale, offset)
        if tok in SCALE_WORDS:
            return Unit(exp10=SCALE_WORDS[tok])
        if re.fullmatch(r"10+", tok):
            return Unit(exp10=len(tok) - 1)
        return None

    def parse(self, text: str | None) -> Unit | None:
        """The unit a text states, or None where it isn't a unit expression."""
        if text is None:
            return None
        toks = self.tokens(text)
        if not toks:
            return None
        self._at = 0
        unit = self._expr(toks)
        return unit if unit is not None and self._at == len(toks) else None

    def _expr(self, toks: list[str]) -> Unit | None:
        unit, sign, seen = Unit(), 1, False
        while self._at < len(toks) and toks[self._at] != ")":
            tok = toks[self._at]
            if tok in ("*", "·", "of", "de"):
                self._at += 1
                continue
            if tok in ("/", "per"):
                sign, self._at = -1, self._at + 1
                continue
            factor = self._factor(toks)
            if factor is None:
                return None
            # "billions (10^9)" restates the power it follows
            restated = tok == "(" and not factor.dims and factor.exp10 == unit.exp10 != 0
            unit, sign, seen = unit if restated else unit.combine(factor, sign), 1, True
        return unit if seen else None

    def _factor(self, toks: list[str]) -> Unit | None:
        tok = toks[self._at]
        if tok == "(":
            self._at += 1
            unit = self._expr(toks)
            if unit is None or self._at >= len(toks):
                return None
            self._at += 1
        else:
            unit = self.atom(tok)
            self._at += 1
            if unit is None:
                return None
        if self._at + 1 < len(toks) and toks[self._at] == "^" and toks[self._at + 1].isdigit():
            power = int(toks[self._at + 1])
            self._at += 2
            raised = Unit()
            for _ in range(power):
                raised = raised.combine(unit, 1)
            return raised
        return unit

    def statement(self, prose: str | None) -> int | None:
        """The power of ten that a sentence states for its amounts; 0 if it says they are single units; else None.

        In each clause the longest run of tokens that parses as a unit with a scale is the statement, and the
        first clause with one decides; a clause that says the amounts were already converted states single
        units.  A scale of one or two letters counts only beside a currency.
        """
        found: int | None = None
        for clause in re.split(r"[;.](?:\s|$)", prose or ""):
            unit = self.longest_unit(self.tokens(clause))
            if _RESTATED.search(clause.casefold()) and (unit or "dollar" in clause.casefold() or "unit" in clause.casefold()):
                return 0
            if unit and found is None:
                found = unit.exp10
        return found

    def longest_unit(self, toks: list[str]) -> Unit | None:
        """The unit of the longest run of tokens that parses and has a scale word or a power; the first of equal ones."""
        part = [t in _JOINING or t.isdigit() or self.atom(t) is not None for t in toks]
        best: tuple[int, Unit] | None = None
        for i, fits in enumerate(part):
            if not fits or toks[i] in _JOINING - {"("}:
                continue
            end = next((k for k in range(i, len(toks)) if not part[k]), len(toks))
            for j in range(end, i, -1):
                if best and j - i <= best[0]:
                    break
                run = toks[i:j]
                if not any(t in SCALE_WORDS for t in run) and "^" not in run:
                    continue
                self._at = 0
                unit = self._expr(run)
                if unit is None or self._at < len(run) or not unit.exp10 or (not unit.dims and all(len(t) < 3 or t == "mil" for t in run)):
                    continue
                best = (j - i, unit)
        return best[1] if best else None


@lru_cache(maxsize=64)
def grammar(codes: tuple[str, ...], money_only: bool = True) -> Grammar:
    return Grammar(frozenset(codes), money_only)


_NUMBER = re.compile(r"[-+]?\d+(?:[.,  ]\d{3})*(?:[.,]\d+)?")


def parse_quantity(text: str | None, codes: Iterable[str], money_only: bool = False) -> tuple[float, Unit] | None:
    """A number with its unit, as ``(value in base units, unit)``; None where the text isn't a quantity."""
    m = _NUMBER.search(text or "")
    if not m:
        return None
    raw = re.sub(r"[  ]", "", m[0])
    last = max(raw.rfind(","), raw.rfind("."))
    if "," in raw and "." in raw:
        raw = re.sub(r"[.,]", "", raw[:last]) + "." + raw[last + 1 :]
    elif raw.count(",") > 1 or raw.count(".") > 1 or re.fullmatch(r"[-+]?\d{1,3},\d{3}", raw):
        raw = re.sub(r"[.,]", "", raw)
    else:
        raw = raw.replace(",", ".")
    rest = (text[: m.start()] + " " + text[m.end() :]).strip()
    unit = Unit() if not rest else grammar(tuple(sorted(codes)), money_only).parse(rest)
    return None if unit is None else (unit.to_base(float(raw)), unit)


def unit_column(text: Column, codes: list[str]) -> Column:
    """``struct<exp10 int, currency string>`` of a unit text; null where it doesn't parse. No shuffle: each
    batch parses its distinct texts once."""
    key = tuple(sorted(codes))

    def parse(batch: pd.Series) -> pd.DataFrame:
        g, labels = grammar(key), pd.factorize(batch)
        parsed = []
        for t in labels[1]:
            u = g.parse(t)
            ok = u is not None and len(u.dims) == 1 and u.dims[0][1] == 1 and u.scale == 1.0
            parsed.append((u.exp10, u.dims[0][0]) if ok else (None, None))
        parsed.append((None, None))  # label -1: null
        out = pd.DataFrame([parsed[i] for i in labels[0]], columns=["exp10", "currency"])
        return out.astype({"exp10": "Int32"})

    return F.pandas_udf(parse, "exp10 int, currency string")(text)


def statement_column(prose: Column, codes: list[str]) -> Column:
    """The power of ten a note states (int), null where it states none."""
    key = tuple(sorted(codes))

    def parse(batch: pd.Series) -> pd.Series:
        g, labels = grammar(key), pd.factorize(batch)
        parsed = [*(g.statement(t) for t in labels[1]), None]
        return pd.Series([parsed[i] for i in labels[0]], dtype="Int32")

    return F.pandas_udf(parse, "int")(prose)


#: Powers of ten that amounts without any stated unit are printed in, and how far (in powers of ten) the figures
#: may be off; lakhs and crores lie between others and must fit well.
FIGURE_EXPONENTS = {-2: 0.9, 0: 0.9, 3: 0.9, 6: 0.9, 9: 0.9, 5: 0.3, 7: 0.3}
#: |amounts| from here on are placeholders for "unknown", not quantities.
PLACEHOLDER = 9e13


def to_single_units(
    rows: DataFrame,
    fx: DataFrame,
    sources: DataFrame,
    *,
    amount: str = "loan_amount",
    unit: str = "loan_currency",
    note: str = "data_quality_notes",
    source: str = "official_source_id",
    usd: str = "loan_amount_usd",
    wider: str = "total_commitment",
    wider_currency: str = "commitment_currency",
    years: tuple[str, ...] = ("approval_year", "commitment_year"),
) -> DataFrame:
    """Add ``exp10``, ``currency``, ``single_amount`` and ``unit_basis`` to ``rows``.

    What states the power of ten, in this order: the unit text itself; a note in the row; other figures of
    the row (the amount in USD, else a wider amount of one to about one and a half times it) through the
    year's exchange rate; the prose about the source.  Rows without an amount or a readable unit, zero or
    negative amounts and placeholders get null ``exp10``; an amount with a readable unit and nothing that
    speaks for a power is in single units (``exp10`` 0, basis ``plain``).

    ``fx`` and ``sources`` are reference lists; the optimiser broadcasts them by their measured size.
    """
    rows = rows.drop("exp10", "currency", "single_amount", "unit_basis")  # results replace columns of these names
    codes = sorted({r[0] for r in bounded_collect(fx.select("series_code").distinct(), 1000, "currency codes") if r[0]} | {"USD"})
    mean = fx.groupBy("series_code").agg(F.exp(F.avg(F.log("units_per_usd"))).alias("__fx_mean"))
    said = sources.select(F.col("source_id").alias("__sid"), statement_column(F.col("scope_note"), codes).alias("__said"))
    a = F.col(amount).cast("double")
    year = F.coalesce(*[F.col(y) for y in years])
    df = (
        rows.withColumn("__u", unit_column(F.col(unit), codes))
        .withColumn("__note", statement_column(F.col(note), codes))
        .withColumn("__code", F.col("__u.currency"))
        .withColumn("__year", year)
    )
    df = df.join(fx.select(F.col("series_code").alias("__code"), F.col("fx_year").alias("__year"), F.col("units_per_usd").alias("__fx")), ["__code", "__year"], "left")
    df = df.join(mean.withColumnRenamed("series_code", "__code"), "__code", "left")
    df = df.join(said, F.col(source) == F.col("__sid"), "left")
    rate = F.when(F.col("__code") == "USD", F.lit(1.0)).otherwise(F.coalesce("__fx", "__fx_mean"))
    usable = (a > 0) & (a < PLACEHOLDER)
    w = F.when((F.col(wider) > 0) & (F.upper(F.trim(F.col(wider_currency))) == "USD"), F.col(wider).cast("double"))
    off = F.coalesce(
        F.log10(F.when(F.col(usd) > 0, F.col(usd).cast("double")) * rate / a),
        F.log10(w * rate / a) - 0.1,
    )
    near = F.lit(None).cast("int")
    for e, far in FIGURE_EXPONENTS.items():  # the later ones first
        near = F.when(F.abs(off - e) < far, F.lit(e)).otherwise(near)
    df = df.withColumn("__figure", F.when(usable, near))
    text = F.when(F.col("__u.exp10") != 0, F.col("__u.exp10"))
    df = df.withColumn("exp10", F.when(usable & F.col("__code").isNotNull(), F.coalesce(text, "__note", "__figure", "__said", F.lit(0))))
    df = df.withColumn(
        "unit_basis",
        F.when(F.col("exp10").isNull(), F.lit(None))
        .when(text.isNotNull(), "unit text")
        .when(F.col("__note").isNotNull(), "note")
        .when(F.col("__figure").isNotNull(), "figures")
        .when(F.col("__said").isNotNull(), "source")
        .otherwise("plain"),
    )
    df = df.withColumn("currency", F.col("__code"))
    # decimal arithmetic: doubles lose cents from 10^14 on
    power = F.lit(None).cast("decimal(14,4)")
    for e in sorted({*FIGURE_EXPONENTS, *SCALE_WORDS.values()}):
        power = F.when(F.col("exp10") == e, F.expr(f"CAST({10.0**e:.4f} AS DECIMAL(14,4))")).otherwise(power)
    single = (F.col(amount).cast("decimal(22,4)") * power).cast("decimal(32,4)")
    return df.withColumn("single_amount", single).select(*rows.columns, "exp10", "currency", "single_amount", "unit_basis")


__all__ = ["Grammar", "Unit", "grammar", "parse_quantity", "statement_column", "to_single_units", "unit_column"]
