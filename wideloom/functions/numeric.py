"""Money and ratio helpers.

Money is summed as DECIMAL so results are exact and independent of row
order; doubles appear only at presentation.  Ratios that must be rounded
are computed with integer arithmetic (half-up), never by rounding a double.
"""

from __future__ import annotations

import decimal
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def dec(c: Column | str) -> Column:
    """Source amount -> DECIMAL(18,2)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


LO_SCALE = 10  # the finest decimal place of an amount


@dataclass(frozen=True)
class Amount:
    """An exact amount in two LONG limbs: ``hi`` * 10^-scale + ``lo`` * 10^-LO_SCALE.

    Amounts of up to ``scale`` decimals are in ``hi`` alone and have a null ``lo``, so their sums
    cost what one LONG sum costs; finer ones carry the rest (0 to one unit of ``hi``) in
    ``lo``.  Limbs are summed apart and put together once per output row.  The limbs are SQL
    text: a plan with dozens of totals is written as a few texts (see ``sqltext``)."""

    hi: str
    lo: str
    scale: int

    @staticmethod
    def of(name: str, scale: int) -> Amount:
        """The amount that ``with_limbs`` has stored under ``name``."""
        return Amount(f"{name}_u{scale}", f"{name}_lo", scale)

    def where(self, condition: str) -> Amount:
        """The amount where the condition holds, else 0."""
        return Amount(f"CASE WHEN {condition} THEN {self.hi} ELSE 0L END", f"CASE WHEN {condition} THEN {self.lo} END", self.scale)

    def less(self, other: Amount) -> str:
        return (f"({self.hi} < {other.hi} OR ({self.hi} = {other.hi} "
                f"AND coalesce({self.lo}, 0L) < coalesce({other.lo}, 0L)))")


def is_finer(c: str, scale: int) -> str:
    """SQL: the amount has more than ``scale`` decimals (or is no number); false for null.
    The quotient is the double next to the rounded amount, so any other double was finer."""
    return f"coalesce(CAST({quick_units(c, scale)} AS DOUBLE) / {10 ** scale}D <> CAST({c} AS DOUBLE), false)"


def quick_units(c: str, scale: int) -> str:
    """SQL: units of an amount that is not finer than ``scale``."""
    return f"CAST(floor(CAST({c} AS DOUBLE) * {10 ** scale}D + 0.5D) AS BIGINT)"


def exact(c: str, precision: int = 22) -> str:
    """SQL: the decimal that the amount is written as, of up to ``LO_SCALE`` decimals."""
    text, kind = f"CAST({c} AS STRING)", f"DECIMAL({precision},{LO_SCALE})"
    d = f"try_cast({text} AS DECIMAL(38,18))"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {d} = CAST({d} AS {kind}) THEN CAST({d} AS {kind}) "
            f"ELSE CAST(raise_error(concat('amount with more than {LO_SCALE} decimals: ', {text})) AS {kind}) END")


def _split(v: str, scale: int) -> str:
    """SQL: exact decimal -> struct (hi, lo)."""
    kept = f"CAST({v} AS DECIMAL(28,10))"
    whole = f"CAST(floor({kept}, {scale}) AS DECIMAL({18 + scale},{scale}))"
    hi = f"CAST({whole} * CAST({10 ** scale} AS DECIMAL({scale + 1},0)) AS BIGINT)"
    lo = f"CAST(({kept} - {whole}) * CAST({10 ** LO_SCALE} AS DECIMAL({LO_SCALE + 1},0)) AS BIGINT)"
    return (f"CASE WHEN {kept} = {v} THEN named_struct('hi', {hi}, 'lo', {lo}) WHEN {v} IS NOT NULL THEN "
            f"raise_error(concat('amount with more than {LO_SCALE} decimals: ', CAST({v} AS STRING))) END")


def with_limbs(df: DataFrame, scale: int, fine: str, amounts: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with columns ``<name>_u<scale>`` and ``<name>_lo`` per amount, given as SQL of its quick
    units and of its exact decimal value.  The value counts on ``fine`` rows only; it is split by
    a higher-order function, which keeps the rare path out of the generated code."""
    values = ", ".join(f"CAST({v} AS DECIMAL(38,20))" for _, v in amounts.values())
    out = df.selectExpr("*", f"CASE WHEN {fine} THEN transform(array({values}), v -> {_split('v', scale)}) END AS __limbs")
    columns = []
    for i, (name, (quick, _)) in enumerate(amounts.items()):
        columns += [f"coalesce(__limbs[{i}].hi, {quick}) AS {name}_u{scale}", f"__limbs[{i}].lo AS {name}_lo"]
    return out.selectExpr("*", *columns).drop("__limbs")


def from_limbs(hi: str, lo: str, scale: int) -> str:
    """SQL: summed limbs -> exact DECIMAL(38, LO_SCALE); null where ``hi`` is."""
    def part(units: str, places: int) -> str:  # a sum of two such has 38 digits
        step = f"CAST('0.{'1'.rjust(places, '0')}' AS DECIMAL({places + 1},{places}))"
        return f"CAST(CAST({units} AS DECIMAL(20,0)) * {step} AS DECIMAL(37,{LO_SCALE}))"
    return f"CAST({part(hi, scale)} + coalesce({part(lo, LO_SCALE)}, 0) AS DECIMAL(38,{LO_SCALE}))"


def to_units(c: Column | str, scale: int) -> Column:
    """Amount -> integer count of 10^-scale units (fixed point, exact).

    Aggregations sum these as LONG: a hash aggregate over longs is several
    times faster than over DECIMAL, whose sum buffers above 18 digits are
    held as BigDecimal.  Convert back once per output row (``from_units``).
    An amount with more than ``scale`` decimals is an error, never rounded."""
    c = F.col(c) if isinstance(c, str) else c
    scaled = c.cast("double") * F.lit(float(10 ** scale))
    units = F.floor(scaled + F.lit(0.5))
    # beyond what a double's own error explains (NaN and infinity too)
    finer = F.abs(scaled - units) > F.abs(units) * F.lit(1e-15) + F.lit(1e-9)
    refused = F.raise_error(F.concat(F.lit(f"amount with more than {scale} decimals: "), c.cast("string")))
    return F.when(finer, refused.cast("long")).otherwise(units.cast("long"))


def from_units(units: Column, scale: int) -> Column:
    """Integer units -> exact DECIMAL(38, scale)."""
    step = F.expr(f"CAST('{decimal.Decimal(1).scaleb(-scale)}' AS DECIMAL({scale + 1},{scale}))")
    return (units.cast("decimal(20,0)") * step).cast(f"decimal(38,{scale})")


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, 0 when den is 0 or null (guarded divide)."""
    return F.when(F.coalesce(den, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        num.cast("double") / den.cast("double"))


def guarded_pct(num: Column, den: Column) -> Column:
    """round(100 * num / den, 2) half-up for non-negative totals of up to six
    decimals, 0 when den is 0; returned as DECIMAL(20,2) computed exactly."""
    n = num.cast(T.DecimalType(30, 6))
    d = den.cast(T.DecimalType(30, 6))
    hundredths = exact_div(F.lit(20000) * n + d, F.lit(2) * d)
    q = F.when(F.coalesce(d, F.lit(0)) == 0, F.lit(0).cast("long")).otherwise(hundredths)
    return (q.cast(T.DecimalType(20, 0)) * F.lit(0.01).cast(T.DecimalType(2, 2))).cast(T.DecimalType(20, 2))


def exact_div(a: Column, b: Column) -> Column:
    """Floor division of non-negative decimals, exact: the remainder is removed
    first so the decimal quotient is an integer and needs no rounding."""
    return ((a - F.pmod(a, b)) / b).cast("long")


# Never-null identifiers keep BIGINT; every other integral measure is
# presented as DOUBLE (exact below 2**53) so a column that holds NULLs has
# the same representation on every engine's client side.
KEY_COLUMNS = frozenset({"tenant_id", "member_id", "doc_id", "conv_id", "ts", "pos"})


def to_plain(df: DataFrame) -> DataFrame:
    """Presentation at the edge of registered queries: DECIMAL -> DOUBLE, DATE
    -> 'yyyy-MM-dd' text, integral measures -> DOUBLE, identifiers -> BIGINT,
    so results compare across engines without type-system differences."""
    from .sqltext import project, q
    pairs = []
    for f in df.schema.fields:
        c, t = q(f.name), f.dataType
        if isinstance(t, T.DecimalType):
            e = f"CAST({c} AS DOUBLE)"
        elif isinstance(t, T.DateType):
            e = f"date_format({c}, 'yyyy-MM-dd')"
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            e = f"CAST({c} AS BIGINT)" if f.name in KEY_COLUMNS else f"CAST({c} AS DOUBLE)"
        else:
            e = c
        pairs.append((f.name, e))
    return project(df, pairs)
