"""Grouped measures: one-pass look-back windows, lifecycle (first/last),
totals with guarded ratios.

All of these are plain ``groupBy().agg()`` plans, so Spark runs a partial
(map-side) aggregate before the shuffle: a hot key collapses to one row per
map task before it is exchanged.
"""

from __future__ import annotations

import decimal

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import Amount, from_limbs, guarded_pct
from ..functions.sqltext import project, q
from ..params import AsOf

# A measure turns "row is inside the window" into an aggregate column.
MeasureFn = Callable[[Column], Column]


@dataclass(frozen=True)
class Measure:
    """``build`` makes the aggregate from the condition column, or ``sql`` its text from the
    condition's text."""

    name: str
    build: MeasureFn | None
    sql: Callable[[str], str] | None = None

    def column(self, inside: str) -> Column:
        return F.expr(self.sql(inside)) if self.sql else self.build(F.expr(inside))


def sum_of(name: str, expr: Column) -> Measure:
    """sum(expr) over the window's rows."""
    return Measure(name, lambda inside: F.sum(F.when(inside, expr)))


def count_rows(name: str) -> Measure:
    return Measure(name, lambda inside: F.count(F.when(inside, F.lit(1))))


def sum_pair(name: str, a: Column, b: Column, scale: int | None = None) -> Measure:
    """coalesce(sum(a),0) + coalesce(sum(b),0): two component totals added."""
    def build(inside: Column) -> Column:
        total = (F.coalesce(F.sum(F.when(inside, a)), F.lit(0))
                 + F.coalesce(F.sum(F.when(inside, b)), F.lit(0)))
        return F.round(total, scale) if scale is not None else total
    return Measure(name, build)


def row_sum_coalesced(name: str, a: Column, b: Column, scale: int | None = None) -> Measure:
    """sum(coalesce(a,0) + coalesce(b,0)) per row (one null policy for all windows)."""
    def build(inside: Column) -> Column:
        total = F.sum(F.when(inside, F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))))
        return F.round(total, scale) if scale is not None else total
    return Measure(name, build)


def _of_sql(name: str, sql: Callable[[str], str]) -> Measure:
    return Measure(name, None, sql)


def amount_sum(name: str, a: Amount) -> Measure:
    """Exact sum of an amount, limb by limb."""
    return _of_sql(name, lambda inside: from_limbs(f"sum(CASE WHEN {inside} THEN {a.hi} END)",
                                                   f"sum(CASE WHEN {inside} THEN {a.lo} END)", a.scale))


def _pair(inside: str, x: str, y: str) -> str:
    return f"coalesce(sum(CASE WHEN {inside} THEN {x} END), 0L) + coalesce(sum(CASE WHEN {inside} THEN {y} END), 0L)"


def amount_pair(name: str, a: Amount, b: Amount) -> Measure:
    """``sum_pair`` of two amounts of one scale."""
    return _of_sql(name, lambda inside: from_limbs(_pair(inside, a.hi, b.hi), _pair(inside, a.lo, b.lo), a.scale))


def amount_row_sum(name: str, a: Amount, b: Amount) -> Measure:
    """``row_sum_coalesced`` of two amounts of one scale."""
    return _of_sql(name, lambda inside: from_limbs(
        f"sum(CASE WHEN {inside} THEN coalesce({a.hi}, 0L) + coalesce({b.hi}, 0L) END)", _pair(inside, a.lo, b.lo), a.scale))


def is_full_price(pay: Amount, total: Amount) -> str:
    """SQL: not known to be paid below the total."""
    return f"NOT coalesce({pay.less(total)}, false)"


def full_price_average(name: str, pay: Column | Amount, total: Column | Amount) -> Measure:
    """Average paid amount over full-price rows (not pay < total).

    A null comparison counts as full price, so a row with null pay enters the
    denominator but adds nothing to the numerator; 0 when there is no
    full-price row.
    """
    if isinstance(pay, Amount):
        full = is_full_price(pay, total)

        def sql(inside: str) -> str:
            sel = f"({inside} AND {full})"
            hi, lo = (f"coalesce(sum(CASE WHEN {sel} THEN {x} END), 0L)" for x in (pay.hi, pay.lo))
            cnt = f"count(CASE WHEN {sel} THEN 1 END)"
            num = from_limbs(hi, lo, pay.scale)
            return f"CASE WHEN {cnt} > 0 THEN CAST({num} AS DOUBLE) / CAST({cnt} AS DOUBLE) ELSE 0D END"
        return _of_sql(name, sql)
    full = ~F.coalesce(pay < total, F.lit(False))

    def build(inside: Column) -> Column:
        sel = inside & full
        num = F.coalesce(F.sum(F.when(sel, pay)), F.lit(0))
        cnt = F.count(F.when(sel, F.lit(1)))
        return F.when(cnt > 0, num.cast("double") / cnt.cast("double")).otherwise(F.lit(0.0))
    return Measure(name, build)


@dataclass(frozen=True)
class Section:
    """Rows of one section of a source (``predicate``; None = all rows) and
    its measures.  ``scan``: a weaker condition that a reader can evaluate, where
    the whole predicate keeps its date bound from the scan."""
    measures: tuple
    predicate: Column | None = None
    scan: Column | None = None


def sectioned_aggregate(df: DataFrame, keys: Sequence[str], sections: dict[str, Section],
                        prefilter: Column | None = None) -> DataFrame:
    """Several sections of one source in a single scan and a single shuffle.

    Each section sees only the rows matching its predicate (conditional
    aggregates), ``has_<section>`` says whether a key has any such row, and the
    section's measures are NULL where it has none -- exactly what separate
    per-section queries followed by a keyed full merge would give, but with
    one partial+final aggregate instead of one per section.
    """
    rows = df.filter(prefilter) if prefilter is not None else df
    aggs, finals = [], [(k, q(k)) for k in keys]
    # each predicate is computed once per row, whatever the number of its measures
    rows = rows.withColumns({f"__in_{n}": s.predicate for n, s in sections.items() if s.predicate is not None})
    for name, sec in sections.items():
        inside = q(f"__in_{name}") if sec.predicate is not None else "true"
        n = f"__n_{name}"
        aggs.append(F.expr(f"count(CASE WHEN {inside} THEN 1 END) AS {q(n)}"))
        finals.append((f"has_{name}", f"{q(n)} > 0"))
        for m in sec.measures:
            aggs.append(m.column(inside).alias(m.name))
            finals.append((m.name, f"CASE WHEN {q(n)} > 0 THEN {q(m.name)} END"))
    return project(rows.groupBy(*keys).agg(*aggs), finals)


def window_sections(date_col: str, asof: AsOf, plan: dict[str, Sequence[Measure]],
                    prefix: str = "w") -> dict[str, Section]:
    """Look-back windows as sections: window name -> rows dated on/after its
    inclusive lower bound (and on/before the as-of day when ``asof.upper``)."""
    d = F.col(date_col)
    out = {}
    for w, measures in plan.items():
        pred = d >= F.lit(asof.lower_bound(w))
        if asof.upper:
            pred = pred & (d <= F.lit(asof.day))
        out[f"{prefix}{w}"] = Section(tuple(measures), pred)
    return out


def windowed_totals(df: DataFrame, keys: Sequence[str], date_col: str, asof: AsOf,
                    plan: dict[str, Sequence[Measure]]) -> DataFrame:
    """All look-back windows of one source in a single scan and one shuffle.

    ``plan`` maps a window name (see ``params.WINDOWS``) to its measures.  The
    scan is limited to the widest window (pushed to the reader as a ``>=``
    filter on the date column); each measure only sees the rows of its own
    window.  A window in which a key has no row yields NULL measures, which is
    what a separate per-window query followed by a keyed merge would give.
    """
    secs = window_sections(date_col, asof, plan)
    widest = min(asof.lower_bound(w) for w in plan)
    out = sectioned_aggregate(df, keys, secs, prefilter=F.col(date_col) >= F.lit(widest))
    return out.select(*keys, *[m.name for ms in plan.values() for m in ms])


def min_of(name: str, expr: Column) -> Measure:
    return Measure(name, lambda inside: F.min(F.when(inside, expr)))


def max_of(name: str, expr: Column) -> Measure:
    return Measure(name, lambda inside: F.max(F.when(inside, expr)))


_DAY_SHIFT = 2 ** 31      # unix_date(date) + shift >= 0
_ATTR_SHIFT = 2 ** 63     # long attribute + shift >= 0
_ATTR_SPAN = 2 ** 65      # one bit more than a long: null has a code of its own
_NULL_LAST = 2 ** 64


def _big(n: int) -> Column:
    return F.lit(decimal.Decimal(n)).cast("decimal(38,0)")


def _day_attr_key(date: Column, attr: Column, shift: int, null_code: int) -> Column:
    """(date, long attribute) packed into one DECIMAL(38,0) that orders like the
    pair, a null attribute as ``null_code``.  min/max over it keeps a
    fixed-width aggregation buffer, so the aggregate stays hash-based (a struct
    buffer would force a sort-based aggregate over the whole fact input)."""
    hi = ((F.unix_date(date).cast("decimal(38,0)") + _big(_DAY_SHIFT)) * _big(_ATTR_SPAN)).cast("decimal(38,0)")
    code = F.coalesce((attr.cast("decimal(38,0)") + _big(shift)).cast("decimal(38,0)"), _big(null_code))
    return (hi + code).cast("decimal(38,0)")


def _attr_of_key(key: Column, shift: int, null_code: int) -> Column:
    code = F.pmod(key, _big(_ATTR_SPAN))
    return F.when(code != _big(null_code), (code - _big(shift)).cast("long"))


def attr_at_first(name: str, date: Column, attr: Column, integral: bool = True) -> Measure:
    """Attribute on the first date; ties on the date go to the smallest
    attribute, null only where that date has no other."""
    if integral:
        codes = (_ATTR_SHIFT, _NULL_LAST)
        return Measure(name, lambda inside: _attr_of_key(F.min(F.when(inside & date.isNotNull(),
                                                                      _day_attr_key(date, attr, *codes))), *codes))
    s = F.struct(date.alias("d"), attr.isNull().alias("n"), attr.alias("a"))
    return Measure(name, lambda inside: F.min(F.when(inside & date.isNotNull(), s))["a"])


def attr_at_last(name: str, date: Column, attr: Column, integral: bool = True) -> Measure:
    """Attribute on the last date; ties on the date go to the largest
    attribute, null only where that date has no other."""
    if integral:
        codes = (_ATTR_SHIFT + 1, 0)
        return Measure(name, lambda inside: _attr_of_key(F.max(F.when(inside & date.isNotNull(),
                                                                      _day_attr_key(date, attr, *codes))), *codes))
    s = F.struct(date.alias("d"), attr.isNotNull().alias("n"), attr.alias("a"))
    return Measure(name, lambda inside: F.max(F.when(inside & date.isNotNull(), s))["a"])


def days_since_first(name: str, asof: AsOf, date: Column) -> Measure:
    return Measure(name, lambda inside: F.datediff(F.lit(asof.day), F.min(F.when(inside, date))))


def days_since_last(name: str, asof: AsOf, date: Column) -> Measure:
    return Measure(name, lambda inside: F.datediff(F.lit(asof.day), F.max(F.when(inside, date))))


def pct_of(name: str, num: Column, den: Column) -> Measure:
    """round(100 * sum(num) / sum(den), 2), 0 when sum(den) = 0."""
    return Measure(name, lambda inside: guarded_pct(F.sum(F.when(inside, num)), F.sum(F.when(inside, den))))


def flag_of(name: str, expr: Column, yes: str = "Y", no: str = "N") -> Measure:
    """yes when sum(expr) > 0."""
    return Measure(name, lambda inside: F.when(F.sum(F.when(inside, expr)) > 0, F.lit(yes)).otherwise(F.lit(no)))


def rounded(m: Measure, scale: int) -> Measure:
    if m.sql:
        return Measure(m.name, None, lambda inside: f"round({m.sql(inside)}, {scale})")
    return Measure(m.name, lambda inside: F.round(m.build(inside), scale))


def totals_with_ratio(df: DataFrame, keys: Sequence[str], num: Column, den: Column,
                      num_name: str, den_name: str, pct_name: str,
                      flags: dict[str, str] | None = None) -> DataFrame:
    """sum(num), sum(den), round(100*num/den, 2) (0 when den = 0), and
    optional Y/N flags ``{flag_name: total_name}`` for totals > 0."""
    out = df.groupBy(*keys).agg(F.sum(den).alias(den_name), F.sum(num).alias(num_name))
    out = out.withColumn(pct_name, guarded_pct(F.col(num_name), F.col(den_name)))
    for flag, total in (flags or {}).items():
        out = out.withColumn(flag, F.when(F.col(total) > 0, F.lit("Y")).otherwise(F.lit("N")))
    return out

