"""Deterministic rounding.

Double sums depend on the order a shuffle delivers rows in, and an average of 2-dp values is
often an exact tie at the next digit, so ``round(avg(double), 2)`` can differ between runs and
engines. These helpers aggregate exactly, in whole millionths ("micro-units"), and round the
exact result once, half up, so every shuffle order gives one answer.

How, and why not DECIMAL: a cast from double to DECIMAL(18,6) formats each value as decimal
text in the JVM, and a DECIMAL sum wider than 18 digits adds BigDecimals; both together cost
about 7x a double average per row. Here each value becomes two whole numbers with plain arithmetic:
``blocks``, how many times 2^40 goes into it (0 for all but huge values), and ``micro``, the rest in
millionths. ``micro`` is split into three parts and ``blocks`` into two, which are summed as bigints
(partial aggregation before the shuffle, as for any sum), then recombined as a decimal once per
group and rounded half up. A part sum stays exact up to 2^42 (4.4 trillion) rows per group; a sum
past a bigint fails the query, with or without ANSI mode, rather than return a wrong number.

Every value that is not NULL counts, whatever its size, and none ends the query: values from 2^93 (10^28)
on, and sums from 2^102 on, make a group's result that of a double sum. A NaN or an infinity gives
what a double sum or average gives.

Departure from a plain double average: each value is first rounded half up to whole millionths of
its binary value.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICRO = 1_000_000
_BITS = 21
_MASK = (1 << _BITS) - 1
_BLOCK = 1 << 40
_WIDE = 2.0 ** 93
_EXACT = 1 << 62  # blocks whose sum is carried exactly
_LOW_BITS = 30
_LOW = (1 << _LOW_BITS) - 1
_NARROW = 2.0 ** 20
_TOTAL, _VALUE = "decimal(38,0)", "decimal(38,6)"
_OVERFLOW = "more or larger values in a group than an exact sum can hold"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _counted(x: Column) -> Column:
    """True for the values that blocks and micro-units hold."""
    return F.abs(x) < F.lit(_WIDE)


def blocks(c: Column | str) -> Column:
    """How many times 2^40 goes into ``x``, towards zero; NULL from 2^93 on and for NULL and NaN."""
    x = _c(c)
    n = F.floor(F.abs(x) / F.lit(float(_BLOCK)))
    return F.when(_counted(x), F.when(x < 0, -n).otherwise(n))


def micro_units(c: Column | str) -> Column:
    """What ``blocks`` leaves of ``x``, as a bigint of millionths, rounded half up (away from zero); 0 where
    there are no blocks, NULL for NULL. Taking off blocks and the whole part is exact, so only the
    fraction is rounded."""
    x = _c(c)
    rest = F.abs(x) - F.floor(F.abs(x) / F.lit(float(_BLOCK))) * F.lit(float(_BLOCK))
    m = F.floor(rest) * F.lit(MICRO) + F.floor((rest - F.floor(rest)) * F.lit(float(MICRO)) + F.lit(0.5))
    return F.when(_counted(x), F.when(x < 0, -m).otherwise(m)).when(x.isNotNull(), F.lit(0))


@dataclass(frozen=True)
class Exact:
    """The parts of a double that its exact sums and averages need, as columns of any kind: expressions
    over the double, or columns projected once and shared by several aggregates."""

    micro: Column
    blocks: Column
    odd: Column  # the value itself from 2^93 on, and if it is NaN or infinite

    @classmethod
    def of(cls, c: Column | str) -> "Exact":
        x = _c(c)
        return cls(micro_units(x), blocks(x), F.when(~_counted(x), x))

    def _total(self) -> tuple[Column, Column]:
        """(exact sum in micro-units, sum of blocks), as DECIMAL(38,0); an overflow of the parts is raised. ``hi``
        cannot overflow before ``lo`` or ``mid``."""
        lo = F.try_sum(self.micro.bitwiseAND(F.lit(_MASK)))
        mid = F.try_sum(F.shiftright(self.micro, _BITS).bitwiseAND(F.lit(_MASK)))
        hi = F.try_sum(F.shiftright(self.micro, 2 * _BITS))
        large_lo = F.try_sum(self.blocks.bitwiseAND(F.lit(_LOW)))
        large_hi = F.try_sum(F.shiftright(self.blocks, _LOW_BITS))
        total = (hi.cast(_TOTAL) * F.lit(1 << (2 * _BITS)).cast(_TOTAL)
                 + mid.cast(_TOTAL) * F.lit(1 << _BITS).cast(_TOTAL) + lo.cast(_TOTAL))
        large = F.coalesce(large_hi.cast(_TOTAL) * F.lit(1 << _LOW_BITS).cast(_TOTAL) + large_lo.cast(_TOTAL), F.lit(0).cast(_TOTAL))
        lost = hi.isNotNull() & (lo + mid + F.when(large_hi.isNotNull(), large_lo).otherwise(0)).isNull()
        return F.when(lost, F.raise_error(F.lit(_OVERFLOW)).cast(_TOTAL)).otherwise(total), large

    def _rounded(self, scale: int, average: bool) -> Column:
        """Sum or average rounded half up to ``scale`` decimals, as a double; NULL when no value.

        Spark's decimal division keeps 6 decimals of the quotient (half up), and that is rounded again
        to ``scale`` decimals of the value. The first rounding can only matter when a group of more
        than 2 million rows has an average within 10^-12 of a tie, the same kind of double rounding
        as Spark's own DECIMAL average."""
        total, large = self._total()
        n = F.count(self.micro).cast("decimal(20,0)")
        million = F.lit(MICRO).cast("decimal(7,0)")
        units = F.round(total / n if average else total, scale - 6)  # a whole multiple of 10^(6-scale) micro-units
        small = (units / million).cast("double")
        small_enough = F.abs(large) < F.lit(_EXACT).cast("decimal(20,0)")
        fits = F.when(small_enough, large).cast("decimal(20,0)")
        value = (total / million).cast(_VALUE) + (fits * F.lit(_BLOCK).cast("decimal(13,0)")).cast(_VALUE)
        whole = F.round(value / n if average else value, scale).cast("double")
        odd = F.sum(self.odd)
        double = (large.cast("double") * F.lit(float(_BLOCK)) + (total / million).cast("double")) + F.coalesce(odd, F.lit(0.0))
        wide = double / n.cast("double") if average else double
        return (F.when(odd.isNotNull() | ~small_enough, wide)
                .when(large != F.lit(0).cast(_TOTAL), whole).otherwise(small))

    def avg(self, scale: int = 2) -> Column:
        return self._rounded(scale, average=True)

    def sum(self, scale: int = 2) -> Column:
        return self._rounded(scale, average=False)


@dataclass(frozen=True)
class Narrow:
    """The parts of a measure that a rule keeps below 2^20 in size: two part sums and a count in place of
    five. The same results as :class:`Exact` while the bound holds; a value beyond it counts too, but its
    group's result is then that of a double sum."""

    micro: Column  # 0 for a value beyond the bound, NULL for NULL
    odd: Column  # the value itself if it is beyond the bound, NaN or infinite

    @classmethod
    def of(cls, c: Column | str) -> "Narrow":
        x = _c(c)
        size, inside = F.abs(x), F.abs(x) < F.lit(_NARROW)
        m = F.floor(size) * F.lit(MICRO) + F.floor((size - F.floor(size)) * F.lit(float(MICRO)) + F.lit(0.5))
        return cls(F.when(inside, F.when(x < 0, -m).otherwise(m)).when(x.isNotNull(), F.lit(0)), F.when(~inside, x))

    def _rounded(self, scale: int, average: bool) -> Column:
        lo = F.try_sum(self.micro.bitwiseAND(F.lit(_MASK)))
        hi = F.try_sum(F.shiftright(self.micro, _BITS))
        n, million = F.count(self.micro).cast("decimal(20,0)"), F.lit(MICRO).cast("decimal(7,0)")
        total = hi.cast(_TOTAL) * F.lit(1 << _BITS).cast(_TOTAL) + lo.cast(_TOTAL)
        total = F.when((n > 0) & (lo + hi).isNull(), F.raise_error(F.lit(_OVERFLOW)).cast(_TOTAL)).otherwise(total)
        small = (F.round(total / n if average else total, scale - 6) / million).cast("double")
        odd = F.sum(self.odd)
        wide = odd + (total / million).cast("double")
        return F.when(odd.isNotNull(), wide / n.cast("double") if average else wide).otherwise(small)

    def avg(self, scale: int = 2) -> Column:
        return self._rounded(scale, average=True)

    def sum(self, scale: int = 2) -> Column:
        return self._rounded(scale, average=False)


def round_avg(c: Column | str, scale: int = 2) -> Column:
    """``round(avg(c), scale)`` computed exactly; NULLs skipped; double result."""
    return Exact.of(c).avg(scale)


def round_sum(c: Column | str, scale: int = 2) -> Column:
    """``round(sum(c), scale)`` computed exactly; NULL when no value; double result."""
    return Exact.of(c).sum(scale)


def _if(cond: Column, then: Column, other: Column) -> Column:
    return F.call_function("if", cond, then, other)  # less code per row than CASE WHEN


def _steps(kind: type[Exact] | type[Narrow], name: str) -> list[dict[str, Column]]:
    """The parts of column ``__x_<name>`` in steps that each read columns of the step before. Written as one
    expression (``kind.of``) a step's value is copied wherever it is used, and the method that Spark
    generates for the row outgrows the 8,000 bytes up to which the JVM compiles it."""
    wide, n = _WIDE if kind is Exact else _NARROW, name
    x, held, whole = F.col(f"__x_{n}"), F.col(f"__held_{n}"), F.col(f"__whole_{n}")
    inside = F.abs(x) < F.lit(wide)
    signed = lambda v: _if(x < F.lit(0.0), -v, v)
    steps = [{f"__held_{n}": _if(inside, F.abs(x), _if(x.isNull(), x, F.lit(0.0))), f"__odd_{n}": _if(inside, F.lit(None).cast("double"), x)}]
    if kind is Exact:
        steps += [{f"__many_{n}": F.floor(held / F.lit(float(_BLOCK)))},
                  {f"__held_{n}": held - F.col(f"__many_{n}") * F.lit(float(_BLOCK))}]
    steps += [{f"__whole_{n}": F.floor(held)},
              {f"__micro_{n}": whole * F.lit(MICRO) + F.floor((held - whole) * F.lit(float(MICRO)) + F.lit(0.5))},
              {f"__micro_{n}": signed(F.col(f"__micro_{n}"))}]
    if kind is Exact:
        steps[-1][f"__blocks_{n}"] = signed(F.col(f"__many_{n}"))
    return steps


def shared_parts(df: DataFrame, keep: list[str], narrow: tuple[str, ...] = (),
                 **measures: Column) -> tuple[DataFrame, dict[str, Exact | Narrow]]:
    """``keep`` and the exact parts of each measure, projected once per row below an aggregate, so that a
    sum and an average of a measure share them and the aggregate's per-row method stays small. ``narrow``
    names the measures that a rule of the table keeps small. The parts are those of ``Exact.of`` and
    ``Narrow.of`` (beyond 2^93 and for NaN the blocks are 0 here, not NULL, which no sum can tell)."""
    rows, parts, steps = df.select(*keep, *[c.alias(f"__x_{name}") for name, c in measures.items()]), {}, []
    for name in measures:
        kind = Narrow if name in narrow else Exact
        parts[name] = kind(**{part: F.col(f"__{part}_{name}") for part in kind.__dataclass_fields__})
        for i, step in enumerate(_steps(kind, name)):
            steps += [{}] if i == len(steps) else []
            steps[i] |= step
    for step in steps:
        rows = rows.withColumns(step)
    return rows.select(*keep, *[f"__{part}_{n}" for n, p in parts.items() for part in p.__dataclass_fields__]), parts


def _rounded_sql(x: str, scale: int, average: bool) -> str:
    counted = f"abs({x}) < {_WIDE!r}D"
    n_blocks = f"floor(abs({x}) / {float(_BLOCK)!r}D)"
    rest = f"(abs({x}) - {n_blocks} * {float(_BLOCK)!r}D)"
    m = f"(floor({rest}) * {MICRO} + floor(({rest} - floor({rest})) * {float(MICRO)!r}D + 0.5D))"
    signed = lambda v, other: f"(CASE WHEN {counted} THEN (CASE WHEN {x} < 0 THEN -{v} ELSE {v} END){other} END)"
    u, w = signed(m, f" WHEN {x} IS NOT NULL THEN 0"), signed(n_blocks, "")
    hi, mid, lo, l_hi, l_lo = (f"try_sum({p})" for p in (
        f"shiftright({u}, {2 * _BITS})", f"shiftright({u}, {_BITS}) & {_MASK}", f"{u} & {_MASK}",
        f"shiftright({w}, {_LOW_BITS})", f"{w} & {_LOW}"))
    number = lambda v, kind=_TOTAL: f"CAST({v} AS {kind})"
    large = f"coalesce({number(l_hi)} * {number(1 << _LOW_BITS)} + {number(l_lo)}, {number(0)})"
    total = (f"(CASE WHEN {hi} IS NOT NULL AND {lo} + {mid} + (CASE WHEN {l_hi} IS NOT NULL THEN {l_lo} ELSE 0 END) IS NULL"
             f" THEN {number(f"raise_error('{_OVERFLOW}')")}"
             f" ELSE {number(hi)} * {number(1 << (2 * _BITS))} + {number(mid)} * {number(1 << _BITS)} + {number(lo)} END)")
    n = f"count({u})"
    part = f" / {number(n, 'DECIMAL(20,0)')}" if average else ""
    million = f"CAST({MICRO} AS DECIMAL(7,0))"
    enough = f"abs({large}) < {number(_EXACT, 'DECIMAL(20,0)')}"
    fits = number(f"CASE WHEN {enough} THEN {large} END", "DECIMAL(20,0)")
    value = f"({number(f'{total} / {million}', _VALUE)} + {number(f'{fits} * {number(_BLOCK, 'DECIMAL(13,0)')}', _VALUE)})"
    odd = f"sum(CASE WHEN NOT {counted} THEN {x} END)"
    wide = (f"(({number(large, 'DOUBLE')} * {float(_BLOCK)!r}D + {number(f'{total} / {million}', 'DOUBLE')}) + coalesce({odd}, 0.0D))"
            + (f" / {number(n, 'DOUBLE')}" if average else ""))
    return (f"CASE WHEN {odd} IS NOT NULL OR NOT {enough} THEN {wide}"
            f" WHEN {large} != {number(0)} THEN {number(f'round({value}{part}, {scale})', 'DOUBLE')}"
            f" ELSE {number(f'round({total}{part}, {scale - 6}) / {million}', 'DOUBLE')} END")


def round_avg_sql(x: str, scale: int = 2) -> str:
    """Spark SQL text of :func:`round_avg` over the SQL expression ``x``."""
    return _rounded_sql(x, scale, average=True)


def round_sum_sql(x: str, scale: int = 2) -> str:
    """Spark SQL text of :func:`round_sum` over the SQL expression ``x``."""
    return _rounded_sql(x, scale, average=False)


def round_value(c: Column | str, scale: int = 2) -> Column:
    """Row-level half-up rounding of a double (Spark rounds the decimal text of the double)."""
    return F.round(_c(c), scale)


def round_value_fast(c: Column | str, scale: int = 2) -> Column:
    """The same value as ``F.round(c, scale)`` on a double, without a BigDecimal per row.

    Spark rounds the double's decimal text half up (away from zero). Scaled by 10^scale, that text
    and the double differ by far less than 10^-6 while the scaled magnitude is below 10^9, so
    unless the scaled value lies within 10^-6 of a half, ``floor(|y| + 0.5)`` picks the same whole
    number. Near a half, for larger magnitudes and for NaN/Infinity, Spark's ``round`` is used.
    The whole number gets its sign as a bigint, so a small negative value gives 0.0, as Spark does."""
    x = _c(c)
    y = F.abs(x) * F.lit(float(10 ** scale))
    frac = y - F.floor(y)
    safe = (y < F.lit(1e9)) & (F.abs(frac - F.lit(0.5)) > F.lit(1e-6))
    fast = F.floor(y + F.lit(0.5)) * _if(x < 0, F.lit(-1), F.lit(1)) / F.lit(float(10 ** scale))
    return F.when(safe, fast).otherwise(F.round(x, scale))


def rounds_to_at_most(c: Column | str, limit: float, scale: int = 2) -> Column:
    """``F.round(c, scale) <= limit`` as one comparison of the value itself: with the smallest decimal text
    that rounds to more than the limit. Both sides of it agree with Spark's ``round`` on every double (NaN
    is above any limit); a limit that is negative or beyond 10^9 is compared with the rounded value."""
    x, unit = _c(c), 10 ** scale
    if not 0 <= limit < 1e9:
        return F.round(x, scale) <= F.lit(limit)
    k = int(Decimal(limit) * unit) + 1
    while k / unit > limit:
        k -= 1
    return x < F.lit(float((Decimal(k) + Decimal("0.5")) / unit))


def pct(part: Column | str, whole: Column | str, scale: int) -> Column:
    """``round(part / whole * 100, scale)``; NULL when ``whole`` is 0 (ANSI-safe)."""
    return F.round(F.try_divide(_c(part).cast("double"), _c(whole)) * F.lit(100), scale)
