"""Rounding that gives the same digits in every engine.

T-SQL rounds numerics half away from zero. Spark's decimal division keeps
six fractional digits and rounds them, which rounds twice; DuckDB turns
decimal division into a double. Both can miss a half-way case, so ratios
that the reference rounds are computed from their integer numerator and
denominator: round(n/d, s) = (2*10^s*n + d) div (2*d) / 10^s for n >= 0,
d > 0. Doubles that the reference rounds as FLOAT use
sign(x) * floor(|x|*10^s + 0.5) / 10^s, evaluated identically in IEEE
arithmetic by Spark and DuckDB.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column) -> Column:
    """Exact integral division (Spark's ``div``), also on decimal(38,0)."""
    return F.call_function("div", a, b)


def _whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def round_ratio(num: Column, den: Column, scale: int, precision: int = 38) -> Column:
    """decimal(precision, scale) of num/den rounded half up; NULL if den is 0/NULL.

    ``num`` and ``den`` must be integer valued and ``num >= 0``.
    """
    n, d = _whole(num), _whole(den)
    k = 2 * 10 ** scale
    q = idiv(n * F.lit(k) + d, F.lit(2) * d)
    unit = F.lit(Decimal(1).scaleb(-scale)) if scale else F.lit(Decimal(1))
    out = (_whole(q) * unit).cast(f"decimal({precision},{scale})")
    return F.when(d > 0, out)


def ratio_double(num: Column, den: Column, scale: int) -> Column:
    """round_ratio as a double (the reference's FLOAT outputs)."""
    return round_ratio(num, den, scale).cast("double")


def round_double(x: Column, scale: int) -> Column:
    """Half-away-from-zero rounding of a double (ROUND on FLOAT)."""
    p = float(10 ** scale)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(p) + F.lit(0.5)) / F.lit(p)


def money_cents(c: Column) -> Column:
    """Integer cents of a decimal(.,2) money amount, as decimal(38,0)."""
    return (c * F.lit(100)).cast("decimal(38,0)")


# ------------------------------------------------------------ SQL (DuckDB)
def sql_round_ratio(num: str, den: str, scale: int, precision: int = 38) -> str:
    k = 2 * 10 ** scale
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    unit = str(Decimal(1).scaleb(-scale)) if scale else "1"
    return (f"CASE WHEN ({den}) > 0 THEN CAST(CAST(({n} * {k} + {d}) // (2 * {d}) AS DECIMAL(38,0))"
            f" * {unit} AS DECIMAL({precision},{scale})) END")


def sql_ratio_double(num: str, den: str, scale: int) -> str:
    return f"CAST({sql_round_ratio(num, den, scale)} AS DOUBLE)"


def sql_round_double(x: str, scale: int) -> str:
    p = float(10 ** scale)
    return f"(sign({x}) * floor(abs({x}) * {p} + 0.5) / {p})"


def sql_money_cents(c: str) -> str:
    return f"CAST(({c}) * 100 AS DECIMAL(38,0))"
