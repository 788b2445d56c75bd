"""Column expressions. All are built-ins, so they stay inside whole-stage code generation."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """numerator / denominator as double; null (never an error) when the denominator is zero."""
    return col(numerator).cast("double") / F.nullif(col(denominator).cast("double"), F.lit(0.0))


def flag(condition: Column) -> Column:
    return condition.cast("int")


def holds(condition: Column) -> Column:
    """A condition in which an unknown comparison counts as false."""
    return F.coalesce(condition, F.lit(False))


def date_key(date: ColumnOrName) -> Column:
    d = col(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def sunday_zero_weekday(date: ColumnOrName) -> Column:
    return F.dayofweek(col(date)) - 1


def month_start(date: ColumnOrName) -> Column:
    return F.trunc(col(date), "month")


def week_start(date: ColumnOrName) -> Column:
    """Monday of the week."""
    return F.date_sub(col(date), F.weekday(col(date)))


def snake_case(text: ColumnOrName) -> Column:
    """Lower case, every run of other characters than letters and digits one underscore."""
    return F.btrim(F.regexp_replace(F.lower(F.trim(col(text))), "[^a-z0-9]+", "_"), F.lit("_"))


def normal_quantile(p: float) -> float:
    """z with P(Z <= z) = p; a driver-side literal per service level."""
    return NormalDist().inv_cdf(p)


# Coefficients of Hart's double-precision rational approximation of the normal
# distribution function (West's form), highest power first.
_NUMERATOR = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
              112.079291497871, 221.213596169931, 220.206867912376)
_DENOMINATOR = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
                296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
_TAIL = (1.0, 2.0, 3.0, 4.0, 0.65)
_ROOT_TWO_PI = 2.506628274631


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def normal_cdf(x: ColumnOrName) -> Column:
    """P(Z <= x); absolute error below 1e-15."""
    x = col(x).cast("double")
    a = F.abs(x)
    density = F.exp(-a * a / 2.0)
    fraction = a + F.lit(_TAIL[-1])
    for c in reversed(_TAIL[:-1]):
        fraction = a + F.lit(c) / fraction
    upper = (
        F.when(a > 37.0, F.lit(0.0))
        .when(a < 7.071, density * _polynomial(a, _NUMERATOR) / _polynomial(a, _DENOMINATOR))
        .otherwise(density / fraction / F.lit(_ROOT_TWO_PI))
    )
    return F.when(x > 0.0, 1.0 - upper).otherwise(upper)


def hashed_draw(modulus: int, *parts: ColumnOrName) -> Column:
    """An integer in [0, modulus) that depends only on the text of `parts`, whatever the row order."""
    text = F.concat_ws("|", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % modulus


def tidy(x: ColumnOrName) -> Column:
    """Presentation rounding: four decimals from a million on, six below."""
    x = col(x)
    coarse = F.floor(x * 1e4 + 0.5).cast("double") / 1e4
    fine = F.floor(x * 1e6 + 0.5).cast("double") / 1e6
    return F.when(F.abs(x) >= 1e6, coarse).otherwise(fine)
