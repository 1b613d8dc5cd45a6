"""Arithmetic helpers whose results do not depend on the order rows arrive in."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_BITS = 20


def as_double(col: Column) -> Column:
    """Plain double without a negative zero."""
    return col.cast("double") + F.lit(0.0)


@dataclass(frozen=True)
class Amount:
    """An exact amount, held as a whole number (bigint) of ``10 ** -digits``.

    Double sums change with the partitioning, and decimal sums cost about three times as much. An amount is
    summed as two longs, its upper and its lower bits: exact for some 8 * 10**12 rows per group, after which Spark
    raises an error. The halves meet once per group, as a decimal.
    """

    units: Column
    digits: int = 2

    def when(self, test: Column) -> Amount:
        return Amount(F.when(test, self.units), self.digits)

    def times(self, factor: Amount) -> Amount:
        return Amount(self.units * factor.units, self.digits + factor.digits)

    def minus(self, other: Amount) -> Amount:
        digits = max(self.digits, other.digits)
        return Amount(self.at(digits) - other.at(digits), digits)

    def at(self, digits: int) -> Column:
        return self.units * F.lit(10 ** (digits - self.digits)) if digits > self.digits else self.units

    def total(self) -> Column:
        """Aggregate: the sum in units, as decimal(29,0); null when every row is null."""
        upper = F.sum(F.shiftright(self.units, _LOW_BITS)).cast("decimal(20,0)")
        lower = F.sum(self.units.bitwiseAND(F.lit(2**_LOW_BITS - 1))).cast("decimal(20,0)")
        return upper * F.lit(2**_LOW_BITS) + lower

    def sum(self) -> Column:
        """Aggregate: the sum, as a double."""
        return in_units(self.total(), self.digits)

    def mean(self) -> Column:
        """Aggregate: the mean over non-null rows, as a double; null when there are none."""
        return F.try_divide(self.sum(), F.count(self.units))

    def rounded_sum(self, digits: int) -> Column:
        """Aggregate: the sum rounded half up, as a double."""
        return as_double(F.round(self.total() * F.lit(Decimal(1).scaleb(-self.digits)), digits))

    def rounded_mean(self, digits: int) -> Column:
        """Aggregate: the mean rounded half up, as a double.

        Whole-number division decides ties by the true quotient; a double quotient may lie a hair below it.
        """
        n = F.count(self.units)
        parts = n.cast("decimal(20,0)") * F.lit(10 ** (self.digits - digits))
        total = self.total()
        nearest = F.call_function("div", F.abs(total) * 2 + parts, parts * 2) * F.sign(total).cast("bigint")
        return F.when(n > 0, in_units(nearest.cast("decimal(20,0)"), digits))

    def value(self) -> Column:
        """The amount of one row, as a double."""
        return in_units(self.units.cast("decimal(20,0)"), self.digits)


def amount(col: Column | str, digits: int = 2) -> Amount:
    """The column, whose values have at most that many digits, as an exact amount; a value with more raises an error.

    A thousandth of the last digit is allowed for, or four steps between neighbouring doubles where these are larger, since
    a double holds most decimal fractions only nearly. For values of unknown digits use ``floating``.
    """
    scaled = (F.col(col) if isinstance(col, str) else col) * F.lit(float(10**digits))
    nearest = F.rint(scaled)
    cut = F.raise_error(F.concat(F.lit(f"more than {digits} digits after the point: "), (scaled / F.lit(float(10**digits))).cast("string")))
    allowed = F.greatest(F.lit(1e-3), F.abs(scaled) * F.lit(2.0**-50))
    return Amount(F.when(F.abs(scaled - nearest) > allowed, cut.cast("bigint")).otherwise(nearest.cast("bigint")), digits)


_LIMB = float(2**30)


@dataclass(frozen=True)
class Floating:
    """A double of any digits, summed so that the order of the rows makes no difference.

    Each value is cut, without loss, into four whole numbers of about 30 bits that count multiples of 2**30, 1, 2**-30 and 2**-60,
    and these are summed as longs: exact for 2**33 rows per group. What lies below 2**-61 is rounded off per row.
    Groups with a value of 2**60 or more, or one that isn't a number, have Spark's own sum, whose last digits depend on the
    order.
    """

    values: Column

    def when(self, test: Column) -> Floating:
        return Floating(F.when(test, self.values))

    def _limbs(self) -> list[Column]:
        x = self.values.cast("double")
        steps = [F.rint(x * F.lit(_LIMB**k)) for k in (-1, 0, 1, 2)]
        parts = [steps[0], *(low - high * F.lit(_LIMB) for high, low in zip(steps, steps[1:], strict=False))]
        return [F.when(F.abs(x) < F.lit(2.0**60), p).cast("bigint") for p in parts]

    def sum(self) -> Column:
        """Aggregate: the sum, as a double; null when every row is null."""
        high, ones, low, least = (F.sum(part).cast("decimal(20,0)") for part in self._limbs())
        limb = F.lit(2**30)
        above, below = (high * limb + ones).cast("double"), (low * limb + least).cast("double") * F.lit(_LIMB**-2)
        # also true of infinities and of NaN, which is greater than any number
        large = F.max(F.abs(self.values.cast("double"))) >= F.lit(2.0**60)
        return F.when(large, F.sum(self.values.cast("double"))).otherwise(above + below) + F.lit(0.0)

    def mean(self) -> Column:
        """Aggregate: the mean over non-null rows, as a double; null when there are none."""
        return F.try_divide(self.sum(), F.count(self.values))

    def rounded_sum(self, digits: int) -> Column:
        """Aggregate: the sum rounded half up, as a double."""
        return F.round(self.sum(), digits)

    def rounded_mean(self, digits: int) -> Column:
        """Aggregate: the mean rounded half up, as a double."""
        return F.round(self.mean(), digits)


def floating(col: Column | str) -> Floating:
    return Floating(F.col(col) if isinstance(col, str) else col)


def in_units(total: Column, digits: int) -> Column:
    """A decimal count of units as the nearest double."""
    return as_double(total * F.lit(Decimal(1).scaleb(-digits)))


def round_half_up(col: Column, digits: int) -> Column:
    return F.round(col, digits)


def round_half_even(col: Column, digits: int) -> Column:
    """Banker's rounding, as pandas rounds."""
    return F.bround(col, digits)


def rescale(col: Column, divisor: float, digits: int, half_even: bool = False) -> Column:
    scaled = col / F.lit(divisor)
    return round_half_even(scaled, digits) if half_even else round_half_up(scaled, digits)
