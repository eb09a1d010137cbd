"""Number parsing, exact sums and rounding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Exchange prices and sizes carry at most eight decimals; sums keep them all, so that a total
# does not depend on the order in which tasks add their rows.
SUM_TYPE = "decimal(38,8)"
SUM_SCALE = 100_000_000
LARGEST_REGULAR = float(2**43)
SMALLEST_REGULAR = 1e-6
LARGEST = 1.7976931348623157e308


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Finite double, or NULL for text that is no number, NaN and infinities."""
    x = _col(c).try_cast("double")
    return F.when(F.abs(x) <= F.lit(LARGEST), x)  # NaN sorts above every number


def number_or(c: Column | str, default: float = 0.0) -> Column:
    """Finite double with a default for everything else."""
    return F.coalesce(number(c), F.lit(float(default)))


def given_number(c: Column | str, default: float = 0.0) -> Column:
    """A missing value becomes ``default``; a value that is present but no number stays NULL."""
    return number(F.coalesce(_col(c), F.lit(repr(float(default)))))


def parsed(c: Column | str, default: float = 0.0) -> Column:
    """Double with a default for a missing value; unreadable text is NULL, NaN stays. See :func:`finite`."""
    return F.coalesce(_col(c), F.lit(repr(float(default)))).try_cast("double")


def finite(c: Column | str) -> Column:
    """Whether a double is a finite number, mentioning the expression only once."""
    return F.coalesce(_col(c) * F.lit(0.0) == F.lit(0.0), F.lit(False))


def is_regular(c: Column | str) -> Column:
    """Whether integer part and eight decimals stand for a number: its size is below ``LARGEST_REGULAR``,
    and at least ``SMALLEST_REGULAR`` unless it is a multiple of the last decimal anyway."""
    size = F.abs(_col(c).cast("double"))
    units = size * F.lit(float(SUM_SCALE))
    whole = F.abs(units - F.rint(units)) <= F.lit(1e-9)
    return (size < F.lit(LARGEST_REGULAR)) & ((size >= F.lit(SMALLEST_REGULAR)) | whole)


def exact_total(c: Column | str) -> Column:
    """Order-independent sum of the regular values as a decimal aggregate; pairs with :func:`odd_total`.

    The whole part and two groups of four decimals are summed as integers, several times faster
    than a decimal per row. The sum of whole parts has room for 10^18.
    """
    regular = F.when(is_regular(c), _col(c).cast("double"))
    whole, decimals = whole_part(regular), fraction_part(regular)
    upper = F.floor(decimals / F.lit(10_000))
    parts = (F.sum(whole), "1"), (F.sum(upper), "0.0001"), (F.sum(decimals - upper * 10_000), "0.00000001")
    total = None
    for part, unit in parts:
        term = part.cast("decimal(20,0)") * F.lit(unit).cast("decimal(9,8)")
        total = term if total is None else total + term
    return total.cast(SUM_TYPE)


def odd_total(c: Column | str) -> Column:
    """Plain double sum of the values that :func:`exact_total` leaves out, NULL if there are none.

    Values that small or that large are faulty records as a rule. They add up like any doubles:
    nothing saturates or fails, and only among themselves may the order show in the last digit.
    """
    x = _col(c).cast("double")
    return F.sum(F.when(~is_regular(x), x))


def joined_total(regular: Column | str, odd: Column | str) -> Column:
    """Double from the two totals; NULL where both are."""
    a, b = _col(regular).cast("double"), _col(odd)
    return F.when(b.isNull(), a).otherwise(F.coalesce(a, F.lit(0.0)) + b)


def exact_sum(c: Column | str) -> Column:
    """Sum as a double aggregate that does not depend on the order of regular values."""
    return joined_total(exact_total(c), odd_total(c))


def exact_avg(c: Column | str) -> Column:
    """Exact sum over the count of non-null values."""
    return F.try_divide(exact_sum(c), F.count(_col(c)).cast("double"))


def round_half_up(c: Column, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d``, left as is where a double has no such digits anyway."""
    factor = float(10**digits)
    scaled = c * F.lit(factor)
    rounded = F.floor(scaled + F.lit(0.5)).cast("double") / F.lit(factor)
    return F.when(F.abs(scaled) < F.lit(float(2**52)), rounded).otherwise(c)


def format_money(c: Column | str) -> Column:
    return F.format_string("$%.2f", number_or(c))


def format_volume(c: Column | str) -> Column:
    return F.format_string("%.4f", number_or(c))


def whole_part(c: Column | str) -> Column:
    """Integer part of ``c``; pairs with :func:`fraction_part`."""
    return F.floor(_col(c).cast("double"))


def fraction_part(c: Column | str) -> Column:
    """The eight decimals of ``c`` above its integer part, as an integer up to 10^8."""
    x = _col(c).cast("double")
    return F.floor((x - F.floor(x)) * F.lit(float(SUM_SCALE)) + F.lit(0.5))


def join_parts(whole: Column, fraction: Column) -> Column:
    """Double from summed integer and fraction parts, exact up to the last conversion."""
    fixed = whole.cast("decimal(28,0)") + fraction.cast("decimal(20,0)") * F.lit("0.00000001").cast("decimal(8,8)")
    return fixed.cast("double")
