"""Money as whole cents.

Sums of DOUBLE depend on the order of the rows, and a cast to DECIMAL goes
through text for every row (five times the cost of the sum itself). A column of
two decimals becomes BIGINT cents: exact, order-independent and inside generated
code. A BIGINT sum reaches 9.2e16 currency units per group. A DECIMAL column with
more digits stays DECIMAL, so nothing of it is lost; a DOUBLE with more than two
decimals is refused, as it has no exact sum.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

# A DECIMAL of so many digits or fewer, two of them decimals, fits BIGINT cents.
BIGINT_DIGITS = 16
# DOUBLE amounts from here on have no cents any more (2^53 of them).
LARGEST = 9e13


def cents(frame: DataFrame, amount: str) -> Column:
    """Amount in cents: BIGINT, or DECIMAL for a DECIMAL column with more digits.

    The declared type decides. A DOUBLE that is not a whole number of cents
    (beyond the rounding of its own last digit) raises an error.
    """
    kind, column = frame.schema[amount].dataType, F.col(amount)
    if isinstance(kind, DecimalType):
        exact = column * F.lit(Decimal(100))
        return exact.cast("bigint") if kind.scale <= 2 and kind.precision <= BIGINT_DIGITS else exact
    if not isinstance(kind, (DoubleType, FloatType)):
        return column.cast("bigint") * 100
    whole = F.rint(column * 100)
    near = F.abs(column * 100 - whole) <= F.lit(1e-6) + F.abs(column) * 1e-12
    message = F.concat(F.lit(f"{amount} has more than two decimals, give it as DECIMAL: "), column.cast("string"))
    return F.when(column.isNull() | (near & (F.abs(column) < LARGEST)), whole.cast("bigint")).otherwise(
        F.raise_error(message).cast("bigint")
    )


def amount(cents_column: str | Column) -> Column:
    """Cents -> DOUBLE amount."""
    column = F.col(cents_column) if isinstance(cents_column, str) else cents_column
    return column.cast("double") / F.lit(100.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """DOUBLE quotient, NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, count: Column) -> Column:
    """DOUBLE quotient, 0 for a zero count."""
    return F.when(count == 0, F.lit(0.0)).otherwise(ratio(numerator, count))
