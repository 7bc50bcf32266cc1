"""Exact, order-independent sums of amounts of any type.

A sum of DOUBLEs depends on the order of its rows. Here an amount is summed in whole
numbers only, so that every partitioning gives the same last digit:

- DECIMAL and whole-number columns as `cents` (BIGINT, or DECIMAL with more digits).
- A DOUBLE that is the one nearest to a whole number of cents counts as these cents.
- Any other DOUBLE counts as the binary number that it is, in multiples of 2**-78 (3e-24): a whole
  part and three signed digits of 26 bits below the point, each summed as BIGINT.
  NaN, infinite and larger amounts than a BIGINT raise an error.

The total of the cents and the total of the rest are exact; each is rounded to a
DOUBLE once, and the two are added. All these columns are linear, so totals of totals
(`tally`) and differences of totals are as exact. Whole cents leave the other columns NULL,
which costs little: the generated code stays small, or the JVM would not compile it.

The second moment is exact for whole cents. Other amounts take part in it as multiples
of 1e-9.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from storetally.functions.money import LARGEST, cents

DIGITS, BITS = 3, 26
# Squares of smaller amounts in cents fit a BIGINT; they are summed in three pieces.
SMALL = 3_037_000_499
PIECES, PIECE = 3, 21
# Multiples in which amounts other than whole cents enter the second moment.
FINE = 1_000_000_000

# Expressions are SQL text: each step of a Column built in Python is a call to the JVM.
Get = Callable[[str], str]


def _carried(whole: str, digits: Sequence[str]) -> list[str]:
    """The same value with every digit from 0 to 2**BITS - 1, the whole part below it."""
    found, carry = [], ""
    for digit in reversed(digits):
        value = f"({digit}{carry})"
        found.append(f"({value} & {(1 << BITS) - 1}L)")
        carry = f" + shiftright({value}, {BITS})"
    return [f"({whole}{carry})", *reversed(found)]


def _joined(numbers: Sequence[str], below: str = "") -> str:
    """A whole number and digits below it, rounded once; what lies below them only tips the balance."""
    total = f"CAST({numbers[0]} AS DECIMAL(38,0))"
    for digit in numbers[1:]:
        total = f"({total} * {1 << BITS}BD + CAST({digit} AS DECIMAL(19,0)))"
    if below:
        total = f"({total} + IF({below} > 0 AND {total} % 2BD = 0BD, 1BD, 0BD))"
    return f"CAST({total} AS DOUBLE) * {2.0 ** -(BITS * (len(numbers) - 1))!r}D"


def _positive(whole: str, digits: Sequence[str]) -> str:
    # DECIMAL(38) has room for 126 bits.
    large, small = _joined([whole, *digits[:-1]], digits[-1]), _joined([whole, *digits])
    return f"IF({whole} >= {1 << 20}L, {large}, {small})"


def nearest(whole: str, digits: Sequence[str]) -> str:
    """The DOUBLE nearest to whole + digits[0] / 2**26 + digits[1] / 2**52 ...; the digits may have any size and sign."""
    own, *rest = _carried(whole, digits)
    negated, *others = _carried(f"-{whole}", [f"-{digit}" for digit in digits])
    return f"IF({own} < 0, -({_positive(negated, others)}), {_positive(own, rest)})"


@dataclass(frozen=True)
class Sums:
    """The columns that an amount is summed in; `tallied` if the rows are totals of sales, not sales."""

    name: str
    binary: bool
    moments: bool
    tallied: bool = False

    @property
    def parts(self) -> list[str]:
        return [f"{self.name}_{part}" for part in ("whole", *range(1, DIGITS + 1))] if self.binary else []

    @property
    def names(self) -> list[str]:
        found = [self.name, *self.parts]
        if self.moments:
            found += [f"{self.name}_square_{i}" for i in range(PIECES)]
            found += [f"{self.name}_fine", f"{self.name}_fine_square"]
        return found

    def totals(self) -> list[Column]:
        """Aggregates: `row_count` sales, `priced` sales with an amount, and the sums."""
        counts = (
            [F.sum("row_count").alias("row_count"), F.sum("priced").alias("priced")]
            if self.tallied
            else [F.count("*").alias("row_count"), F.count(self.name).alias("priced")]
        )
        return [*counts, *self.sums()]

    def sums(self) -> list[Column]:
        return [F.sum(name).alias(name) for name in self.names]

    def total(self, get: Get = str) -> Column:
        """The sum as DOUBLE; `get` gives the expression of a summed column by its name."""
        plain = f"CAST({get(self.name)} AS DOUBLE) / 100D"
        if not self.binary:
            return F.expr(plain)
        whole, *digits = [f"coalesce({get(name)}, 0L)" for name in self.parts]
        none = " AND ".join(f"{part} = 0" for part in (whole, *digits))
        return F.expr(f"IF({none}, {plain}, {plain} + {nearest(whole, digits)})")

    def less(self, other: str) -> Column:
        """The total less the one in the struct column `other`; NULL if that is."""

        def get(name: str) -> str:
            if name == self.name:
                return f"({name} - {other}.{name})"
            return f"(coalesce({name}, 0L) - coalesce({other}.{name}, 0L))"

        return self.total(get)

    def average(self, total: str = "total_revenue") -> Column:
        """Mean over the sales that have an amount; `total` is the column of the total beside it."""
        return F.try_divide(F.col(total), F.col("priced").cast("double"))

    def deviation(self) -> Column:
        """Sample standard deviation, NULL below two amounts.

        With n amounts of sum s1 and sum of squares s2, both whole, and m = s1 div n:
        sqrt((s2 - 2 m s1 + n m^2 - (s1 - n m)^2 / n) / (n - 1)). Only the last term and what follows is rounded.
        """


        def root(first: str, second: str, unit: int) -> str:
            n = "CAST(priced AS DECIMAL(19,0))"
            mean = f"CAST({first} div {n} AS DECIMAL(19,0))"
            whole = f"CAST({second} - 2BD * {mean} * {first} + {n} * {mean} * {mean} AS DOUBLE)"
            rest = f"CAST({first} - {n} * {mean} AS DOUBLE)"
            spread = f"({whole} - {rest} * {rest} / CAST(priced AS DOUBLE))"
            return f"sqrt({spread} / CAST(priced - 1 AS DOUBLE)) / {unit}D"

        def number(name: str) -> str:
            return f"coalesce(CAST({name} AS DECIMAL(38,0)), 0BD)"

        pieces = [f"{number(f'{self.name}_square_{i}')} * {1 << (PIECE * i)}BD" for i in range(PIECES)]
        square, fine, unit = f"({' + '.join(pieces)})", f"{self.name}_fine", FINE // 100
        in_cents = f"CAST({self.name} AS DECIMAL(38,0))"
        # DECIMAL amounts are in `fine` as a whole, DOUBLE ones without whole cents.
        first = f"({number(fine)} + {in_cents} * {unit}BD)" if self.binary else number(fine)
        second = f"({number(f'{fine}_square')} + {square} * {unit**2}BD)"
        found = f"IF({fine}_square IS NULL, {root(in_cents, square, 100)}, {root(first, second, FINE)})"
        return F.expr(f"IF(priced > 1, {found}, NULL)")


def _second_moments(name: str, whole_cents: str, rest: str) -> list[str]:
    """Columns for squares: of amounts in cents, and of others in multiples of 1e-9."""
    small = f"abs({whole_cents}) <= {SMALL}L"
    found = [
        f"IF({small}, shiftright({whole_cents} * {whole_cents}, {PIECE * i}) & {(1 << PIECE) - 1}L, NULL) AS {name}_square_{i}"
        for i in range(PIECES)
    ]
    fine = f"CAST({rest} AS DECIMAL(19,0))"
    large = f"IF({small}, NULL, CAST({whole_cents} * CAST({FINE // 100} AS DECIMAL(19,0)) AS DECIMAL(19,0)))"
    return [*found, f"{fine} AS {name}_fine", f"coalesce({fine}, {large}) * coalesce({fine}, {large}) AS {name}_fine_square"]


def summed(
    sales: DataFrame, column: str | Sums, keep: Sequence[str | Column] = (), name: str = "cents", moments: bool = False
) -> tuple[DataFrame, Sums]:
    """`keep` and the columns to sum an amount in, and how; `column` is a `Sums` where `sales` are tallied."""
    if isinstance(column, Sums):
        return sales.select(*keep, "row_count", "priced", *column.names), column
    if isinstance(sales.schema[column].dataType, (DoubleType, FloatType)):
        sums = Sums(name, True, moments)
        x = f"CAST(`{column}` AS DOUBLE)"
        is_cents = f"rint({x} * 100D) / 100D = {x} AND abs({x}) < {LARGEST!r}D"
        split = sales.select(
            *keep,
            F.expr(f"CASE WHEN {is_cents} THEN CAST(rint({x} * 100D) AS BIGINT) WHEN {x} IS NOT NULL THEN 0L END").alias(name),
            F.expr(f"IF({is_cents}, NULL, {x})").alias(f"{name}_rest"),
        )
        kept, rest = split.columns[:-2], f"{name}_rest"
        scaled = [f"rint({rest} * {2.0 ** (BITS * i)!r}D)" for i in range(DIGITS + 1)]
        columns = [name, f"CAST({scaled[0]} AS BIGINT) AS {name}_whole"]
        for i in range(1, DIGITS + 1):
            columns.append(f"floor({scaled[i]} - {scaled[i - 1]} * {2.0**BITS!r}D) AS {name}_{i}")
        if moments:
            columns += _second_moments(name, f"IF({rest} IS NULL, {name}, NULL)", f"CAST(rint({rest} * {FINE}D) AS BIGINT)")
        return split.selectExpr(*[f"`{one}`" for one in kept], *columns), sums
    sums = Sums(name, False, moments)
    split = sales.select(*keep, cents(sales, column).alias(name))
    if not moments:
        return split, sums
    is_long = split.schema[name].dataType.simpleString() == "bigint"
    none = "CAST(NULL AS BIGINT)"
    return split.selectExpr("*", *_second_moments(name, name if is_long else none, none if is_long else f"round({name} * {FINE // 100}BD)")), sums


def tally(sales: DataFrame, keys: Sequence[str], column: str, moments: bool = False) -> tuple[DataFrame, Sums]:
    """One row for each combination of `keys` with its totals, for analyses that need no other columns."""
    rows, sums = summed(sales, column, keys, moments=moments)
    return rows.groupBy(*keys).agg(*sums.totals()), replace(sums, tallied=True)
