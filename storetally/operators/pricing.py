"""Line pricing and header totals, exact and rounded half up.

Inputs: `base_price`, `price_premium` (NULL counts as 1), `discount_pct` (0.1 =
10 %, NULL as 0), and `quantity`. A NULL price gives NULL results.

The declared types choose the arithmetic. DECIMALs of at most two (price), four
(premium) and six (discount) decimals are multiplied as whole numbers of 1e-10
cents in a BIGINT, fifteen times faster than wide DECIMALs; a unit price may reach
9.2 million there, beyond that ANSI mode raises. Anything else, such as DOUBLEs, counts with
the decimals it is written with: up to six of price and premium, more raise an error; a
discount to 18 decimals. The product has more digits than a DECIMAL holds, so it is
kept as whole cents and a rest in units of 1e-28 cents. No digit is cut.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from storetally.functions.lookups import SALES_TAX
from storetally.functions.money import amount

PER_CENT = 10_000 * 1_000_000

LIST_PRICE = "bigint(base_price * 100) * bigint(coalesce(price_premium, 1) * 10000)"
DISCOUNT = "bigint(coalesce(discount_pct, 0) * 1000000)"
# Most decimals of the whole-number form.
DIGITS = {"base_price": 2, "price_premium": 4, "discount_pct": 6}


def _fits_whole_numbers(lines: DataFrame) -> bool:
    kinds = {name: lines.schema[name].dataType for name in DIGITS}
    return all(isinstance(kind, DecimalType) and kind.scale <= DIGITS[name] for name, kind in kinds.items())


# Units of the rest in a cent.
FINE = f"{10**28}BD"


def _written(column: str, kind: str) -> str:
    """A column as DECIMAL; an error if that would cut decimals."""
    exact = f"CAST({column} AS DECIMAL(38,20))"
    text = f"concat('{column} has more decimals than {kind}: ', CAST({column} AS STRING))"
    return f"IF({column} IS NULL OR {exact} = CAST({exact} AS {kind}), CAST({exact} AS {kind}), raise_error({text}))"


def _times(share: str) -> tuple[str, str]:
    """`_listed` (1e-12 units of money) times a share of 18 decimals: whole cents, and the rest."""
    # Nine decimals at a time, so that no product has more than 38 digits.
    scaled = f"({share} * 1000000000BD)"
    high, low = f"CAST({scaled} div 1BD AS DECIMAL(10,0))", f"CAST({scaled} % 1BD * 1000000000BD AS DECIMAL(10,0))"
    upper = f"CAST(_listed * {high} AS DECIMAL(38,0))"
    rest = f"CAST({upper} % {10**19}BD * 1000000000BD + _listed * {low} AS DECIMAL(38,0))"
    return f"{upper} div {10**19}BD + {rest} div {FINE}", f"CAST({rest} % {FINE} AS DECIMAL(28,0))"


def _half_up(whole: str, rest: str, unit: str = FINE) -> str:
    """Cents rounded half up, away from zero."""
    return f"{whole} + CASE WHEN 2BD * {rest} >= {unit} THEN 1 WHEN -2BD * {rest} >= {unit} THEN -1 ELSE 0 END"


def _with_decimals(lines: DataFrame) -> DataFrame:
    """Adds `_paid` and `_saved` per unit and `_line`, each as whole cents and `_rest`."""
    price, premium = _written("base_price", "DECIMAL(16,6)"), _written("price_premium", "DECIMAL(8,6)")
    whole_price, whole_premium = (f"CAST({one} * 1000000BD AS DECIMAL({n},0))" for one, n in ((price, 16), (f"coalesce({premium}, 1BD)", 9)))
    rows = lines.selectExpr(
        "*",
        f"CAST({whole_price} * {whole_premium} AS DECIMAL(24,0)) AS _listed",
        f"coalesce(CAST(discount_pct AS DECIMAL(19,18)), CAST(0 AS DECIMAL(19,18))) AS _off",
    ).selectExpr("*", "CAST(1BD - _off AS DECIMAL(20,18)) AS _kept")
    (paid, paid_rest), (saved, saved_rest) = _times("_kept"), _times("_off")
    per_unit = rows.selectExpr(
        "*", f"{paid} AS _paid", f"{paid_rest} AS _paid_rest", f"{saved} AS _saved", f"{saved_rest} AS _saved_rest"
    ).selectExpr("*", "CAST(_paid_rest * CAST(quantity AS DECIMAL(9,0)) AS DECIMAL(38,0)) AS _many_rests")
    return per_unit.selectExpr(
        "*", f"_paid * bigint(quantity) + _many_rests div {FINE} AS _line", f"CAST(_many_rests % {FINE} AS DECIMAL(28,0)) AS _line_rest"
    )


def whole_cents(units: str) -> Column:
    """Column of 1e-10 cents rounded half up to cents."""
    half = PER_CENT // 2
    return F.expr(f"({units} + if({units} < 0, -{half}L, {half}L)) div {PER_CENT}")


def _with_units(lines: DataFrame) -> DataFrame:
    """Adds `paid` and `saved` per unit; the line total as `whole` cents plus `rest`."""
    return (
        lines.withColumn("paid", F.expr(f"{LIST_PRICE} * (1000000 - {DISCOUNT})"))
        .withColumn("saved", F.expr(f"{LIST_PRICE} * {DISCOUNT}"))
        # The cents and the rest are multiplied apart, so that a line total is
        # not bound to the range of a unit price.
        .withColumn("rest", F.expr(f"(paid % {PER_CENT}) * bigint(quantity)"))
        .withColumn("whole", F.expr(f"(paid div {PER_CENT}) * bigint(quantity) + rest div {PER_CENT}"))
        .withColumn("rest", F.expr(f"rest % {PER_CENT}"))
    )


def price_lines(lines: DataFrame) -> DataFrame:
    """Adds `unit_price`, `line_total` and `discount_amount`.

    `line_total` rounds the unrounded price times quantity once;
    `discount_amount` rounds per unit and multiplies then.
    """
    if not _fits_whole_numbers(lines):
        return _with_decimals(lines).select(
            *lines.columns,
            amount(F.expr(_half_up("_paid", "_paid_rest"))).alias("unit_price"),
            amount(F.expr(_half_up("_line", "_line_rest"))).alias("line_total"),
            amount(F.expr(f"({_half_up('_saved', '_saved_rest')}) * bigint(quantity)")).alias("discount_amount"),
        )
    return _with_units(lines).select(
        *lines.columns,
        amount(whole_cents("paid")).alias("unit_price"),
        amount(F.col("whole") + whole_cents("rest")).alias("line_total"),
        amount(whole_cents("saved") * F.col("quantity").cast("bigint")).alias("discount_amount"),
    )


def header_totals(lines: DataFrame, key: str = "transaction_id", tax: Decimal = SALES_TAX) -> DataFrame:
    """Subtotal, tax and total per transaction, each rounded once from the exact sum."""
    if not _fits_whole_numbers(lines):
        totals = (
            _with_decimals(lines)
            .groupBy(key)
            .agg(F.sum(F.col("_line").cast("decimal(20,0)")).alias("line"), F.sum("_line_rest").alias("line_rest"))
            .selectExpr(
                key,
                f"CAST(line + line_rest div {FINE} AS DECIMAL(20,0)) AS line",
                f"CAST(line_rest % {FINE} AS DECIMAL(28,0)) AS line_rest",
            )
        )

        def share(of: Decimal) -> Column:
            """The sum times a number of at most four decimals, rounded half up."""
            times, parts = int(of * 10_000), 10_000
            unit = f"{parts * 10**28}BD"
            many, rest = f"line * {times}BD", f"(line * {times}BD % {parts}BD * {FINE} + line_rest * {times}BD)"
            whole = f"{many} div {parts}BD + {rest} div {unit}"
            return amount(F.expr(_half_up(whole, f"({rest} % {unit})", unit)))

        return totals.select(
            key, share(Decimal(1)).alias("subtotal"), share(tax).alias("tax_amount"), share(1 + tax).alias("total_amount")
        )
    rest = F.sum("rest").cast("decimal(20,0)") * F.lit(Decimal(1) / PER_CENT).cast("decimal(10,10)")
    exact = F.col("cents")
    return (
        _with_units(lines)
        .groupBy(key)
        .agg((F.sum("whole").cast("decimal(20,0)") + rest).alias("cents"))
        .select(
            key,
            amount(F.round(exact, 0)).alias("subtotal"),
            amount(F.round(exact * F.lit(tax), 0)).alias("tax_amount"),
            amount(F.round(exact * F.lit(1 + tax), 0)).alias("total_amount"),
        )
    )
