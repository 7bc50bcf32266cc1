"""Row-level rules against plain Python decimals."""

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from fixtures import rows
from storetally.operators.segments import sales_by_segment
from storetally.functions.money import cents
from storetally.functions.keys import customer_key, is_hazmat, product_name, sku_key
from storetally.functions.lookups import month_seasonal, region_premium, region_seasonal
from storetally.operators.flatten import FLAT_COLUMNS, flatten
from storetally.operators.pricing import header_totals, price_lines
from storetally.operators.profile import dataset_info, dataset_profile
from storetally.operators.sequence import item_sequence

CENT = Decimal("0.01")


def half_up(value):
    return float(value.quantize(CENT, ROUND_HALF_UP))


def test_pricing_equals_python(spark):
    random.seed(5)
    lines = [
        (
            i // 5,
            i,
            random.randrange(500, 15_000) / 100,
            random.choice([1.15, 0.95, 1.0125, None]),
            random.choice([0.05, 0.123457, 0.25, None]),
            random.choice([*range(1, 40), -2, 5_000_000]),
        )
        for i in range(500)
    ]
    frame = spark.createDataFrame(
        lines,
        "transaction_id bigint, line bigint, base_price double, price_premium double, discount_pct double, quantity bigint",
    )
    totals = {}
    expected = {}
    for transaction, line, price, premium, discount, quantity in lines:
        listed = Decimal(str(price)) * Decimal(str(premium or 1))
        paid = listed * (1 - Decimal(str(discount or 0)))
        expected[line] = (
            half_up(paid),
            half_up(paid * quantity),
            float((listed - paid).quantize(CENT, ROUND_HALF_UP) * quantity),
        )
        totals[transaction] = totals.get(transaction, 0) + paid * quantity
    found = {
        row["line"]: (row["unit_price"], row["line_total"], row["discount_amount"]) for row in rows(price_lines(frame))
    }
    assert found == expected
    assert {
        row["transaction_id"]: (row["subtotal"], row["tax_amount"], row["total_amount"])
        for row in rows(header_totals(frame))
    } == {
        key: (half_up(exact), half_up(exact * Decimal("0.08")), half_up(exact * Decimal("1.08")))
        for key, exact in totals.items()
    }


def line_frame(spark, shares):
    random.seed(11)
    lines = []
    for key, count in shares.items():
        for i in range(count):
            # Repeated leading values, so pieces hold ties of the first column.
            lines.append((key, random.randrange(50), random.randrange(1000), i))
    random.shuffle(lines)
    return spark.createDataFrame(lines, "transaction_id bigint, line bigint, sku bigint, row bigint")


def numbers(frame, order):
    """Plain numbering; NULL sorts first."""
    by_key = {}
    for row in rows(frame):
        by_key.setdefault(row["transaction_id"], []).append(tuple((row[c] is not None, row[c] or 0) for c in order))
    return {
        (key, *line): number if key is not None else None
        for key, lines in by_key.items()
        for number, line in enumerate(sorted(lines), 1)
    }


def numbered(frame, order):
    result = item_sequence(frame, order)
    assert result.columns == [*frame.columns, "item_sequence"]
    return {
        (row["transaction_id"], *((row[c] is not None, row[c] or 0) for c in order)): row["item_sequence"]
        for row in rows(result)
    }


def test_sequence_of_heavy_and_usual_transactions(spark):
    frame = line_frame(spark, {1: 4000, 2: 3, 3: 1, 4: 900, None: 5}).withColumn("note", F.lit("x"))
    order = ["line", "sku", "row"]
    assert numbered(frame, order) == numbers(frame, order)


def test_sequence_with_missing_order_values(spark):
    lines = [(1, 1, 5, 0), (1, 1, None, 1), (1, 2, 3, 2), (1, None, 9, 3), (1, 2, None, 4), (1, 2, 1, 5), (None, 1, 1, 6)]
    frame = spark.createDataFrame(lines, "transaction_id bigint, line bigint, sku bigint, row bigint")
    assert numbered(frame, ["line", "sku", "row"]) == numbers(frame, ["line", "sku", "row"])


def test_sequence_of_one_transaction_and_an_outlier(spark):
    frame = spark.range(20_000).select(
        F.when(F.col("id") < 3, F.col("id")).otherwise(F.lit(7)).alias("transaction_id"),
        F.when(F.col("id") == 19_999, F.lit(10**15)).otherwise(F.col("id") % 50).alias("line"),
        F.col("id").alias("row"),
    )
    result = item_sequence(frame, ["line", "row"])
    assert numbered(frame, ["line", "row"]) == numbers(frame, ["line", "row"])
    # The heavy transaction is spread over slices.
    assert result.where("transaction_id = 7").count() == 19_997


def test_lookups(spark):
    frame = spark.createDataFrame([("West", 6), ("Atlantis", 13), (None, None)], "region string, month int")
    found = frame.select(
        region_premium(F.col("region")).cast("double"),
        region_seasonal(F.col("region")).cast("double"),
        month_seasonal(F.col("month")).cast("double"),
    ).collect()
    assert [tuple(row) for row in found] == [(1.25, 0.7, 1.8), (None, None, 1.0), (None, None, 1.0)]


def test_keys_and_names(spark):
    frame = spark.createDataFrame(
        [("Professional Contractor", 7), ("Property Manager", 1234567890)], "segment string, number bigint"
    )
    assert [row[0] for row in frame.select(customer_key(F.col("segment"), F.col("number"))).collect()] == [
        "PRO_00000007",
        "PRO_1234567890",
    ]
    assert frame.select(sku_key(F.col("number"))).first()[0] == "P7"
    missing = spark.createDataFrame([(None, 1), ("Commercial", None)], "segment string, number bigint")
    assert [row[0] for row in missing.select(customer_key(F.col("segment"), F.col("number"))).collect()] == [None, None]
    parts = spark.createDataFrame(
        [("Premium", "Primers", "", "Flat", "Quart")], "b string, c string, d string, e string, f string"
    )
    name, hazmat = parts.select(product_name(*[F.col(c) for c in "bcdef"]), is_hazmat(F.col("c"))).first()
    assert name == "Premium Primers  Flat Quart" and hazmat is True


def test_flatten_keeps_lines_of_unknown_products_and_stores(spark):
    items = spark.createDataFrame(
        [(1, "P1", 2, 1.5, 3.0), (1, "P9", 1, 2.0, 2.0), (2, "P1", 1, 1.5, 1.5), (3, "P1", 1, 1.5, 1.5)],
        "transaction_id bigint, sku string, quantity bigint, unit_price double, line_total double",
    )
    header = spark.sql(
        """SELECT * FROM VALUES
            (1L, 10L, 'C1', 'S', timestamp_ntz'2024-01-01'),
            (2L, 77L, 'C2', 'S', timestamp_ntz'2024-01-02')
        AS t(transaction_id, store_id, customer_id, customer_segment, timestamp)"""
    )
    products = spark.createDataFrame([("P1", "Primers")], "sku string, category string")
    stores = spark.createDataFrame([(10, "West", "CA")], "store_id bigint, region string, state string")
    flat = flatten(items, header, products, stores).select(*FLAT_COLUMNS)
    found = sorted(
        (row["customer_id"] or "none", row["product_category"] or "", row["state"] or "", row["transaction_total"])
        for row in rows(flat)
    )
    assert found == [("C1", "", "CA", 2.0), ("C1", "Primers", "CA", 3.0), ("C2", "Primers", "", 1.5), ("none", "Primers", "", 1.5)]


def test_profile(spark):
    transactions = spark.range(2_500_000).select(F.expr("date'2024-01-01' + cast(id % 10 as int)").alias("date"))
    profile = dataset_profile(transactions, spark.range(3), spark.range(0))
    assert [row["row_count"] for row in rows(profile)] == [2_500_000, 3, 0]
    assert rows(dataset_info(profile)) == [
        {
            "total_transactions": 2_500_000,
            "total_stores": 3,
            "total_products": 0,
            "date_range": "2024-01-01 to 2024-01-10",
            "estimated_size_gb": 0.25,
            "chunks_generated": 2,
        }
    ]


def test_money_keeps_every_digit(spark):
    exact = spark.sql("SELECT CAST(1.005 AS DECIMAL(5,3)) AS a, CAST('900719925474099.93' AS DECIMAL(17,2)) AS b, 0.004D AS c, 1.1D AS d")
    a, b, d = exact.select(cents(exact, "a"), cents(exact, "b"), cents(exact, "d")).first()
    assert (a, b, d) == (Decimal("100.5"), Decimal("90071992547409993"), 110)
    with pytest.raises(Exception, match="more than two decimals"):
        exact.select(cents(exact, "c")).collect()
    many = spark.range(1000).select(F.lit("S").alias("customer_segment"), F.lit(1).alias("customer_id"), F.lit(Decimal("0.004")).alias("total_amount"))
    assert sales_by_segment(many).first()["total_revenue"] == 4.0


def test_pricing_by_declared_types(spark):
    """Whole numbers and DECIMALs give the same prices; unknown products have none."""
    lines = spark.createDataFrame(
        [(1, 19.99, 1.15, 0.05, 3), (1, 0.05, None, 0.1, 7), (2, None, 1.25, 0.0, 1)],
        "transaction_id bigint, base_price double, price_premium double, discount_pct double, quantity bigint",
    )
    declared = lines.withColumns(
        {"base_price": F.col("base_price").cast("decimal(12,2)"), "price_premium": F.col("price_premium").cast("decimal(5,4)"), "discount_pct": F.col("discount_pct").cast("decimal(9,6)")}
    )
    names = ["unit_price", "line_total", "discount_amount"]
    assert price_lines(lines).select(*names).collect() == price_lines(declared).select(*names).collect()
    assert sorted(header_totals(lines).collect()) == sorted(header_totals(declared).collect())
    assert price_lines(lines).where("transaction_id = 2").select(*names).first() == (None, None, None)


def test_pricing_keeps_every_digit(spark):
    """Prices and premiums of six decimals, discounts of 18, against Python decimals."""
    rng = random.Random(11)
    lines = [
        (
            i // 3,
            i,
            Decimal(rng.randrange(1, 10**rng.choice([6, 9, 12]))).scaleb(-6),
            rng.choice([Decimal("1.15"), Decimal("0.333333"), Decimal("12.000001"), None]),
            rng.choice([Decimal(rng.randrange(10**18)).scaleb(-18), Decimal("0.5"), Decimal(1), None]),
            rng.choice([1, 2, 7, -3, 99_999]),
        )
        for i in range(400)
    ]
    # Exactly half a cent, and one digit below it.
    lines += [(900, 900, Decimal("0.000005"), Decimal(1), None, 1000), (901, 901, Decimal("0.01"), None, Decimal("0.500000000000000001"), 1)]
    schema = "transaction_id bigint, line bigint, base_price decimal(16,6), price_premium decimal(8,6), discount_pct decimal(19,18), quantity bigint"
    frame = spark.createDataFrame(lines, schema)
    expected, totals = {}, {}
    with localcontext() as context:
        context.prec = 80
        for transaction, line, price, premium, discount, quantity in lines:
            listed = price * (premium if premium is not None else 1)
            saved = listed * (discount if discount is not None else 0)
            paid = listed - saved
            expected[line] = (half_up(paid), half_up(paid * quantity), float(saved.quantize(CENT, ROUND_HALF_UP) * quantity))
            totals[transaction] = totals.get(transaction, 0) + paid * quantity
        headers = {t: (half_up(x), half_up(x * Decimal("0.08")), half_up(x * Decimal("1.08"))) for t, x in totals.items()}
    found = {row["line"]: (row["unit_price"], row["line_total"], row["discount_amount"]) for row in rows(price_lines(frame))}
    assert found == expected
    found = {row["transaction_id"]: (row["subtotal"], row["tax_amount"], row["total_amount"]) for row in rows(header_totals(frame))}
    assert found == headers


@pytest.mark.parametrize("price, premium", [(1.1234567, 1.0), (1.5, 1.1234567)])
def test_pricing_refuses_to_cut(spark, price, premium):
    frame = spark.createDataFrame([(1, price, premium, 0.1, 2)], "transaction_id int, base_price double, price_premium double, discount_pct double, quantity int")
    with pytest.raises(Exception, match="more decimals"):
        price_lines(frame).collect()
