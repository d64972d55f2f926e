"""Business marts over the golden tables.

Each mart reduces its largest input by key before it joins, so one customer,
order or product that fills a third of the rows is folded in the map tasks.
``money_scale`` makes money sums independent of row order, see ``money_sum``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.functions.values import money_sum, safe_divide
from vouchlake.operators.keys import same_key


def customer_clv(customers: DataFrame, orders: DataFrame, money_scale: int | None = None) -> DataFrame:
    """Order count, spend and lifetime of each curated customer with orders."""
    per_customer = (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            money_sum(F.col("order_total"), money_scale).alias("spend"),
            F.count("order_total").alias("priced"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    # A customer id may be stored more than once; the join repeats its orders.
    copies = customers.groupBy("customer_id").agg(F.count(F.lit(1)).alias("copies"))
    spend = (F.col("spend") * F.col("copies")).cast("double")
    joined = per_customer.join(copies, "customer_id").select(
        "customer_id",
        (F.col("orders") * F.col("copies")).alias("total_orders"),
        spend.alias("total_spend"),
        safe_divide(F.col("spend").cast("double"), F.col("priced")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        F.date_diff("last_order_date", "first_order_date").alias("customer_lifetime_days"),
        spend.alias("clv_amount"),
    )
    return schemas.conform(joined, "customer_clv")


def customer_segments(clv: DataFrame, high: float = 50000, medium: float = 20000) -> DataFrame:
    """HIGH above ``high``, MEDIUM from ``medium`` to ``high``, LOW otherwise."""
    amount = F.col("clv_amount")
    segment = (
        F.when(amount > high, schemas.HIGH_VALUE)
        .when(amount.between(medium, high), schemas.MEDIUM_VALUE)
        .otherwise(schemas.LOW_VALUE)
    )
    return clv.select("customer_id", "clv_amount", "total_orders", segment.alias("customer_segment"))


def monthly_sales(orders: DataFrame, money_scale: int | None = None) -> DataFrame:
    revenue = money_sum(F.col("order_total"), money_scale).cast("double")
    sales = orders.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month")).agg(
        F.count("order_id").alias("total_orders"),
        revenue.alias("total_revenue"),
        safe_divide(revenue, F.count("order_total")).alias("avg_order_value"),
    )
    return schemas.conform(sales, "monthly_sales")


def product_performance(items: DataFrame, money_scale: int | None = None) -> DataFrame:
    performance = items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        money_sum(F.col("quantity") * F.col("unit_price"), money_scale).alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    return schemas.conform(performance, "product_performance")


def returns_of_items(items: DataFrame, returns: DataFrame) -> DataFrame:
    """``(order_id, product_id, pairs)``: how often each order's returns meet each of its products.

    Returns per order times lines per order and product, so the pairs
    themselves are never made.
    """
    per_order = returns.groupBy(F.col("order_id").alias("__order")).agg(F.count("return_id").alias("returns"))
    lines = items.groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("lines"))
    return lines.join(per_order, same_key(F.col("order_id"), F.col("__order"))).select(
        "order_id", "product_id", (F.col("lines") * F.col("returns")).alias("pairs")
    )


def product_returns(returns: DataFrame, items: DataFrame) -> DataFrame:
    """Units sold, returns, and their ratio per product.

    A return belongs to an order, so it counts once for each item row of that
    order. Counting the returns per order first gives the same number without
    building the return-item pairs, and one pass over the items serves both
    totals.
    """
    per_order = returns.groupBy(F.col("order_id").alias("__order")).agg(F.count("return_id").alias("returns"))
    totals = (
        items.join(per_order, same_key(F.col("order_id"), F.col("__order")), "left")
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("total_sold"),
            F.coalesce(F.sum("returns"), F.lit(0)).alias("__returned"),
        )
    )
    # Items without a product are one group when sold but match no product.
    returned = F.when(F.col("product_id").isNull(), 0).otherwise(F.col("__returned"))
    return schemas.conform(
        totals.withColumn("total_returned", returned).withColumn(
            "return_rate", safe_divide(F.col("total_returned"), F.col("total_sold"))
        ),
        "product_returns",
    )
