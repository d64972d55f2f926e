"""Business marts kept up to date from the change feeds of the golden tables.

A change feed gives rows with a sign: what an update or delete takes out, what
an update or insert brings. Counts and exact sums follow by signed addition.
Three things do not, and each reads only the keys that changed:

* the first and last date of a customer: only where the retracted date was the
  first or last one are the customer's orders looked at again;
* the number of distinct orders of a product: the lines per order and product
  are kept, and the number changes where such a count leaves or reaches zero;
* returns per product, which are lines times returns of the same order: the
  change of a product is the change of its lines times the returns so far,
  plus its lines now times the change of the returns.

Money is added as decimals of two places, as in ``money_sum`` with a scale:
sums of doubles cannot be taken back exactly. Each state row counts the rows
behind it in ``n`` and goes when that reaches zero. Keys are text with a mark
in front, so that a NULL product or order is a key like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.functions.values import safe_divide
from vouchlake.operators.keys import same_key

SCALE = 2
_MONEY = "decimal(38,2)"

# Columns of each state beside its key; all but the named ones are added up.
STATES = {
    "monthly_state": f"month_key string, n long, orders long, revenue {_MONEY}, priced long",
    "customer_state": f"customer_id string, n long, orders long, spend {_MONEY}, priced long, first_order_date date, last_order_date date",
    "customer_copies": "customer_id string, n long",
    "order_lines": "order_key string, order_id string, product_key string, product_id string, n long",
    "order_returns": "order_key string, n long, returns long",
    "product_state": f"product_key string, product_id string, n long, quantity long, counted long, revenue {_MONEY}, priced long, orders long, returned long",
}


def state_key(table: str) -> str:
    return STATES[table].split()[0]


def marked_key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def signed(feed: DataFrame) -> DataFrame:
    """The rows of a change feed with ``sign``: 1 for what came, -1 for what went."""
    sign = F.when(F.col("image").isin("insert", "after"), 1).otherwise(-1).cast("long")
    return feed.withColumn("sign", sign).drop("image", "version")


def _count(*columns: str) -> Column:
    """Signed count of the rows in which all columns have a value."""
    there = F.lit(True)
    for c in columns:
        there = there & F.col(c).isNotNull()
    return F.sum(F.when(there, F.col("sign")).otherwise(0))


def _money(amount: Column) -> Column:
    return F.coalesce(F.sum(amount.cast(f"decimal(18,{SCALE})") * F.col("sign")), F.lit(0)).cast(_MONEY)


# -- what a feed adds ----------------------------------------------------------


def monthly_delta(orders: DataFrame) -> DataFrame:
    month = F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit(""))
    return signed(orders).groupBy(month.alias("month_key")).agg(
        F.sum("sign").alias("n"), _count("order_id").alias("orders"), _money(F.col("order_total")).alias("revenue"), _count("order_total").alias("priced")
    )


def customer_delta(orders: DataFrame) -> DataFrame:
    """Sums per customer, and the ends of the dates that came and of those that left."""
    came, left = (F.when(F.col("sign") == s, F.col("order_date")) for s in (1, -1))
    rows = signed(orders).where(F.col("customer_id").isNotNull())
    return rows.groupBy("customer_id").agg(
        F.sum("sign").alias("n"),
        _count("order_id").alias("orders"),
        _money(F.col("order_total")).alias("spend"),
        _count("order_total").alias("priced"),
        F.min(came).alias("came_first"),
        F.max(came).alias("came_last"),
        F.min(left).alias("left_first"),
        F.max(left).alias("left_last"),
    )


def copies_delta(customers: DataFrame) -> DataFrame:
    return signed(customers).where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.sum("sign").alias("n"))


def lines_delta(items: DataFrame) -> DataFrame:
    keyed = signed(items).select(marked_key("order_id").alias("order_key"), "order_id", marked_key("product_id").alias("product_key"), "product_id", "sign")
    return keyed.groupBy("order_key", "order_id", "product_key", "product_id").agg(F.sum("sign").alias("n")).where("n <> 0")


def returns_delta(returns: DataFrame) -> DataFrame:
    keyed = signed(returns).where(F.col("order_id").isNotNull()).select(marked_key("order_id").alias("order_key"), "return_id", "sign")
    return keyed.groupBy("order_key").agg(F.sum("sign").alias("n"), _count("return_id").alias("returns"))


def _product_rows(rows: DataFrame) -> DataFrame:
    """Every state column of a product, zero where ``rows`` does not bring it."""
    names = STATES["product_state"].split(", ")
    return rows.select([F.col(c.split()[0]) if c.split()[0] in rows.columns else F.lit(0).cast(c.split()[1]).alias(c.split()[0]) for c in names])


def _summed(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in rows.columns if c not in ("product_key", "product_id")]
    return rows.groupBy("product_key", "product_id").agg(*sums)


def product_delta_of_items(items: DataFrame, changed: DataFrame, lines: DataFrame, returns: DataFrame) -> DataFrame:
    """What changed items add to their products, given the states of lines and returns before them.

    ``changed`` is the items' ``lines_delta``; ``lines`` and ``returns`` need its orders only.
    """
    plain = signed(items).withColumn("product_key", marked_key("product_id")).groupBy("product_key", "product_id").agg(
        F.sum("sign").alias("n"),
        F.coalesce(F.sum(F.col("quantity") * F.col("sign")), F.lit(0)).alias("quantity"),
        _count("quantity").alias("counted"),
        _money(F.col("quantity") * F.col("unit_price")).alias("revenue"),
        _count("quantity", "unit_price").alias("priced"),
    )
    met = changed.alias("d").join(lines.alias("l"), same_key(F.col("d.order_key"), F.col("l.order_key")) & (F.col("d.product_key") == F.col("l.product_key")), "left")
    met = met.join(returns.alias("r"), same_key(F.col("d.order_key"), F.col("r.order_key"), F.crc32), "left")
    before = F.coalesce("l.n", F.lit(0))
    distinct = ((before + F.col("d.n")) > 0).cast("long") - (before > 0).cast("long")
    by_order = met.where("d.order_id IS NOT NULL").select(
        "d.product_key", "d.product_id", distinct.alias("orders"), (F.col("d.n") * F.coalesce("r.returns", F.lit(0))).alias("returned")
    )
    return _summed(_product_rows(plain).unionByName(_product_rows(_summed(by_order))))


def product_delta_of_returns(returns: DataFrame, lines: DataFrame) -> DataFrame:
    """What changed returns add to the products of their orders, given the lines after the items."""
    changed = returns_delta(returns).alias("d")
    met = changed.join(lines.alias("l"), same_key(F.col("d.order_key"), F.col("l.order_key")))
    return _product_rows(_summed(met.select("l.product_key", "l.product_id", (F.col("d.returns") * F.col("l.n")).alias("returned"))))


# -- states and their row images -----------------------------------------------


def added_images(held: DataFrame, delta: DataFrame, keys: list[str], kept: tuple[str, ...] = ()) -> DataFrame:
    """Row images of a state after signed addition; ``kept`` columns are the key's own."""
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"h.{k}") == F.col(f"d.{k}"))
    both = held.alias("h").join(delta.alias("d"), same, "full_outer")

    def after(c: str) -> Column:
        if c in keys or c in kept:
            return F.coalesce(f"h.{c}", f"d.{c}").alias(c)
        total = F.coalesce(f"h.{c}", F.lit(0)) + F.coalesce(f"d.{c}", F.lit(0))
        return total.cast(held.schema[c].dataType).alias(c)

    n = F.coalesce("h.n", F.lit(0)) + F.coalesce("d.n", F.lit(0))
    before = F.when(F.col(f"h.{keys[0]}").isNotNull(), F.struct([F.col(f"h.{c}").alias(c) for c in held.columns]))
    images = both.select(before.alias("before"), F.when(n != 0, F.struct([after(c) for c in held.columns])).alias("after"))
    return images.where("before IS NOT NULL OR after IS NOT NULL")


def stale_customers(held: DataFrame, delta: DataFrame) -> DataFrame:
    """Ids of the customers who lost an order of their first or last date."""
    met = held.alias("h").join(delta.alias("d"), "customer_id")
    return met.where("d.left_first <= h.first_order_date OR d.left_last >= h.last_order_date").select("customer_id")


def customer_images(held: DataFrame, delta: DataFrame, ranges: DataFrame) -> DataFrame:
    """Row images of the customers; ``ranges`` has the dates of the stale ones, found anew."""
    both = held.alias("h").join(delta.alias("d"), F.col("h.customer_id") == F.col("d.customer_id"), "full_outer")
    both = both.join(ranges.alias("r"), F.col("h.customer_id") == F.col("r.customer_id"), "left")
    found = F.col("r.customer_id").isNotNull()

    def total(c: str) -> Column:
        return (F.coalesce(f"h.{c}", F.lit(0)) + F.coalesce(f"d.{c}", F.lit(0))).cast(held.schema[c].dataType)

    after = F.struct(
        F.coalesce("h.customer_id", "d.customer_id").alias("customer_id"),
        *[total(c).alias(c) for c in ("n", "orders", "spend", "priced")],
        F.when(found, F.col("r.first_order_date")).otherwise(F.least("h.first_order_date", "d.came_first")).alias("first_order_date"),
        F.when(found, F.col("r.last_order_date")).otherwise(F.greatest("h.last_order_date", "d.came_last")).alias("last_order_date"),
    )
    before = F.when(F.col("h.customer_id").isNotNull(), F.struct([F.col(f"h.{c}").alias(c) for c in held.columns]))
    images = both.select(before.alias("before"), F.when(total("n") != 0, after).alias("after"))
    return images.where("before IS NOT NULL OR after IS NOT NULL")


def date_ranges(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))


# -- marts from states ---------------------------------------------------------


def _sum_of(total: str, counted: str) -> Column:
    """A sum as SQL gives it: NULL if no row had a value."""
    return F.when(F.col(counted) > 0, F.col(total).cast("double"))


def monthly_sales(state: DataFrame) -> DataFrame:
    part = F.split("month_key", "-")
    dated = F.col("month_key") != ""
    sales = state.select(
        F.when(dated, part.getItem(0).try_cast("long")).alias("year"),
        F.when(dated, F.try_element_at(part, F.lit(2)).try_cast("long")).alias("month"),
        F.col("orders").alias("total_orders"),
        _sum_of("revenue", "priced").alias("total_revenue"),
        safe_divide(_sum_of("revenue", "priced"), F.col("priced")).alias("avg_order_value"),
    )
    return schemas.conform(sales, "monthly_sales")


def customer_clv(state: DataFrame, copies: DataFrame) -> DataFrame:
    times = copies.select("customer_id", F.col("n").alias("copies"))
    spend = F.when(F.col("priced") > 0, (F.col("spend") * F.col("copies")).cast("double"))
    joined = state.join(times, "customer_id").select(
        "customer_id",
        (F.col("orders") * F.col("copies")).alias("total_orders"),
        spend.alias("total_spend"),
        safe_divide(_sum_of("spend", "priced"), F.col("priced")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        F.date_diff("last_order_date", "first_order_date").alias("customer_lifetime_days"),
        spend.alias("clv_amount"),
    )
    return schemas.conform(joined, "customer_clv")


def product_performance(state: DataFrame) -> DataFrame:
    performance = state.select(
        "product_id",
        F.when(F.col("counted") > 0, F.col("quantity")).alias("total_quantity_sold"),
        _sum_of("revenue", "priced").alias("total_revenue"),
        F.col("orders").alias("total_orders"),
    )
    return schemas.conform(performance, "product_performance")


def product_returns(state: DataFrame) -> DataFrame:
    sold = F.when(F.col("counted") > 0, F.col("quantity"))
    returned = F.when(F.col("product_id").isNull(), 0).otherwise(F.col("returned"))
    totals = state.select("product_id", sold.alias("total_sold"), returned.alias("total_returned"))
    rate = safe_divide(F.col("total_returned"), F.col("total_sold"))
    return schemas.conform(totals.withColumn("return_rate", rate), "product_returns")
