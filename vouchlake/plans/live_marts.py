"""The marts as stored states that follow the golden tables change by change."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from vouchlake.operators import mart_deltas as deltas
from vouchlake.operators.keys import within
from vouchlake.sinks.store import TableStore

INPUTS = ("orders_curated", "customers_curated", "order_items_curated", "returns_curated")


class LiveMarts:
    """Applies the change feeds of the golden tables to the states of the marts.

    The golden tables are kept by files (``TableStore.merge``, ``insert``,
    ``delete``). ``catch_up`` applies every version since the last call, one
    after the other; each step is a version of a state with a token that names
    input and number, so a call that was cut short is taken up again without
    adding anything twice. Of a state only the files with changed keys are
    read beyond their keys and written.
    """

    def __init__(self, store: TableStore, prefix: str = "mart_"):
        self.store, self.prefix = store, prefix

    def state(self, table: str) -> DataFrame:
        name = self.prefix + table
        if self.store.exists(name):
            return self.store.read(name)
        return self.store.spark.createDataFrame([], deltas.STATES[table])

    def of_keys(self, table: str, keys: DataFrame) -> DataFrame:
        """The rows of the files of a state that hold one of the keys."""
        name, key = self.prefix + table, deltas.state_key(table)
        if not self.store.exists(name):
            return self.state(table)
        return self.store.read_keys(name, key, keys)

    def _step(self, table: str, token: str, delta: Callable[[], DataFrame], images: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Add a delta to a state; the delta is written first, as it may depend on states that go on."""
        name = self.prefix + table
        if self.store.has_token(name, token):
            return
        change = self._kept(table, token, delta)
        if not self.store.exists(name):
            self.store.insert(name, deltas.state_key(table), self.state(table))
        self.store.merge(name, deltas.state_key(table), change, lambda held: images(held, change), token, feed=False)
        self.store.prune(f"{name}_delta", 1)

    def _kept(self, table: str, token: str, delta: Callable[[], DataFrame]) -> DataFrame:
        """The stored delta of a step, written if it is not there."""
        kept = f"{self.prefix}{table}_delta"
        if not self.store.has_token(kept, token):
            self.store.replace(kept, delta(), token=token)
        return self.store.read(kept)

    def _orders(self, feed: DataFrame, token: str, version: int) -> None:
        self._step("monthly_state", token, lambda: deltas.monthly_delta(feed), lambda held, d: deltas.added_images(held, d, ["month_key"]))

        def customers(held: DataFrame, delta: DataFrame) -> DataFrame:
            orders = self.store.read("orders_curated", version).select("customer_id", "order_date")
            found = within(orders, deltas.stale_customers(held, delta), "customer_id", "customer_id")
            return deltas.customer_images(held, delta, deltas.date_ranges(found))

        self._step("customer_state", token, lambda: deltas.customer_delta(feed), customers)

    def _customers(self, feed: DataFrame, token: str) -> None:
        self._step("customer_copies", token, lambda: deltas.copies_delta(feed), lambda held, d: deltas.added_images(held, d, ["customer_id"]))

    def _items(self, feed: DataFrame, token: str) -> None:
        def lines() -> DataFrame:
            return deltas.lines_delta(feed)

        def products() -> DataFrame:
            # Stored by the step of the lines too, which takes it from there.
            changed = self._kept("order_lines", token, lines)
            keys = changed.select("order_key")
            return deltas.product_delta_of_items(feed, changed, self.of_keys("order_lines", keys), self.of_keys("order_returns", keys))

        # The products first: their delta needs the lines as they were.
        self._step("product_state", token, products, lambda held, d: deltas.added_images(held, d, ["product_key"], ("product_id",)))
        pair = ["order_key", "product_key"]
        self._step("order_lines", token, lines, lambda held, d: deltas.added_images(held, d, pair, ("order_id", "product_id")))

    def _returns(self, feed: DataFrame, token: str) -> None:
        keys = feed.select(deltas.marked_key("order_id").alias("order_key"))

        def products() -> DataFrame:
            return deltas.product_delta_of_returns(feed, self.of_keys("order_lines", keys))

        self._step("product_state", token, products, lambda held, d: deltas.added_images(held, d, ["product_key"], ("product_id",)))
        self._step("order_returns", token, lambda: deltas.returns_delta(feed), lambda held, d: deltas.added_images(held, d, ["order_key"]))

    def catch_up(self) -> None:
        """Apply what the golden tables went through since the last call."""
        steps = {"customers_curated": self._customers, "order_items_curated": self._items, "returns_curated": self._returns}
        for table in INPUTS:
            done = f"{self.prefix}{table}_applied"
            for version in range(self.store.version(done) + 1, self.store.version(table) + 1):
                feed, token = self.store.changes(table, version - 1, version), f"{table}-{version}"
                if table == "orders_curated":
                    self._orders(feed, token, version)
                else:
                    steps[table](feed, token)
                # One row; its version number is the number of the version applied.
                self.store.replace(done, self.store.spark.range(1))
            self.store.prune(done, 1) if self.store.exists(done) else None
        for table in deltas.STATES:
            if self.store.exists(self.prefix + table):
                self.store.prune(self.prefix + table, 2)

    def monthly_sales(self) -> DataFrame:
        return deltas.monthly_sales(self.state("monthly_state"))

    def customer_clv(self) -> DataFrame:
        return deltas.customer_clv(self.state("customer_state"), self.state("customer_copies"))

    def product_performance(self) -> DataFrame:
        return deltas.product_performance(self.state("product_state"))

    def product_returns(self) -> DataFrame:
        return deltas.product_returns(self.state("product_state"))
