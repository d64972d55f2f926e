import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest

from tests.conftest import rows
from vouchlake import schemas
from vouchlake.operators import marts

T = datetime(2026, 1, 1)


def customers(spark, ids):
    return spark.createDataFrame([(c, "n", "e", "p", date(2020, 1, 1), "x", T) for c in ids], schemas.CURATED["customers_curated"])


def orders(spark, data):
    full = [(o, c, d, "s", t, T, "PASS", T) for o, c, d, t in data]
    return spark.createDataFrame(full, schemas.CURATED["orders_curated"])


def items(spark, data):
    full = [(i, o, p, "n", q, u, T) for i, o, p, q, u in data]
    return spark.createDataFrame(full, schemas.CURATED["order_items_curated"])


def returns(spark, data):
    return spark.createDataFrame([(r, o, date(2024, 1, 1), "x", 1.0, T) for r, o in data], schemas.CURATED["returns_curated"])


def test_clv(spark):
    got = marts.customer_clv(
        customers(spark, ["C1", "C2", "C2", "C4", None]),
        orders(
            spark,
            [
                ("O1", "C1", date(2024, 1, 1), 10.0),
                ("O2", "C1", date(2024, 1, 31), None),
                (None, "C2", date(2024, 2, 1), 2.5),
                ("O4", "C3", date(2024, 2, 1), 9.0),
                ("O5", None, date(2024, 2, 1), 9.0),
                ("O6", "C4", date(2024, 2, 1), None),
            ],
        ),
    )
    assert rows(got) == [
        ("C1", 2, 10.0, 10.0, date(2024, 1, 1), date(2024, 1, 31), 30, 10.0),
        ("C2", 0, 5.0, 2.5, date(2024, 2, 1), date(2024, 2, 1), 0, 5.0),
        ("C4", 1, None, None, date(2024, 2, 1), date(2024, 2, 1), 0, None),
    ]


@pytest.mark.parametrize(
    "amount, segment",
    [(None, "LOW_VALUE"), (19999.99, "LOW_VALUE"), (20000.0, "MEDIUM_VALUE"), (50000.0, "MEDIUM_VALUE"), (50000.01, "HIGH_VALUE")],
)
def test_segments(spark, amount, segment):
    clv = spark.createDataFrame([("C1", amount, 1)], "customer_id string, clv_amount double, total_orders long")
    assert marts.customer_segments(clv).first().customer_segment == segment


def test_monthly_sales(spark):
    got = marts.monthly_sales(
        orders(spark, [("O1", "C", date(2024, 1, 1), 10.0), (None, "C", date(2024, 1, 2), 20.0), ("O3", "C", date(2025, 1, 2), None)])
    )
    assert rows(got) == [(2024, 1, 1, 30.0, 15.0), (2025, 1, 1, None, None)]


def test_returns_count_once_per_item_row(spark):
    sold = items(
        spark,
        [
            ("I1", "O1", "P1", 2, 1.0),
            ("I2", "O1", "P1", 3, 1.0),
            ("I3", "O1", "P2", 1, 1.0),
            ("I4", "O2", "P3", 0, 1.0),
            ("I5", "O2", "P4", 4, 1.0),
            ("I6", "O1", None, 4, 1.0),
        ],
    )
    got = marts.product_returns(returns(spark, [("R1", "O1"), ("R2", "O1"), (None, "O1"), ("R3", "O9")]), sold)
    assert rows(got) == sorted(
        [("P1", 5, 4, 0.8), ("P2", 1, 2, 2.0), ("P3", 0, 0, None), ("P4", 4, 0, 0.0), (None, 4, 0, 0.0)], key=repr
    )
    performance = marts.product_performance(sold)
    assert ("P1", 5, 5.0, 1) in rows(performance)


@pytest.mark.parametrize("seed", [5, 6])
def test_marts_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    ids = [f"C{rnd.randrange(6)}" for _ in range(9)]
    held = [
        (f"O{i}", f"C{rnd.randrange(8)}", date(2024, 1, 1) + timedelta(rnd.randrange(400)), rnd.randrange(10000) / 4)
        for i in range(60)
    ]
    lines = [(f"I{i}", f"O{rnd.randrange(20)}", f"P{rnd.randrange(5)}", rnd.randrange(9), 0.25) for i in range(150)]
    back = [(f"R{i}", f"O{rnd.randrange(25)}") for i in range(40)]

    spend = defaultdict(list)
    for c in ids:
        for o in held:
            if o[1] == c:
                spend[c].append(o)
    clv = marts.customer_clv(customers(spark, ids), orders(spark, held), money_scale=2).collect()
    assert {r.customer_id: (r.total_orders, r.total_spend) for r in clv} == {
        c: (len(v), sum(o[3] for o in v)) for c, v in spend.items()
    }
    pairs = defaultdict(int)
    for _, o in back:
        for line in lines:
            if line[1] == o:
                pairs[line[2]] += 1
    got = marts.product_returns(returns(spark, back), items(spark, lines)).collect()
    assert {r.product_id: r.total_returned for r in got if r.total_returned} == dict(pairs)
