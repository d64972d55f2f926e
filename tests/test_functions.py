from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vouchlake.functions import dates, names, values


def one(spark, schema, value, column):
    return spark.createDataFrame([(value,)], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "text, shaped, parsed",
    [
        ("01-02-2024", True, date(2024, 2, 1)),
        ("2024-02-01", True, date(2024, 2, 1)),
        ("29-02-2024", True, date(2024, 2, 29)),
        ("2024/02/01", False, None),
        ("", False, None),
        (None, None, None),
        ("01-02-2024\n", False, None),
        (" 01-02-2024", False, None),
        ("1-2-2024", False, None),
        ("2024-02-01T00:00", False, None),
        ("٠١-٠٢-٢٠٢٤", False, None),
    ],
)
def test_date_shape_and_parse(spark, text, shaped, parsed):
    assert one(spark, "t string", text, dates.has_date_shape(F.col("t"))) is shaped
    assert one(spark, "t string", text, dates.parse_date(F.col("t"))) == parsed
    assert one(spark, "t string", text, dates.is_impossible_date(F.col("t"))) is False


@pytest.mark.parametrize("text", ["31-02-2024", "2023-02-29", "00-01-2024", "2024-13-01", "01-01-0000"])
def test_impossible_date(spark, text):
    with pytest.raises(Exception, match="impossible date"):
        one(spark, "t string", text, dates.parse_date(F.col("t")))
    assert one(spark, "t string", text, dates.parse_date(F.col("t"), "quarantine")) is None
    assert one(spark, "t string", text, dates.is_impossible_date(F.col("t"))) is True


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        dates.parse_shaped_date(F.lit("x"), "skip")


@pytest.mark.parametrize(
    "path, order_id",
    [
        ("invoice_O1_20240101.pdf", "O1"),
        ("a/b/invoice_O12_20240101.pdf", "O12"),
        ("invoice_O1_20240101.PDF", None),
        ("Invoice_O1_20240101.pdf", None),
        ("invoice_1_20240101.pdf", None),
        ("invoice_O1_2024010.pdf", None),
        ("invoice_O1_20240101.pdf.bak", None),
        ("xinvoice_O1_20240101.pdf", None),
        ("x/", None),
        ("invoice_O1_20240101.pdf\n", "O1"),
        ("invoice_O1_20240101.pdf\r", None),
        ("invoice_O١_20240101.pdf", "O١"),
    ],
)
def test_extract_order_id(spark, path, order_id):
    assert one(spark, "p string", path, names.extract_order_id(names.base_name(F.col("p")))) == order_id


@pytest.mark.parametrize("name", ["a.csv", "a.b.csv", ".csv", "..csv", "a", "a.", ".a.csv", "a..csv", ""])
def test_stem_and_extension_as_in_os_path(spark, name):
    import os.path

    got = spark.createDataFrame([(name,)], "n string").select(names.stem(F.col("n")), names.extension(F.col("n"))).first()
    assert tuple(got) == os.path.splitext(name)


def test_archived_csv(spark):
    df = spark.createDataFrame([("landing/structured/orders.csv", datetime(2026, 1, 2, 3, 4, 5))], "p string, u timestamp")
    assert df.select(names.archived_csv(F.col("p"), F.col("u"))).first()[0] == "processed/orders_20260102T030405.csv"


def test_casts_fail_on_bad_text(spark):
    for text, kind in [("12.0", "bigint"), ("x", "double"), ("soon", "timestamp")]:
        with pytest.raises(Exception):
            one(spark, "t string", text, F.col("t").cast(kind))


def test_row_json_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(values.row_json(df.columns)).first()[0] == '{"x":"a","y":null}'


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (0, 4)], "a long, b long")
    assert rows(df.select(values.safe_divide(F.col("a"), F.col("b")))) == [(0.0,), (0.25,), (None,)]


def test_money_sum_ignores_row_order(spark):
    amounts = [0.1 * i for i in range(1, 2000)]
    sums = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(parts)
        sums.add(float(df.agg(values.money_sum(F.col("a"), 2)).first()[0]))
    assert len(sums) == 1
