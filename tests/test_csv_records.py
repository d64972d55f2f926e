"""CSV files with line breaks in quotes, read in splits, against the whole read."""

import csv
import io
import random

import pytest

from tests.conftest import rows
from tests.test_files import write
from vouchlake.sources import csv_drops
from vouchlake.sources.csv_records import csv_records

SPLIT = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}


@pytest.fixture
def small_splits(spark):
    old = {name: spark.conf.get(name, None) for name in SPLIT}
    for name, value in SPLIT.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in old.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def table(rng, n):
    words = ["a", "b c", "", 'say "x"', "line\nbreak", "two\n\nbreaks", '"', "\n", "ü☃", "x,y", "long " * 30, "many\n" * 150]
    return [[str(k), rng.choice(words), rng.choice(words)] for k in range(n)]


def text_of(data, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "one", "two"])
    writer.writerows(data)
    return out.getvalue()


def whole_read(spark, path):
    df = spark.read.csv(path, header=True, escape='"', multiLine=True)
    return rows(df.select([df[c] for c in df.columns]))


@pytest.mark.parametrize("seed", [1, 2])
def test_many_splits_give_the_rows_of_the_whole_read(small_splits, tmp_path, seed):
    spark, rng = small_splits, random.Random(seed)
    for name in ("a", "b"):
        write(f"{tmp_path}/in/{name}.csv", text_of(table(rng, 120)))
    assert spark.read.text(f"{tmp_path}/in").rdd.getNumPartitions() > 20
    got = csv_drops._inferred_text(spark, f"{tmp_path}/in")
    assert rows(got) == whole_read(spark, f"{tmp_path}/in")
    assert got.rdd.getNumPartitions() > 20  # the whole read has one for each file
    firsts = [r.record for r in csv_records(spark, f"{tmp_path}/in").collect() if r.first]
    assert firsts == ["id,one,two"] * 2


def test_a_record_over_many_splits_and_a_header_with_breaks(small_splits, tmp_path):
    spark = small_splits
    write(f"{tmp_path}/x.csv", '"i\nd",one\n\n1,"' + "line of it\n" * 400 + '"\n2,b\n\n')
    got = csv_drops._inferred_text(spark, f"{tmp_path}/x.csv")
    assert got.columns == ["i\nd", "one"]
    assert rows(got) == [("1", "line of it\n" * 400), ("2", "b")]


def test_types_and_wide_rows_as_in_files_without_breaks(small_splits, tmp_path):
    spark = small_splits
    write(f"{tmp_path}/x.csv", text_of([[str(k), "1.5", "x\ny"] for k in range(100)]))
    assert dict(csv_drops.scan_csv_inferred(spark, f"{tmp_path}/x.csv").dtypes) == {"id": "bigint", "one": "double", "two": "string"}
    write(f"{tmp_path}/wide.csv", 'a,b\n1,"two\nlines"\n2,3,4\n')
    with pytest.raises(Exception, match="wider than the header"):
        csv_drops.scan_csv_inferred(spark, f"{tmp_path}/wide.csv").collect()


def test_quotes_inside_unquoted_cells_are_read_whole(small_splits, tmp_path):
    spark = small_splits
    write(f"{tmp_path}/x.csv", 'a,b\n5" pipe,x\n1,"two\nlines"\n6" pipe,y\n')
    assert rows(csv_drops._inferred_text(spark, f"{tmp_path}/x.csv")) == whole_read(spark, f"{tmp_path}/x.csv")
