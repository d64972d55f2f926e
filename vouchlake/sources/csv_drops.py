"""CSV sources: the fixed-schema landing files and schema-inferred files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vouchlake import schemas
from vouchlake.sources.csv_records import WELL_FORMED, csv_records

# Stands for a quoted empty cell while reading, so that it stays apart from an
# empty cell, which is NULL.
_QUOTED_EMPTY = "\u0001quoted-empty\u0001"

FIXED_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "mode": "FAILFAST",
    # Otherwise a job that needs few columns would not see rows of wrong width.
    "columnPruning": "false",
    "escape": '"',
    "emptyValue": _QUOTED_EMPTY,
}


def restore_empty(df: DataFrame, cells: list[str] | None = None) -> DataFrame:
    """Quoted empty cells as empty text, in the given columns or in all."""
    cells = df.columns if cells is None else cells

    def restored(c: str) -> Column:
        return F.when(F.col(c) != _QUOTED_EMPTY, F.col(c)).when(F.col(c).isNotNull(), "").alias(c)

    return df.select([restored(c) if c in cells else F.col(c) for c in df.columns])


def scan_csv_fixed(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A landing CSV: header line skipped, columns by position, all text.

    A row with too few or too many cells fails the job.
    """
    return restore_empty(spark.read.options(**FIXED_OPTIONS).csv(path, schema=schemas.STAGE[table]))


def present_tables(listing: DataFrame) -> DataFrame:
    """``(table_name, path)`` of the landing tables that have arrived.

    ``listing`` holds paths relative to the store root. Each table has one
    fixed place in the landing zone: a file, or a folder of part files that
    bears the file's name.
    """
    place = F.regexp_extract(F.col("path"), f"^({schemas.LANDING_CSV}/[^/]+\\.csv)(/|\\z)", 1)
    table = F.regexp_extract("path", r"([^/]+)\.csv\z", 1)
    found = listing.select(place.alias("path")).filter(F.col("path") != "").distinct()
    return found.select(table.alias("table_name"), "path").filter(F.col("table_name").isin(list(schemas.STAGE)))


# Cell texts that stand for a missing value in an inferred file.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_BEYOND = "__beyond_the_header"
_WHOLE = r"^[ \t]*[+-]?\d+[ \t]*\z"
_REAL = r"^[ \t]*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))[ \t]*\z"
_TRUTH = r"^(True|TRUE|true|False|FALSE|false)\z"


def _has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some line ends inside quotes."""
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.where(quotes % 2 == 1).limit(1).isEmpty()


def _inferred_text(spark: SparkSession, path: str) -> DataFrame:
    """The cells as text: short rows give NULL, a row wider than the header fails the job.

    Files with line breaks inside quotes are split too, by ``csv_records``. Only
    where quotes stand in the middle of unquoted cells, so that counting them
    does not tell what is inside, such a file is read whole by one task.
    """
    options = {"header": "true", "escape": '"', "multiLine": str(_has_quoted_breaks(spark, path)).lower()}
    names = spark.read.csv(path, **options).columns
    # One column more than the header has, by position; only a wide row fills it.
    schema = ", ".join(f"`{c}` string" for c in [*names, _BEYOND])
    cells = None
    if options["multiLine"] == "true":
        records = csv_records(spark, path)
        if records.where(~F.col("record").rlike(WELL_FORMED)).isEmpty():
            row = F.from_csv("record", schema, {"escape": '"', "columnNameOfCorruptRecord": "__none"})
            cells = records.where(~F.col("first")).select(row.alias("row")).select("row.*")
    if cells is None:
        cells = spark.read.csv(path, schema=schema, enforceSchema=True, columnNameOfCorruptRecord="__none", **options)
    wide = F.raise_error(F.concat(F.lit("a row is wider than the header: ... "), F.col(f"`{_BEYOND}`")))
    first = F.when(F.col(f"`{_BEYOND}`").isNotNull(), wide.cast("string")).otherwise(F.col(f"`{names[0]}`"))
    return cells.select(first.alias(names[0]), *[F.col(f"`{c}`") for c in names[1:]])


def scan_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose column types come from the data.

    Whole numbers become BIGINT (DOUBLE when some are missing), other numbers
    DOUBLE, true/false BIGINT, the rest text, dates too. One aggregate over
    the file decides all columns; its result is one row.
    """
    text = _inferred_text(spark, path)
    text = text.select([F.when(~F.col(f"`{c}`").isin(MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in text.columns])

    def tally(c: Column) -> Column:
        whole = c.rlike(_WHOLE)
        return F.struct(
            F.count(c).alias("filled"),
            F.count_if(whole).alias("whole"),
            F.count_if(whole & F.trim(c).try_cast("bigint").isNotNull()).alias("long"),
            F.count_if(c.rlike(_REAL)).alias("real"),
            F.count_if(c.rlike(_TRUTH)).alias("truth"),
        )

    seen = text.agg(F.count(F.lit(1)).alias("__rows"), *[tally(F.col(f"`{c}`")).alias(c) for c in text.columns]).first()
    return text.select([_typed(F.col(f"`{c}`"), seen[c], seen["__rows"]).alias(c) for c in text.columns])


def _typed(c: Column, seen, rows: int) -> Column:
    complete = seen.filled == rows
    if seen.filled == 0:
        return c.cast("double")
    if seen.whole == seen.filled:
        if complete:
            return F.trim(c).cast("bigint") if seen.long == seen.filled else c
        return F.trim(c).cast("double")
    if seen.real == seen.filled:
        infinite = F.when(c.rlike("-"), F.lit("-Infinity")).otherwise(F.lit("Infinity"))
        return F.when(c.rlike("(?i)inf"), infinite).otherwise(F.trim(c)).cast("double")
    if seen.truth == seen.filled:
        flag = F.when(F.lower(c) == "true", 1).when(c.isNotNull(), 0)
        return flag.cast("bigint") if complete else flag.cast("string")
    return c
