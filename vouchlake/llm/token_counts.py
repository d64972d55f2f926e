"""Token counts kept as rollups that take signed changes.

A batch of changes is a table of signed counts: an insert adds a document and
its tokens, a delete takes them away, a revised count does both. A batch is
summed to one row per source, language and tokenizer version before it is
stored under its name, so a commit is small whatever the batch held, and a
batch that is already there is not stored again. Totals are the sum of the
stored rows.

Defined cases: a null text counts 0 tokens and still counts as a document; null
source or language is a group of its own; rows repeated in a batch count as
often as they are there; an empty batch is stored and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vouchlake.llm.common import WORD
from vouchlake.sinks.store import TableStore

GROUP = ("source", "lang", "tokenizer")
# Tokenizer versions: the pattern whose matches they count.
TOKENIZERS = {"words-1": WORD, "words-2": r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"}


def counted(docs: DataFrame, tokenizer: str, *more: Column) -> DataFrame:
    """Documents as counts under one tokenizer version, with more columns on request."""
    tokens = F.coalesce(F.regexp_count("text", F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("long")
    return docs.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), tokens.alias("n_tokens"), *more)


def inserts(counts: DataFrame) -> DataFrame:
    return _signed(counts, 1)


def deletes(counts: DataFrame) -> DataFrame:
    return _signed(counts, -1)


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts that replace others, be it the number, the group or the tokenizer."""
    return deletes(before).unionByName(inserts(after))


def _signed(counts: DataFrame, sign: int) -> DataFrame:
    return counts.select(*GROUP, F.lit(sign).cast("long").alias("n_docs"), (F.col("n_tokens") * sign).alias("n_tokens"))


class TokenRollup:
    """Totals by source, language and tokenizer version, in a table of a store."""

    def __init__(self, store: TableStore, table: str = "token_counts"):
        self.store, self.table = store, table

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Store a batch; False when it is there already."""
        return self.store.append_once(self.table, _totals(changes), batch)

    def totals(self) -> DataFrame:
        """Groups that still hold documents."""
        return _totals(self.store.read(self.table)).where(F.col("n_docs") != 0)


def _totals(rows: DataFrame) -> DataFrame:
    def total(name: str) -> Column:
        return F.sum(name).alias(name)

    return rows.groupBy(*GROUP).agg(total("n_docs"), total("n_tokens"))
