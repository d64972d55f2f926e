"""Language identification by compression.

Each language has a zstandard raw-content dictionary of sample text. A text is
compressed against every dictionary, in pieces, so that the dictionary and not
the text's own beginning is what helps; the language with the smallest output
is the prediction. Short texts, and those where the runner-up is close, are
compressed again with a slower search. Where the runner-up still comes within
a margin the text is rejected. Texts and samples are lower-cased, and what is
no letter becomes a blank.

The classifier is fitted on a bounded sample: ``SAMPLE_DOCS`` labelled texts of
a language with letters in their first ``SAMPLE_CHARS`` code points, which is
what is taken of them; those with the least hash of their id, one text for an
id (the least); ``DICT_BYTES`` of dictionary. Predictions use whole texts.

Defined cases: a text that is null or has no letter is ``und``, with score 0,
and rejected; with equal sizes the lesser language by code point wins and the
text is rejected; without labelled texts all are ``und``; an empty table gives
no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vouchlake.llm.common import free_name, stored
from vouchlake.session import ship_package

SAMPLE_DOCS = 64
SAMPLE_CHARS = 4096
DICT_BYTES = 110_000
LEVEL, PIECE_BYTES = 6, 2048
CLOSE_LEVEL, CLOSE_PIECE_BYTES = 12, 1024
SHORT_BYTES = 512
CLOSE_MARGIN = 0.05
MIN_MARGIN = 0.002  # of the smaller size
SCORE_SLOPE = 50.0
BROADCAST_SAMPLES = 100_000
UNKNOWN = "und"


def fit(docs: DataFrame) -> dict[str, bytes]:
    """A dictionary for every language of ``(doc_id, text, lang)``."""
    named = docs.where(F.col("lang").isNotNull() & F.substring("text", 1, SAMPLE_CHARS).rlike(r"\p{L}"))
    key = F.xxhash64("doc_id")
    # Ids, not rows: copies of one id take one place. Few of a language are kept in each task.
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("key", "doc_id"))
    ranked = named.select("lang", "doc_id", key.alias("key")).distinct().withColumn("turn", turn).where(F.col("turn") <= SAMPLE_DOCS)
    chosen = stored(ranked.select(F.col("doc_id").alias("s_id"), F.col("lang").alias("s_lang")).distinct(), "language-sample")
    if chosen.count() <= BROADCAST_SAMPLES:
        chosen = F.broadcast(chosen)
    rows = (
        named.join(chosen, (F.col("doc_id") == F.col("s_id")) & (F.col("lang") == F.col("s_lang")))
        .select("lang", "doc_id", letters(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
        .groupBy("lang", "doc_id")
        .agg(F.min("text").alias("text"))
        .orderBy("lang", F.xxhash64("doc_id"), "doc_id", "text")
    )
    samples: dict[str, list[str]] = {}
    for row in rows.collect():  # SAMPLE_DOCS rows of SAMPLE_CHARS for each language
        samples.setdefault(row.lang, []).append(row.text)
    return {lang: "\n".join(texts).encode()[-DICT_BYTES:] for lang, texts in samples.items()}


class Coders:
    """A compressor for each language, at one level."""

    def __init__(self, dictionaries: dict[str, bytes], level: int, piece_bytes: int):
        self.piece_bytes, self.coders = piece_bytes, []
        for lang in sorted(dictionaries):
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self.coders.append(
                zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_checksum=False)
            )

    def sizes(self, text: bytes) -> np.ndarray:
        """Compressed size of a text under each dictionary, in equal pieces."""
        pieces = max(1, round(len(text) / self.piece_bytes))
        ends = [len(text) * k // pieces for k in range(pieces + 1)]
        parts = [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return np.array([sum(len(c.compress(p)) for p in parts) for c in self.coders], dtype=np.int64)


def _excess(size: np.ndarray) -> np.ndarray:
    return size / size.min() - 1


def _margin(excess: np.ndarray) -> float:
    return float(np.partition(excess, 1)[1]) if len(excess) > 1 else 1.0


def letters(text: Column) -> Column:
    """Lower-cased letters, blanks for all else; null and letterless texts give an empty one."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "))


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], columns: tuple[str, str, str] = ("lang_pred", "score", "lang_rejected")
) -> DataFrame:
    """``docs`` with the prediction, its score, and whether it is rejected, in place of any columns of these names."""
    ship_package(docs.sparkSession)
    langs = sorted(dictionaries)
    kept = [f for f in docs.schema if f.name not in columns]
    cleaned = free_name(docs, "letters")
    names = [f.name for f in kept]

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast = Coders(dictionaries, LEVEL, PIECE_BYTES)
        close = Coders(dictionaries, CLOSE_LEVEL, CLOSE_PIECE_BYTES)
        for batch in batches:
            found, scores, rejected = [], [], []
            for text in batch.column(cleaned):
                text = text.as_py().encode()
                if not text or not langs:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                excess = _excess(fast.sizes(text))
                if len(text) < SHORT_BYTES or _margin(excess) < CLOSE_MARGIN:
                    excess = _excess(close.sizes(text))
                found.append(langs[int(np.argmin(excess))])
                scores.append(float(1 / np.exp(-SCORE_SLOPE * excess).sum()))
                rejected.append(_margin(excess) < MIN_MARGIN)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*names, *columns],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select(*[F.col(f"`{n}`") for n in names], letters(F.col("text")).alias(cleaned)).mapInArrow(
        predicted, f"{schema}, `{columns[0]}` string, `{columns[1]}` double, `{columns[2]}` boolean"
    )
