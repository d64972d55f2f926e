"""Toxic passages: maximal scoring segments of token log-odds, weighed by extreme-value statistics.

A token is a run of letters. Its score is the log-odds of its documents being
toxic against those of all labelled documents, with Dirichlet (here: Beta)
priors in two steps: a word shrinks towards its first bytes, those towards all
documents. A token counts once per document, and its k-th occurrence in a text
weighs a k-th, as repeats are no new evidence; a constant drift is taken off,
so that the scores of an ordinary text fall.

One linear scan over a text (Ruzzo and Tompa) finds all maximal segments,
those that no extension or cut improves. Their scores follow an extreme-value
law in clean texts: with ``lambda`` the positive root of ``E exp(lambda s) = 1``
and ``K`` from the mean of the best segments, ``lambda S - ln(K n)`` is
Gumbel distributed for ``n`` tokens. The best ``r`` segments together have the
tail probability of their sum (Karlin and Altschul); the least one over all
``r``, as a logarithm, is the evidence of the text. A logistic curve turns
evidence into a score.

Words and beginnings of words are known by hash bucket, so what is learned has
a fixed size whatever the corpus. Labels are taken from a sample of at most
``FIT_ROWS`` ids per class, and their texts are scored for calibration with
their own counts left out.

Defined cases: null text counts as empty. A text without tokens has no passage
and the evidence 0. Ids with more than one label take the largest, null labels
are none. Rows that repeat an id each count. If there are no labels of both classes, every score is the
share of toxic ones, 0 without any. Texts are read whole, however long. An
empty table gives no rows. Other columns than the text pass through; the new
ones get underscores in front where a name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchlake.llm import words
from vouchlake.llm.common import free_name, stored
from vouchlake.session import ship_package

FIT_ROWS = 200_000  # labelled ids of a class that are learned from, at most
WORD_BUCKETS = 1 << 18
START_BUCKETS = 1 << 16
START_BYTES = 4
WORD_PRIOR, START_PRIOR = 40.0, 20.0  # documents that a prior weighs
DRIFT = 0.5
SIGNIFICANT = 0.05  # expected number of such passages in a clean text
_BINS, _BIN = 6000, 0.01  # token scores from -30 to 30, evidence from 0 to 60
_EULER = 0.5772156649015329
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Counts(NamedTuple):
    """Documents per bucket, toxic and clean, and their numbers."""

    toxic_words: np.ndarray
    clean_words: np.ndarray
    toxic_starts: np.ndarray
    clean_starts: np.ndarray
    toxic: int
    clean: int


class Model(NamedTuple):
    toxic_words: np.ndarray  # toxic documents per word bucket
    word_weight: np.ndarray  # all of them
    start_share: np.ndarray  # toxic share of the documents of each beginning
    base: float
    rate: float  # lambda
    size: float  # ln K
    slope: float
    level: float


# -- tokens -------------------------------------------------------------------


class _Text(NamedTuple):
    word: np.ndarray  # bucket of each token
    begin: np.ndarray  # bucket of its first bytes
    turn: np.ndarray  # which occurrence of the word in the text it is, from 1
    start: np.ndarray  # code points
    end: np.ndarray


def _occurrence(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    order = np.lexsort((values, row))
    v, r = values[order], row[order]
    place = np.arange(len(v))
    fresh = np.ones(len(v), dtype=bool)
    fresh[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    out = np.empty(len(v), dtype=np.int64)
    out[order] = place - np.maximum.accumulate(np.where(fresh, place, 0)) + 1
    return out


def _texts(texts: pa.Array) -> Iterator[_Text]:
    """The tokens of every text, in order."""
    for first, last, data, offsets in words.text_chunks(texts):
        letter = _LETTER[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        opens, closes = letter.copy(), letter.copy()
        opens[1:] &= ~letter[:-1] | edge[1:-1]
        closes[:-1] &= ~letter[1:] | edge[1:-1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        row = np.searchsorted(offsets[1:], start, side="right")
        lowered = words._LOWER[data]
        word = (words.word_hashes(lowered, start, end) % np.uint64(WORD_BUCKETS)).astype(np.int64)
        begin = (words.word_hashes(lowered, start, np.minimum(start + START_BYTES, end)) % np.uint64(START_BUCKETS)).astype(np.int64)
        turn = _occurrence(word, row)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        ends = np.searchsorted(row, np.arange(last - first + 1))
        for k in range(last - first):
            part = slice(ends[k], ends[k + 1])
            zero = points[offsets[k]]
            yield _Text(word[part], begin[part], turn[part], points[start[part]] - zero, points[end[part]] - zero)


# -- segments -----------------------------------------------------------------


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """``(score, first, last + 1)`` of all maximal scoring segments, in order, in linear time.

    Only the positive scores are visited; each candidate keeps the nearest one
    before it that starts lower, so no candidate is passed twice.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)])
    at = np.flatnonzero(scores > 0)
    low: list[float] = []
    high: list[float] = []
    begin: list[int] = []
    end: list[int] = []
    lower: list[int] = []
    for i, l, r in zip(at.tolist(), total[at].tolist(), total[at + 1].tolist(), strict=True):
        b = i
        j = len(low) - 1
        while True:
            while j >= 0 and low[j] >= l:
                j = lower[j]
            if j < 0 or high[j] >= r:
                break
            # The new one reaches higher than an earlier one that starts lower: one segment.
            l, b = low[j], begin[j]
            del low[j:], high[j:], begin[j:], end[j:]
            j = lower[j]
            del lower[len(low) :]
        low.append(l)
        high.append(r)
        begin.append(b)
        end.append(i + 1)
        lower.append(j)
    return [(r - l, b, e) for l, r, b, e in zip(low, high, begin, end, strict=True)]


def _token_scores(share: np.ndarray, base: float, turn: np.ndarray) -> np.ndarray:
    odds = np.log(share / (1 - share)) - log(base / (1 - base))
    return np.where(odds > 0, odds / turn, odds) - DRIFT


def evidence(segments: list[float], n: int, rate: float, size: float) -> float:
    """Minus the logarithm of the least tail probability of the best ``r`` segments, over all ``r``."""
    best = total = 0.0
    for r, score in enumerate(sorted(segments, reverse=True), start=1):
        normal = rate * score - size - log(n)
        if normal <= 0:
            break
        total += normal
        best = max(best, total - (r - 1) * log(total) + lgamma(r + 1) + lgamma(r))
    return best


# -- learning -----------------------------------------------------------------


def _sample(labels: DataFrame) -> DataFrame:
    """``(labelled_id, toxic)``: at most ``FIT_ROWS`` ids of a class, of least hash."""
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = stored(known, "toxicity-labels")
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = None
    for toxic in (0, 1):
        some = known.where(F.col("toxic") == toxic)
        if counts.get(toxic, 0) > FIT_ROWS:
            # A hash below the share that is wanted; the limit only makes the bound strict.
            share = int(0.98 * FIT_ROWS / counts[toxic] * (1 << 30))
            some = some.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share).limit(FIT_ROWS)
        found = some if found is None else found.unionByName(some)
    return stored(found.select(F.col("doc_id").alias("labelled_id"), "toxic"), "toxicity-sample")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per bucket and class, of a batch."""
    for batch in batches:
        sums = {(kind, toxic): np.zeros(n, dtype=np.int64) for kind, n in ((0, WORD_BUCKETS), (1, START_BUCKETS)) for toxic in (0, 1)}
        labels = batch.column("toxic").to_pylist()
        for toxic, text in zip(labels, _texts(batch.column("text")), strict=True):
            sums[0, toxic][text.word[text.turn == 1]] += 1
            sums[1, toxic][np.unique(text.begin)] += 1
        kinds, buckets, classes, counts = [2, 2], [0, 0], [0, 1], [labels.count(0), labels.count(1)]
        kinds, buckets, classes, counts = ([np.array(x)] for x in (kinds, buckets, classes, counts))
        for (kind, toxic), n in sums.items():
            at = np.flatnonzero(n)
            for to, values in ((kinds, np.full(len(at), kind)), (buckets, at), (classes, np.full(len(at), toxic)), (counts, n[at])):
                to.append(values)
        columns = [np.concatenate(x) for x in (kinds, buckets, classes, counts)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "bucket", "toxic", "n"])


def _shares(counts: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    base = (counts.toxic + 0.5) / (counts.toxic + counts.clean + 1)
    starts = counts.toxic_starts + counts.clean_starts
    return counts.toxic_words, counts.toxic_words + counts.clean_words, (counts.toxic_starts + START_PRIOR * base) / (starts + START_PRIOR), base


def _calibrate(counts: Counts):
    """Scores of labelled texts, their own counts left out: token histogram and best segments."""
    base = _shares(counts)[3]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros(_BINS, dtype=np.int64)
        for batch in batches:
            sizes, found = [], []
            labels = batch.column("toxic").to_pylist()
            for toxic, text in zip(labels, _texts(batch.column("text")), strict=True):
                t, c = counts.toxic_words[text.word] - toxic, counts.clean_words[text.word] - (1 - toxic)
                ts, cs = counts.toxic_starts[text.begin] - toxic, counts.clean_starts[text.begin] - (1 - toxic)
                share = (t + WORD_PRIOR * (ts + START_PRIOR * base) / (ts + cs + START_PRIOR)) / (t + c + WORD_PRIOR)
                scores = _token_scores(share, base, text.turn)
                if not toxic:
                    bins += np.bincount(np.clip(((scores + 30) / _BIN).astype(int), 0, _BINS - 1), minlength=_BINS)
                sizes.append(len(scores))
                found.append([s for s, _, _ in maximal_segments(scores)])
            columns = [pa.array(labels, pa.int32()), pa.array(sizes, pa.int32()), pa.array(found, pa.list_(pa.float64())), pa.nulls(len(labels), pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(labels), pa.int64())], names=["toxic", "n", "segments", "bin", "tokens"])
        at = np.flatnonzero(bins)
        nulls = [pa.nulls(len(at), t) for t in (pa.int32(), pa.int32(), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays([*nulls, pa.array(at.astype(np.int32)), pa.array(bins[at])], names=["toxic", "n", "segments", "bin", "tokens"])

    return score


def _root(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive ``x`` with mean ``exp(x * value) = 1``; values fall on the whole and some are positive."""

    def excess(x: float) -> float:
        exponents = x * values + np.log(weights / weights.sum())
        top = exponents.max()
        return top + log(np.exp(exponents - top).sum())

    low, high = 1e-6, 1e-3
    while excess(high) < 0 and high < 1e3:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Slope and level of the logistic curve through binned counts; a weak prior keeps them finite."""
    slope, level = 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + level, -500, 500)))
        n = toxic + clean
        gradient = np.array([(x * (toxic - n * p)).sum() - 0.01 * slope, (toxic - n * p).sum() - 0.01 * level])
        w = n * p * (1 - p)
        step = np.linalg.solve([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]], gradient)
        norm = np.abs(step).max()
        slope, level = slope + step[0] / max(norm, 1), level + step[1] / max(norm, 1)
        if norm < 1e-9:
            break
    return float(slope), float(level)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from texts of ``(doc_id, text)`` and ``(doc_id, toxic)``."""
    ship_package(docs.sparkSession)
    sample = _sample(labels)
    rows = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("labelled_id")).select("toxic", "text")
    sums = rows.mapInArrow(_count, "kind long, bucket long, toxic long, n long").groupBy("kind", "bucket", "toxic").agg(F.sum("n").alias("n"))
    sizes = {0: WORD_BUCKETS, 1: START_BUCKETS, 2: 1}
    held = {(kind, toxic): np.zeros(n, dtype=np.int64) for kind, n in sizes.items() for toxic in (0, 1)}
    table = sums.toPandas()  # two numbers per bucket at most
    for (kind, toxic), part in table.groupby(["kind", "toxic"]):
        held[kind, toxic][part["bucket"].to_numpy()] = part["n"].to_numpy()
    counts = Counts(held[0, 1], held[0, 0], held[1, 1], held[1, 0], int(held[2, 1][0]), int(held[2, 0][0]))
    toxic_words, weight, starts, base = _shares(counts)
    plain = Model(toxic_words, weight, starts, base, 1.0, 0.0, 0.0, log(base / (1 - base)))
    if not counts.toxic and not counts.clean:
        return plain._replace(level=-np.inf)
    if not counts.toxic or not counts.clean:
        return plain
    scored = stored(rows.mapInArrow(_calibrate(counts), "toxic int, n int, segments array<double>, bin int, tokens long"), "toxicity-scores")
    bins = scored.where("bin IS NOT NULL").groupBy("bin").agg(F.sum("tokens").alias("tokens")).toPandas()
    values = bins["bin"].to_numpy() * _BIN - 30 + _BIN / 2
    # Without positive scores in clean texts any rate fits; 1 is that of plain log-likelihood ratios.
    rate = _root(values, bins["tokens"].to_numpy().astype(float)) if (values > 0).any() else 1.0
    best = F.coalesce(F.array_max("segments"), F.lit(0.0))
    mean = scored.where("toxic = 0 AND n > 0").agg(F.avg(rate * best - F.log(F.col("n").cast("double")))).first()[0]
    if mean is None:
        return plain
    size = mean - _EULER

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = zip(batch.column("segments").to_pylist(), batch.column("n").to_pylist(), strict=True)
            found = [evidence(some, max(n, 1), rate, size) for some, n in given]
            at = np.minimum(np.array(found, dtype=float) / _BIN, _BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(at)], names=["toxic", "at"])

    told = scored.where("toxic IS NOT NULL").select("toxic", "n", "segments").mapInArrow(weighed, "toxic int, at long")
    told = told.groupBy("at").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).toPandas()
    toxic = told["toxic"].to_numpy().astype(float)
    slope, level = _logistic(told["at"].to_numpy() * _BIN, toxic, told["n"].to_numpy() - toxic)
    return plain._replace(rate=rate, size=size, slope=slope, level=level)


# -- scoring ------------------------------------------------------------------

_PASSAGES = "array<struct<start:long,end:long,score:double,expected:double>>"


def score_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The other columns with ``score``, ``evidence`` and ``passages``: the segments a clean text hardly has.

    ``start`` and ``end`` count code points, ``expected`` is the number of such
    passages expected in a clean text of that length.
    """
    ship_package(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]
    left = docs.select([F.col(f"`{c}`") for c in kept])
    names = []
    for name in ("score", "evidence", "passages"):
        names.append(free_name(left, name))
    fields = ", ".join(f"`{t.name}` {t.dataType.simpleString()}" for t in left.schema)
    schema = f"{fields}, {names[0]} double, {names[1]} double, {names[2]} {_PASSAGES}"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, passages = [], []
            for tokens in _texts(batch.column(len(kept))):
                share = (model.toxic_words[tokens.word] + WORD_PRIOR * model.start_share[tokens.begin]) / (model.word_weight[tokens.word] + WORD_PRIOR)
                segments = maximal_segments(_token_scores(share, model.base, tokens.turn))
                n = max(len(tokens.word), 1)
                weights.append(evidence([s for s, _, _ in segments], n, model.rate, model.size))
                found = []
                for s, b, e in segments:
                    expected = exp(min(model.size + log(n) - model.rate * s, 700))
                    if expected <= SIGNIFICANT:
                        found.append({"start": int(tokens.start[b]), "end": int(tokens.end[e - 1]), "score": s, "expected": expected})
                passages.append(found)
            x = np.array(weights, dtype=float)
            scores = 1 / (1 + np.exp(-np.clip(model.slope * x + model.level, -700, 700)))
            if model.level == -np.inf:
                scores = np.zeros(len(x))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
            columns = [*batch.columns[: len(kept)], pa.array(scores), pa.array(x), pa.array(passages, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`")).mapInArrow(score, schema)
