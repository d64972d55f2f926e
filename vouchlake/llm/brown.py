"""Class-based n-gram scores: exchange clustering, class transitions, word emissions.

1. ``fit`` counts every word and makes the classes: the most frequent words, a
   fixed number, are clustered; each in turn is moved to the class that raises
   the likelihood of the class bigrams most, sweep after sweep. All other words
   wait in one open class, the end of a text is one more.
2. ``classed`` gives every other word its class. How often each class stands
   before and after a word is counted over all texts, grouped by word in a
   shuffle, and the word goes to the class that raises the likelihood most. The
   frequent words do so at once, ``ROUNDS`` times, then the rare ones with the
   classes that the frequent ones have got. The open class is left to words that
   training never saw.
3. ``score``: a text's probability is the product, over its words and its end,
   of the transition from class to class and of the word's emission by its class.

Frequent words, a fixed number, are known to every task with class and count.
The others, rare ones, are told by their hash and meet class and count in joins:
in training where two stand in a row, in scoring with all transitions that they
take part in. Words are compared by 64-bit hash.

Defined cases: null text is empty and has one token, its end; without training
texts every count is 0; rows are kept apart also where they repeat a
``doc_id``; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouchlake.llm.common import stored
from vouchlake.llm.words import hashed_words, text_chunks
from vouchlake.operators.keys import same_key
from vouchlake.session import ship_package

CLUSTERED = 1024  # words that make the classes; the others join them
CLASSES = 64
SWEEPS = 6
ROUNDS = 1  # moves of the frequent words that are not clustered
MOVED_WORDS = 2048  # words looked at together
FREQUENT = 1 << 18  # words whose counts every task holds: 3 MB
HELD_KEYS = 1_000_000  # counts a task keeps before it gives them out
SMOOTH = 0.1


class Tally:
    """Counts by key, given out when they are many."""

    def __init__(self) -> None:
        self.keys, self.counts, self.parts, self.waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.waiting += len(self.parts[-1][0])
        if self.waiting > HELD_KEYS // 2:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.parts]])
        counts = np.concatenate([self.counts, *[c for _, c in self.parts]])
        self.keys, at = np.unique(keys, return_inverse=True)
        self.counts = np.bincount(at, weights=counts, minlength=len(self.keys)).astype(np.int64)
        self.parts, self.waiting = [], 0

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """What is held, which is then given up."""
        self.merge()
        out = self.keys, self.counts
        self.keys, self.counts = self.keys[:0], self.counts[:0]
        return out

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in self.taken()], names=["key", "n"])


def _counted(docs: DataFrame, keys_of) -> DataFrame:
    """``(key, n)`` over all texts, counted in the tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column("text")):
                hashes, row = hashed_words(data, offsets)
                tally.add(keys_of(hashes, row, last - first))
                if len(tally.keys) > HELD_KEYS:
                    yield tally.batch()
        yield tally.batch()

    return docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class ClassModel:
    frequent: np.ndarray  # hashes of frequent words, sorted
    counts: np.ndarray  # their counts
    classes: np.ndarray  # their classes
    emission: np.ndarray  # log10 of the emission of each
    transition: np.ndarray  # log10, from class to class
    tokens: int  # of training, ends counted
    types: int
    ends: int
    open_weight: float  # what the open class divides by
    between: np.ndarray  # bigrams of classes
    by_class: np.ndarray  # words of each class, but for the open one and the end
    heads: np.ndarray  # whether a frequent word is one of those that made the classes

    @property
    def open_class(self) -> int:
        return len(self.transition) - 2

    @property
    def end_class(self) -> int:
        return len(self.transition) - 1

    @property
    def base_weight(self) -> float:
        return self.tokens + SMOOTH * (self.types + 1)


class Places:
    """Places of hashes in a sorted table, found by their upper bits: few words share these."""

    def __init__(self, known: np.ndarray) -> None:
        self.known, bits = known, max(len(known), 1).bit_length() + 2
        self.shift, self.half = 64 - bits, 1 << (bits - 1)
        self.start = np.searchsorted(known >> self.shift, np.arange(-self.half, self.half + 1)).astype(np.int32)

    def __call__(self, hashes: np.ndarray, missing: int) -> np.ndarray:
        """``missing`` where the table has no such hash."""
        out = np.full(len(hashes), missing, dtype=np.int64)
        if not len(self.known):
            return out
        part = (hashes >> self.shift) + self.half
        place, end = self.start[part], self.start[part + 1]
        left = np.flatnonzero(place < end)
        place, end, hashes = place[left], end[left], hashes[left]
        while len(left):
            same = self.known[place] == hashes
            out[left[same]] = place[same]
            place = place + 1
            more = ~same & (place < end)
            left, place, end, hashes = left[more], place[more], end[more], hashes[more]
        return out


def _places(hashes: np.ndarray, known: np.ndarray, missing: int) -> np.ndarray:
    return Places(known)(hashes, missing)


def _followed(values: np.ndarray, row: np.ndarray, rows: int, end) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(before, value, row)`` with one end after each row's values; a row starts after an end."""
    lengths = np.bincount(row, minlength=rows) + 1
    ends = np.cumsum(lengths) - 1
    out = np.full(int(lengths.sum()), end, dtype=np.int64)
    words = np.ones(len(out), dtype=bool)
    words[ends] = False
    out[words] = values
    before = np.concatenate([[end], out[:-1]]) if len(out) else out
    return before, out, np.repeat(np.arange(rows), lengths)


def _entropy_term(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, clustered: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of the first ``clustered`` words of a bigram count matrix; its last two rows keep their own.

    The matrix has a fixed size, so this runs on the driver. The words beyond it
    get their classes in ``classed``.
    """
    words = len(pairs)
    total = classes + words - clustered
    at = np.arange(words)
    at[:clustered] %= classes
    at[clustered:] = classes + np.arange(words - clustered)
    one = np.zeros((words, total))
    one[np.arange(words), at] = 1
    right, left = pairs @ one, pairs.T @ one  # of a word: what follows, what comes before, by class
    between = one.T @ right

    def add(w: int, c: int, sign: int) -> None:
        """Put a word, of which right and left leave it out itself, into a class or take it out."""
        if sign < 0:
            right[:, c] -= pairs[:, w]
            left[:, c] -= pairs[w, :]
        between[c, :] += sign * right[w]
        between[:, c] += sign * left[w]
        between[c, c] += sign * pairs[w, w]
        if sign > 0:
            right[:, c] += pairs[:, w]
            left[:, c] += pairs[w, :]

    f = _entropy_term
    for _ in range(sweeps):
        moved = 0
        for w in range(clustered):
            old = at[w]
            # Take the word out, then see what each class would gain by it.
            add(w, old, -1)
            m = between[:classes, :]
            k = between[:, :classes]
            diag = np.arange(classes)
            rows = f(m + right[w]) - f(m)
            cols = f(k + left[w][:, None]) - f(k)
            rows[diag, diag] = 0
            cols[diag, diag] = 0
            own = between[diag, diag]
            gain = rows.sum(axis=1) + cols.sum(axis=0) + f(own + right[w][diag] + left[w][diag] + pairs[w, w]) - f(own)
            outs, ins = between.sum(axis=1)[:classes], between.sum(axis=0)[:classes]
            all_out, all_in = right[w].sum() + pairs[w, w], left[w].sum() + pairs[w, w]
            gain -= f(outs + all_out) - f(outs) + f(ins + all_in) - f(ins)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            add(w, new, 1)
            at[w] = new
            moved += new != old
        if not moved:
            break
    return at


def most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of at most ``most`` words, the most frequent first.

    Counts are put in steps of one part in 64 of a doubling; whole steps are
    taken from the top as long as they fit, so nothing is sorted.
    """
    step = F.floor(F.log2("n") * 64).cast("int")
    steps = {r.step: r.words for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()}
    taken, least = 0, None
    for at in sorted(steps, reverse=True):
        taken += steps[at]
        if taken > most:
            break
        least = at
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    top = counts.where(step >= least).toArrow()
    keys, n = top["key"].to_numpy(), top["n"].to_numpy()
    order = np.lexsort((keys, -n))
    return keys[order], n[order]


def fit(docs: DataFrame, clustered: int = CLUSTERED, classes: int = CLASSES, frequent: int = FREQUENT) -> tuple[ClassModel, DataFrame]:
    """The model of all texts given, and the counts of all their words as ``(key, n)``."""
    ship_package(docs.sparkSession)
    counts = stored(_counted(docs, lambda hashes, row, rows: hashes.view(np.int64)), "word-counts")
    total = counts.agg(F.count(F.lit(1)).alias("types"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    ends = docs.count()
    keys, n = most_frequent(counts, frequent)
    size = min(clustered, len(keys))
    heads = np.sort(keys[:size])

    def pair_keys(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        before, word, _ = _followed(_places(hashes.view(np.int64), heads, size), row, rows, size + 1)
        return before * (size + 2) + word

    found = _counted(docs, pair_keys).toArrow()  # at most (clustered + 2) squared rows
    pairs = np.zeros((size + 2) ** 2)
    pairs[found["key"].to_numpy()] = found["n"].to_numpy()
    pairs = pairs.reshape(size + 2, size + 2)
    # In order of frequency, as the clustering takes them.
    order = np.concatenate([_places(keys[:size], heads, 0), [size, size + 1]]).astype(np.int64)
    at = exchange(pairs[np.ix_(order, order)], size, classes)
    classed = np.zeros((size + 2, classes + 2))
    classed[order, at] = 1
    between = classed.T @ pairs @ classed
    by_class = np.bincount(at[:size], weights=n[:size], minlength=classes + 2)
    open_words, open_types = total.words - n[:size].sum(), total.types - size
    open_weight = float(open_words + SMOOTH * (open_types + 1))
    place = np.argsort(keys)
    word_class = np.full(len(keys), classes, dtype=np.int64)
    word_class[:size] = at[:size]
    emission = np.log10((n + SMOOTH) / open_weight)
    emission[:size] = np.log10(n[:size] / by_class[at[:size]])
    model = ClassModel(
        keys[place], n[place], word_class[place], emission[place], _transition(between),
        int(total.words) + ends, int(total.types) + (1 if ends else 0), ends, open_weight,
        between, by_class[:classes], np.arange(len(keys))[place] < size,
    )
    return model, counts


def _transition(between: np.ndarray) -> np.ndarray:
    return np.log10((between + SMOOTH) / (between.sum(axis=1, keepdims=True) + SMOOTH * len(between)))


BLOCK_WORDS = 16  # frequent words whose neighbours travel together
_CODES = 256  # of a neighbour, with 125 classes at most: its class, plus the number of classes if it comes after; or the word itself
_MOST = (1 << 20) - 1  # counts of one entry


def _next_to(docs: DataFrame, model: ClassModel) -> DataFrame:
    """``(block, near)``: classes before and after the frequent words that are no heads, over all texts.

    ``near`` packs the place of the word in its block, the code and the number.
    """
    open_class, end_class, total = model.open_class, model.end_class, len(model.transition)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        missing = len(model.frequent)
        # The last two places are those of the other words and of the end.
        classes = np.append(model.classes, [open_class, end_class])
        asks = np.append(~model.heads, [False, False])
        tally, places = Tally(), Places(model.frequent)

        def held() -> pa.RecordBatch:
            keys, n = tally.taken()
            parts = -(-n // _MOST)
            keys, n = np.repeat(keys, parts), np.repeat(n, parts)
            n = np.where(np.diff(keys, append=-1) != 0, (n - 1) % _MOST + 1, _MOST)
            word, code = keys // _CODES, keys % _CODES
            blocks, starts = np.unique(word // BLOCK_WORDS, return_index=True)
            packed = ((n * _CODES + code) * BLOCK_WORDS + word % BLOCK_WORDS).astype(np.uint32)
            ends = pa.py_buffer(np.append(starts * 4, len(packed) * 4).astype(np.int32))
            near = pa.Array.from_buffers(pa.binary(), len(blocks), [None, ends, pa.py_buffer(packed)])
            return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), near], names=["block", "near"])

        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column("text")):
                hashes, row = hashed_words(data, offsets)
                before, now, _ = _followed(places(hashes.view(np.int64), missing), row, last - first, missing + 1)
                same = before == now
                left, right = asks[now] & ~same, asks[before] & ~same
                itself = now[same & asks[now]]
                word = np.concatenate([now[left], before[right], itself])
                code = np.concatenate([classes[before[left]], classes[now[right]] + total, np.full(len(itself), 2 * total)])
                tally.add(word * _CODES + code)
                if len(tally.keys) > HELD_KEYS:
                    yield held()
        tally.merge()
        if len(tally.keys):
            yield held()

    return docs.select("text").mapInArrow(found, "block long, near binary")


def _frequent_classes(docs: DataFrame, model: ClassModel) -> np.ndarray:
    """Classes of the frequent words after each that is no head moved to its best one."""
    total = len(model.transition)

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_block, sums = None, None

        def best() -> pa.RecordBatch:
            words = np.flatnonzero(sums.any(axis=1))
            place = open_block * BLOCK_WORDS + words
            near = sums[words].astype(float)
            new = _best_class(model.between, model.classes[place], near[:, total : 2 * total], near[:, :total], near[:, 2 * total])
            return pa.RecordBatch.from_arrays([pa.array(place), pa.array(new)], names=["place", "class"])

        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            for block, near in zip(blocks.tolist(), batch.column("near"), strict=True):
                if block != open_block:
                    if open_block is not None:
                        yield best()
                    open_block, sums = block, np.zeros((BLOCK_WORDS, _CODES), np.int64)
                packed = np.frombuffer(near.as_buffer(), np.uint32).astype(np.int64)
                cell = packed % BLOCK_WORDS * _CODES + packed // BLOCK_WORDS % _CODES
                np.add.at(sums.reshape(-1), cell, packed // (BLOCK_WORDS * _CODES))
        if open_block is not None:
            yield best()

    dealt = _next_to(docs, model).repartition("block").sortWithinPartitions("block")
    found = dealt.mapInArrow(moved, "place long, class long").toArrow()  # at most as many rows as there are frequent words
    classes = model.classes.copy()
    classes[found["place"].to_numpy()] = found["class"].to_numpy()
    return classes


def _cells(rows: DataFrame, total: int) -> np.ndarray:
    """``(cell, n)`` added up: bigrams of classes, a square of fixed size."""
    found = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(total * total)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(total, total)


def _class_bigrams(docs: DataFrame, model: ClassModel) -> np.ndarray:
    """Bigrams of the classes, those of words that the tasks do not hold in the open one."""
    open_class, end_class, total = model.open_class, model.end_class, len(model.transition)

    classes, places = np.append(model.classes, open_class), Places(model.frequent)

    def cells(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        place = places(hashes.view(np.int64), len(model.frequent))
        before, now, _ = _followed(classes[place], row, rows, end_class)
        return before * total + now

    return _cells(_counted(docs, cells).withColumnRenamed("key", "cell"), total)


def _rare_words(docs: DataFrame, model: ClassModel) -> DataFrame:
    """``(key, before, after, other)``: every occurrence of a word that the tasks do not hold, with the classes around it.

    Another such word is in the open class, and the one after it is told as
    ``other``; the word itself has a number of its own. Rows without ``before``
    hold the bigrams of classes: ``other`` by the number of the cell.
    """
    open_class, end_class, total = model.open_class, model.end_class, len(model.transition)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = np.append(model.classes, open_class)
        places, cells = Places(model.frequent), np.zeros(total * total, np.int64)
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column("text")):
                hashes, row = hashed_words(data, offsets)
                hashes = hashes.view(np.int64)
                place = places(hashes, len(model.frequent))
                one, two, _ = _followed(classes[place], row, last - first, end_class)
                cells += np.bincount(one * total + two, minlength=total * total)
                at = np.flatnonzero(place == len(model.frequent))
                # An end before the first word and after the last; a word's neighbours of other texts are ends too.
                of = np.concatenate([[end_class], classes[place], [end_class]])
                near, others = [], []
                for step in (-1, 1):
                    there = np.clip(at + step, 0, max(len(row) - 1, 0))
                    inside = (there == at + step) & (row[there] == row[at])
                    same = inside & (hashes[there] == hashes[at])
                    near.append(np.where(same, total, np.where(inside, of[at + step + 1], end_class)))
                    others.append((hashes[there], inside & ~same & (near[-1] == open_class)))
                other, rare = others[1]
                columns = [pa.array(hashes[at]), *[pa.array(x.astype(np.int16)) for x in near], pa.array(other, mask=~rare)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        at = np.flatnonzero(cells)
        none = pa.nulls(len(at), pa.int16())
        yield pa.RecordBatch.from_arrays([pa.array(at), none, none, pa.array(cells[at])], names=names)

    names = ["key", "before", "after", "other"]
    return docs.select("text").mapInArrow(found, "key long, before short, after short, other long")


def _rare_classes(rare: DataFrame, model: ClassModel) -> DataFrame:
    """``(key, n, class)`` of the rare words, in their best classes.

    Rows without a class hold bigrams with one rare word, or of one with
    itself: ``n`` by the number of the cell.
    """
    open_class, total = model.open_class, len(model.transition)

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((total, total), np.int64)

        def best(keys: np.ndarray, before: np.ndarray, after: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            ends = np.append(starts[1:], len(keys))
            for k in range(0, len(starts), MOVED_WORDS):
                s, e = starts[k : k + MOVED_WORDS], ends[k : k + MOVED_WORDS]
                word, part = np.repeat(np.arange(len(s)), e - s) * (total + 1), slice(s[0], e[-1])
                left, right = (np.bincount(word + x[part], minlength=len(s) * (total + 1)).reshape(len(s), -1) for x in (before, after))
                old = np.full(len(s), open_class)
                new = _best_class(model.between, old, right[:, :total].astype(float), left[:, :total].astype(float), right[:, total].astype(float))
                one = np.zeros((total, len(s)), np.int64)
                one[new, np.arange(len(s))] = 1
                cells[:] += one @ right[:, :total] + (one @ left[:, :total]).T
                np.add.at(cells, (new, new), right[:, total])
                yield words(keys[s], e - s, new)

        def words(keys: np.ndarray, n: np.ndarray, of: np.ndarray | None) -> pa.RecordBatch:
            classes = pa.nulls(len(keys), pa.int32()) if of is None else pa.array(of.astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64()), classes], names=["key", "n", "class"])

        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy(zero_copy_only=False)]) for h, c in zip(held, ("key", "before", "after"), strict=True)]
            # The last word may go on in the next batch.
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if whole:
                yield from best(*[h[:whole] for h in held])
                held = [h[whole:] for h in held]
        if len(held[0]):
            yield from best(*held)
        cells[open_class, :] = cells[:, open_class] = 0  # two rare words
        at = np.flatnonzero(cells)
        yield words(at, cells.reshape(-1)[at], None)

    dealt = rare.select("key", "before", "after").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(moved, "key long, n long, class int")


def _best_class(between: np.ndarray, old: np.ndarray, right: np.ndarray, left: np.ndarray, itself: np.ndarray) -> np.ndarray:
    """The class of each word that raises the likelihood most; a word stays where no other is better."""
    gain = class_gains(between, old, right, left, itself)
    best, words, last = np.argmax(gain, axis=1), np.arange(len(old)), gain.shape[1] - 1
    stays = (old <= last) & (gain[words, best] <= gain[words, np.minimum(old, last)] + 1e-9)
    return np.where(stays, old, best)


def class_gains(between: np.ndarray, old: np.ndarray, right: np.ndarray, left: np.ndarray, itself: np.ndarray) -> np.ndarray:
    """What the likelihood gains, up to a sum that is the same for all classes, by each word in each class.

    The rows of ``right`` and ``left`` are words, their columns the classes of
    their neighbours. A word is first taken out of its old class.
    """
    classes, f = len(between) - 2, _entropy_term
    words = np.arange(len(old))
    moving = old < classes
    gain = np.zeros((len(old), classes))
    for table, near, across in ((between[:classes].T, right, left), (between[:, :classes], left, right)):
        word, k = np.nonzero(near)
        n = near[word, k]
        cells = table[k]
        own = k == old[word]
        cells[own] -= across[word[own], :classes]
        out = np.flatnonzero(moving[word])
        cells[out, old[word[out]]] -= n[out]
        cells = np.maximum(cells, 0)
        more = f(cells + n[:, None]) - f(cells)
        met = np.flatnonzero(k < classes)
        more[met, k[met]] = 0
        if len(word):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            gain[word[starts]] += np.add.reduceat(more, starts, axis=0)
    x = right[:, :classes] + left[:, :classes] + itself[:, None]

    def added(held: np.ndarray, n: np.ndarray) -> np.ndarray:
        held = np.repeat(held[None, :], len(old), axis=0)
        held[words[moving], old[moving]] -= (n[words[moving], old[moving]] if n.shape[1] > 1 else n[moving, 0])
        held = np.maximum(held, 0)
        return f(held + n) - f(held)

    gain += added(np.diagonal(between)[:classes], x)
    gain -= added(between.sum(axis=1)[:classes], (right.sum(axis=1) + itself)[:, None])
    gain -= added(between.sum(axis=0)[:classes], (left.sum(axis=1) + itself)[:, None])
    return gain


def classed(docs: DataFrame, seeded: ClassModel, rounds: int = ROUNDS) -> tuple[ClassModel, DataFrame]:
    """The model in which every training word has a class, and ``(key, n, class)`` of the words that it does not hold.

    ``docs`` and ``seeded`` are what ``fit`` took and gave.
    """
    ship_package(docs.sparkSession)
    model, total = seeded, len(seeded.transition)
    for k in range(rounds):
        if k:
            model = replace(model, between=_class_bigrams(docs, model))
        model = replace(model, classes=_frequent_classes(docs, model))
    rare = stored(_rare_words(docs, model), "rare-words")
    model = replace(model, between=_cells(rare.where(F.col("before").isNull()).select(F.col("key").alias("cell"), F.col("other").alias("n")), total))
    rare = rare.where(F.col("before").isNotNull())
    found = stored(_rare_classes(rare, model), "rare-classes")
    words = found.where(F.col("class").isNotNull())
    cells = found.where(F.col("class").isNull()).select(F.col("key").alias("cell"), "n")
    # Two rare words in a row: each has its class from the join.
    of = [words.select(F.col("key").alias(f"key_{x}"), F.col("class").alias(f"class_{x}")) for x in "ab"]
    pairs = rare.where(F.col("other").isNotNull()).groupBy("key", "other").count()
    pairs = pairs.join(of[0], same_key(F.col("key"), F.col("key_a"))).join(of[1], same_key(F.col("other"), F.col("key_b")))
    cell = (F.col("class_a") * total + F.col("class_b")).cast("long")
    between = model.between.copy()
    between[model.open_class, :] = between[:, model.open_class] = 0
    between += _cells(cells.unionByName(pairs.select(cell.alias("cell"), F.col("count").alias("n"))), total)
    classes = model.open_class
    by_class = np.bincount(model.classes, weights=model.counts, minlength=classes)
    for r in words.groupBy("class").agg(F.sum("n").alias("n")).collect():
        by_class[r["class"]] += r.n
    emission = np.log10(model.counts / np.maximum(by_class[model.classes], 1))
    return replace(model, emission=emission, between=between, transition=_transition(between), by_class=by_class, open_weight=SMOOTH), words


def score(docs: DataFrame, model: ClassModel, counts: DataFrame) -> DataFrame:
    """``docs`` without its text, with the counts and log10 probabilities of each text.

    ``counts`` are the words that ``fit`` or ``classed`` gave with the model.
    """
    ship_package(docs.sparkSession)
    kept = [c for c in docs.columns if c != "text"]
    open_class, end_class = model.open_class, model.end_class
    base_log, open_log = np.log10(model.base_weight), np.log10(model.open_weight)
    end_base = np.log10((model.ends + SMOOTH) / model.base_weight)
    names = ["n_tokens", "n_known", "base_score", "score", "rare", "rare_n", "move_from", "move_to"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        missing = len(model.frequent)
        classes = np.append(model.classes, open_class)
        base = np.append(np.log10(model.counts + SMOOTH) - base_log, 0.0)
        emission = np.append(model.emission, 0.0)
        places = Places(model.frequent)
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column("text")):
                rows = last - first
                hashes, row = hashed_words(data, offsets)
                hashes = hashes.view(np.int64)
                place = places(hashes, missing)

                def summed(values: np.ndarray, by: np.ndarray = row, rows: int = rows) -> np.ndarray:
                    return np.bincount(by, weights=values, minlength=rows)

                def lists(values: np.ndarray, by: np.ndarray, kind: pa.DataType, rows: int = rows) -> pa.ListArray:
                    ends = pa.array(np.searchsorted(by, np.arange(rows + 1)).astype(np.int32))
                    return pa.ListArray.from_arrays(ends, pa.array(values, kind))

                known = summed((place < missing).astype(float)) + (model.ends > 0)
                rare = np.flatnonzero(place == missing)
                # One entry for each rare word of a text.
                pair = np.empty(len(rare), dtype=[("row", np.int64), ("key", np.int64)])
                pair["row"], pair["key"] = row[rare], hashes[rare]
                order = np.lexsort((pair["key"], pair["row"]))
                pair = pair[order]
                new = np.ones(len(pair), dtype=bool)
                new[1:] = pair[1:] != pair[:-1]
                at = np.flatnonzero(new)
                number = np.diff(np.append(at, len(pair)))
                # In the transitions, a rare word stands as its place in its text's entries, below zero.
                state = classes[place]
                entry = np.cumsum(new) - 1
                state[rare[order]] = -1 - (entry - np.searchsorted(pair["row"][at], pair["row"]))
                before, now, owner = _followed(state, row, rows, end_class)
                told = (before >= 0) & (now >= 0)
                moves = np.zeros(len(now))
                moves[told] = model.transition[before[told], now[told]]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(first, rows) for c in kept],
                        pa.array(np.bincount(row, minlength=rows) + 1, pa.int64()),
                        pa.array(known.astype(np.int64)),
                        pa.array(summed(base[place]) + end_base - summed((place == missing).astype(float)) * base_log),
                        pa.array(summed(emission[place]) + summed(moves, owner)),
                        lists(pair["key"][at], pair["row"][at], pa.int64()),
                        lists(number, pair["row"][at], pa.int32()),
                        lists(before[~told], owner[~told], pa.int32()),
                        lists(now[~told], owner[~told], pa.int32()),
                    ],
                    names=[*kept, *names],
                )

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(divide="ignore"):
            weights = np.append(np.log10(np.maximum(model.by_class, 1)), open_log)
        for batch in batches:
            held = {c: batch.column(c) for c in names}
            rows = batch.num_rows
            entries = held["rare"].value_lengths().to_numpy(zero_copy_only=False)
            owner, first = np.repeat(np.arange(rows), entries), np.cumsum(entries) - entries
            # Every rare word of a text has one entry here, in the same order.
            flat = batch.column("found").flatten()
            n, of = (flat.field(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            times = held["rare_n"].flatten().to_numpy(zero_copy_only=False)
            logs = np.log10(n + SMOOTH) * times
            emitted = (np.log10(n + SMOOTH * (of == open_class)) - weights[of]) * times
            steps = np.repeat(np.arange(rows), held["move_from"].value_lengths().to_numpy(zero_copy_only=False))

            def state(name: str) -> np.ndarray:
                code = held[name].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                out, low = code.copy(), code < 0
                out[low] = of[first[steps[low]] - 1 - code[low]]
                return out

            moves = model.transition[state("move_from"), state("move_to")]

            def summed(values: np.ndarray, by: np.ndarray = owner, rows: int = rows) -> np.ndarray:
                return np.bincount(by, weights=values, minlength=rows)

            columns = [
                *[batch.column(c) for c in kept],
                held["n_tokens"],
                pa.array(held["n_known"].to_numpy(zero_copy_only=False) + summed((n > 0) * times).astype(np.int64)),
                pa.array(np.full(rows, model.tokens), pa.int64()),
                pa.array(held["base_score"].to_numpy(zero_copy_only=False) + summed(logs)),
                pa.array(held["score"].to_numpy(zero_copy_only=False) + summed(emitted) + summed(moves, steps)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    lists = "rare array<long>, rare_n array<int>, move_from array<int>, move_to array<int>"
    schema = f"{head}, n_tokens long, n_known long, base_score double, score double, {lists}"
    rows = stored(docs.mapInArrow(scored, schema).withColumn("row_id", F.monotonically_increasing_id()), "scored-texts")
    rare = rows.select("row_id", F.posexplode("rare").alias("at", "rare"))
    of = F.col("class") if "class" in counts.columns else F.lit(open_class)
    words = counts.select("key", "n", of.cast("int").alias("class"))
    entry = F.struct("at", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.coalesce("class", F.lit(open_class)).alias("class"))
    found = (
        rare.join(words, same_key(F.col("rare"), F.col("key")), "left")
        .groupBy(F.col("row_id").alias("r_id"))
        .agg(F.sort_array(F.collect_list(entry)).alias("found"))
    )
    whole = rows.join(found, F.col("row_id") == F.col("r_id"), "left").drop("row_id", "r_id")
    none = F.array().cast("array<struct<at:int,n:bigint,class:int>>")
    done = f"{head}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return whole.withColumn("found", F.coalesce("found", none)).mapInArrow(finished, done)
