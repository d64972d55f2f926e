"""Removal of lines that an earlier line resembles: an exact set-similarity join.

A line is the set of its words, lower-cased. It is removed when a line before it
(an earlier document by ``doc_id``, or an earlier line of the same document) has
a set of Jaccard similarity ``NUM / DEN`` or more, be that line kept or not.

1. The words of each line are taken once, as hashes. They are put in order of
   rarity, the same for all lines. How many lines hold a word is counted over
   all lines, in a fixed number of hash buckets.
2. Lines with equal sets fold into the first of them; the others are removed.
3. Prefix filter: a line asks whether another one shares one of its rarest words.
   Lengths, the places of the shared word as the first one, and a bitmap of the
   words bound the overlap from above in the join itself. It is a semi join, so that ``m`` variants
   of one line give ``m`` rows a word, not their pairs.
4. Lines with such a partner are taken with all their words. Each is compared
   with one promising earlier line first; similar ones are settled.
5. The others are joined once more, the words with them, at the rarest word that
   two lines share: a line that shares enough words with any earlier one is
   removed. This too asks only whether there is one. The lines of a word are looked through until a partner is found;
   adaptive execution splits hot words.

All of it is DataFrame expressions. Words are compared by 56-bit hash within a
rarity class, and sets by 64-bit hash.

Defined cases: lines are parted by line feeds; a line without words is never
removed and matches nothing; null text has no lines and stays null. Documents
without ``doc_id`` come first, all at one place, as do rows that share a
``doc_id``: lines at one place are not earlier than each other, but equal rows
come out equal. An empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vouchlake.llm.common import given_back, stored
from vouchlake.llm.picks import possible
from vouchlake.operators.keys import same_key

NUM, DEN = 8, 10
BUCKETS = 1 << 18  # of the word count; their classes, a byte each, go to all tasks
COMMON = 14  # classes below the most common word's, from which words are too common to group by
BLOCKS = 4  # the lines of a word are cut into so many parts, of which the first lines are tried before all others
FREQUENT = 1000  # a set that more than this part of all lines has is joined by broadcast; there are fewer than this
_WORDS = r"[\x20\x09-\x0D]+"
_OTHER_SPACES = "\t\x0b\x0c\r"  # a line holds no line feed


def _split(line: Column) -> Column:
    """Words of a line, and empty ones between blanks; most lines have blanks only, which takes no pattern."""
    text = F.lower(line)
    odd = reduce(Column.__or__, (F.contains(line, F.lit(c)) for c in _OTHER_SPACES))
    return F.when(odd, F.split(text, _WORDS)).otherwise(F.split(text, " "))


def words(line: Column) -> Column:
    """Hashes of the distinct words of a line."""
    return F.array_remove(F.array_distinct(F.transform(_split(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _bucket(word: Column, buckets: int) -> Column:
    return word.bitwiseAND(buckets - 1).cast("int")


@dataclass(frozen=True)
class Rarity:
    """A class for each bucket of words, higher for words that occur more."""

    classes: list[int]

    def below(self, steps: int) -> int:
        """The least class of the words that many classes below the most common one."""
        return max(1, max(self.classes) - steps)

    def halves(self, end: int) -> int:
        """The class that parts the occurrences of words of lower classes than ``end`` in two."""
        held = [0.0] * end
        for c in self.classes:
            if c < end:
                held[c] += 2 ** (c / 2) if c else 0
        half, start = sum(held) / 2, 0
        while start < end and sum(held[: start + 1]) <= half:
            start += 1
        return start

    def keys(self, hashes: Column) -> Column:
        """Words as numbers in order of rarity: the class above, the hash below."""
        # A constant of fixed size, which the optimizer folds into one array. Plans, which the driver holds and logs as text,
        # name all its numbers several times: so they are the classes, and not where a class has its place in a key.
        table = F.split(F.lit(",".join(map(str, self.classes))), ",").cast("array<tinyint>")

        def keyed(w: Column) -> Column:
            # Every bucket has a class. Taken for every word, so with as few expressions as can be.
            place = F.shiftleft(table[w.bitwiseAND(len(self.classes) - 1)].cast("long"), 56)
            return place.bitwiseOR(F.shiftrightunsigned(w, 8))

        return F.sort_array(F.transform(hashes, keyed))


_PACK = 10  # a row to the driver holds the classes of so many bits of buckets


def rarity(lines: DataFrame, buckets: int = BUCKETS) -> Rarity:
    """Classes from the number of lines that hold the words of a bucket: twice its binary logarithm."""
    held = lines.select(F.explode("words").alias("word")).groupBy(_bucket(F.col("word"), buckets).alias("bucket")).count()
    class_of = F.least(F.floor(F.log2("count") * 2), F.lit(126)).cast("int")
    packed = F.collect_list(F.shiftleft("bucket", 7).bitwiseOR(class_of))
    classes = [0] * buckets
    for row in held.groupBy(F.shiftright("bucket", _PACK)).agg(packed.alias("packed")).toLocalIterator():
        for one in row.packed:
            classes[one >> 7] = one & 127
    return Rarity(classes)


def _lines(docs: DataFrame) -> DataFrame:
    """All lines."""
    kept = [c for c in ("place", "mark") if c in docs.columns]
    return docs.where(F.col("text").isNotNull()).select(*kept, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _placed(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents with the number of their place, and how many lines a place has room for.

    Places follow ``doc_id``. Where ids lie too far apart for place and line
    number to fit one number, they are counted off in id order instead.
    """
    sizes = docs.agg(
        F.min("doc_id").cast("decimal(20,0)").alias("low"),
        F.max("doc_id").cast("decimal(20,0)").alias("high"),
        F.max(F.octet_length("text")).alias("longest"),
    ).first()
    room = int(sizes.longest or 0) + 1  # no text has more lines than this
    if sizes.low is None:
        return docs.withColumn("place", F.lit(0).cast("long")), room
    if (int(sizes.high) - int(sizes.low) + 2) * room < 1 << 62:
        place = F.coalesce(F.col("doc_id") - int(sizes.low) + 1, F.lit(0)).cast("long")
        return docs.withColumn("place", place), room
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    parts = max(1, ids.sparkSession.sparkContext.defaultParallelism)
    spread = stored(
        ids.repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id")
        .select("doc_id", F.monotonically_increasing_id().alias("m")),
        "doc-order",
    )
    part, inside = F.shiftright("m", 33), F.col("m").bitwiseAND((1 << 33) - 1)
    counts = {r.part: r.n for r in spread.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, bases = 1, []
    for p in range(parts):
        bases.append(F.lit(before).cast("long"))
        before += counts.get(p, 0)
    spread = spread.select(F.col("doc_id").alias("o_id"), (F.element_at(F.array(*bases), part.cast("int") + 1) + inside).alias("order"))
    joined = docs.join(spread, same_key(F.col("doc_id"), F.col("o_id")), "left")
    return joined.withColumn("place", F.coalesce("order", F.lit(0))).drop("o_id", "order"), room


def _sets(docs: DataFrame, room: int) -> tuple[DataFrame, Rarity]:
    """A row for each line that has words, stored, and the order of the words."""
    rid = F.col("place") * room + F.col("line_no")
    # Lines without words go when the table is read: as a filter before that, the words would be taken twice.
    taken = _lines(docs).select(rid.alias("rid"), "mark", words(F.col("line")).alias("words"))
    taken = stored(taken, "line-hashes")
    order = rarity(taken)
    keyed = taken.where(F.size("words") > 0).select("rid", "mark", order.keys(F.col("words")).alias("keys"))
    size = F.size("keys")
    kept = (size - F.ceil(size * NUM / DEN) + 1).cast("int")
    end = order.below(COMMON)
    parted = keyed.select(
        "rid",
        "mark",
        "keys",
        size.alias("n"),
        F.xxhash64("keys").alias("fp"),
        F.transform(F.slice("keys", F.lit(1), kept), lambda k: F.hash(k)).alias("prefix"),
        _lower("keys", order.halves(end)).alias("half"),
        _lower("keys", end).alias("rare"),
    )
    bits = _bits(F.slice("keys", F.lit(1), F.col("half"))).alias("bits")
    more = _bits(F.slice("keys", F.col("half") + 1, F.col("rare") - F.col("half"))).alias("more")
    lines = stored(parted.select("rid", "mark", "n", "fp", "prefix", bits, more), "line-words")
    given_back(taken)
    return lines, order


def _lower(keys: str, end: int) -> Column:
    """How many of the keys, which are in order, are of lower classes than ``end``."""
    mark = F.lit(end << 56).cast("long")
    return (F.array_position(F.sort_array(F.array_append(keys, mark)), mark) - 1).cast("int")


def _bits(keys: Column) -> Column:
    """A bitmap of 64 bits of the words; common ones, which tell lines apart the least, are left out of both bitmaps."""

    def put(bits: Column, k: Column) -> Column:
        return bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(63).cast("int")))

    return F.aggregate(keys, F.lit(0).cast("long"), put)


def _bound(x: dict[str, Column], y: dict[str, Column]) -> Column:
    """Whether two lines may be similar and, if the places of a shared word are given, this the first they share.

    What they share then lies from these places on. Similar lines meet at the
    first word they share, so no pair is lost that is asked for at every word.
    """
    n, m = x["n"], y["n"]

    def reached(overlap: Column) -> Column:
        return overlap * (NUM + DEN) >= (n + m) * NUM

    def lacks(one: dict[str, Column], other: dict[str, Column]) -> Column:
        halves = (F.bit_count(one[half].bitwiseAND(F.bitwise_not(other[half]))) for half in ("bits", "more"))
        return sum(halves, F.lit(0))

    fits = F.least(n, m) * DEN >= F.greatest(n, m) * NUM
    if "pos" in x:
        fits = fits & reached(F.least(n - x["pos"], m - y["pos"]))
    return fits & reached(n - lacks(x, y)) & reached(m - lacks(y, x))


def _by_prefix(x: dict[str, Column], y: dict[str, Column]) -> Column:
    """Whether two lines may be similar, by all words of their prefixes.

    Of the prefix that ends at the rarer word, what it shares lies in the other
    prefix too; beyond it, a line shares at most the rest of its words.
    """
    # Two words of a prefix may have one hash.
    shared = F.size(F.array_intersect(x["prefix"], y["prefix"])) + F.size(x["prefix"]) - F.size(F.array_distinct(x["prefix"]))
    rest = F.greatest(x["n"] - F.size(x["prefix"]), y["n"] - F.size(y["prefix"]))
    return (shared + rest) * (NUM + DEN) >= (x["n"] + y["n"]) * NUM


def _of(prefix: str, *names: str) -> dict[str, Column]:
    return {name: F.col(f"{prefix}.{name}") for name in names}


_SIZE_BITS = 31


def _met(sets: DataFrame) -> DataFrame:
    """``rid`` of the sets that may be similar to another one: a shared word among the rarest of both, and the bound.

    A semi join: a set asks at each of its words whether there is a partner, so
    rows stay few however many variants of one line share the word.
    """
    # Place of the word and size in one number: rows are many and small.
    size = F.shiftleft("pos", _SIZE_BITS).bitwiseOR(F.col("n").cast("long")).alias("size")
    rows = sets.select("rid", "n", "bits", "more", F.posexplode("prefix").alias("pos", "word")).withColumn("pos", F.col("pos").cast("long"))
    # None is null; said for both sides of the join alike, they are one shuffle.
    rows = rows.select("word", "rid", "bits", "more", size).dropna()

    def side(name: str) -> dict[str, Column]:
        held = F.col(f"{name}.size")
        of = {"n": held.bitwiseAND((1 << _SIZE_BITS) - 1), "pos": F.shiftright(held, _SIZE_BITS)}
        return of | _of(name, "bits", "more")

    met = (F.col("x.word") == F.col("y.word")) & (F.col("x.rid") != F.col("y.rid"))
    return rows.alias("x").join(rows.alias("y"), met & _bound(side("x"), side("y")), "left_semi").select("rid").distinct()


def _resembling(sets: DataFrame, docs: DataFrame, room: int, order: Rarity) -> DataFrame:
    """``g_fp`` of the sets that reach the similarity with an earlier one, by their words."""
    met = stored(_met(sets).withColumnRenamed("rid", "w_rid"), "lines-met")
    some = possible(sets, "rid", met, parts=2).join(met, same_key(F.col("rid"), F.col("w_rid")), "left_semi")
    lines = _lines(docs).select((F.col("place") * room + F.col("line_no")).alias("l_rid"), "line")
    # The lines travel as text, which packs better than hashes; their words are taken where a line has met its set.
    near = possible(lines, "l_rid", met, parts=2).select("l_rid", "line")
    met_lines = some.join(near, same_key(F.col("rid"), F.col("l_rid")))
    # As the one row of an array, the words are not taken once more for the condition.
    found = met_lines.select("rid", "fp", "n", "bits", "more", "prefix", F.explode(F.array(words(F.col("line")))).alias("words"))
    # Not as an equality, which would take the words before the join to join by them.
    held = found.where(F.xxhash64(order.keys(F.col("words"))).bitwiseXOR(F.col("fp")) == 0)
    # Repeated rows give a set's line several times; one of them is enough.
    held = stored(held.dropDuplicates(["fp"]), "lines-held")
    given_back(met)
    settled = stored(_similar(held, _nearest(held)), "lines-settled")
    searched, large = _searched(held, settled)
    resembling = stored(settled.unionByName(searched), "lines-resembling")
    given_back(settled, large)
    return resembling


def _enough(x: str, y: str) -> Column:
    """Whether two lines share enough words."""
    shared = F.size(F.array_intersect(f"{x}.words", f"{y}.words"))
    return shared * (NUM + DEN) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * NUM


def _nearest(held: DataFrame) -> DataFrame:
    """``(x, y)`` by ``fp``: a line and, of the first lines of its words in each block, the one it surely lacks the fewest words of."""
    rows = held.select("rid", "fp", "n", "bits", "more", F.explode("prefix").alias("word")).dropna()
    block = F.pmod(F.xxhash64("fp"), F.lit(BLOCKS))
    first = rows.groupBy(F.col("word").alias("f_word"), block.alias("block")).agg(F.min(F.struct("rid", "fp", "n", "bits", "more")).alias("y"))
    met = rows.join(first, same_key(F.col("word"), F.col("f_word"))).where(F.col("y.rid") < F.col("rid"))
    x, y = {c: F.col(c) for c in ("n", "bits", "more")}, _of("y", "n", "bits", "more")
    lacks = sum((F.bit_count(x[c].bitwiseXOR(y[c])) for c in ("bits", "more")), F.abs(x["n"] - y["n"]))
    best = met.where(_bound(x, y)).groupBy("fp").agg(F.min(F.struct(lacks.alias("lacks"), F.col("y.fp").alias("fp"))).alias("y"))
    return best.select(F.col("fp").alias("x"), F.col("y.fp").alias("y"))


def _similar(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """``g_fp``: the ``x`` of the pairs that share enough words."""
    held = held.select("fp", "n", "words").dropna()  # none is null; so both joins read one shuffle
    both = pairs.join(held.alias("a"), same_key(F.col("x"), F.col("a.fp"))).join(held.alias("b"), same_key(F.col("y"), F.col("b.fp")))
    return both.where(_enough("a", "b")).select(F.col("x").alias("g_fp"))


def _searched(held: DataFrame, settled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``g_fp`` of the other lines that resemble any earlier one, and the stored table it is read from; ``held`` is given back."""
    rest = held.join(settled, same_key(F.col("fp"), F.col("g_fp")), "left").withColumn("open", F.col("g_fp").isNull().cast("long")).drop("g_fp")
    rest = stored(rest, "lines-open")
    given_back(held)

    def rows(lines: DataFrame, *more: str) -> DataFrame:
        # None is null; said for both sides of a join alike, they are one shuffle. In the order of the table, so that
        # neither side gets its columns put in order.
        return lines.select("rid", "fp", "n", "bits", "more", *more, "open", F.posexplode("prefix").alias("pos", "word")).dropna()

    def asks(a: str, b: str) -> Column:
        # Names both sides, so that it stays in the join and the sides are one shuffle. So does the test of ``fp``, which
        # the joins give out: no set has two rows, and none is earlier than itself.
        asking = F.col(f"{a}.open") + F.col(f"{b}.open") * 0 > 0
        return (F.col(f"{b}.rid") < F.col(f"{a}.rid")) & asking & (F.col(f"{a}.fp") != F.col(f"{b}.fp"))

    word = F.col("a.word") == F.col("b.word")
    a, b = (_of(side, "n", "pos", "bits", "more") for side in "ab")
    may = word & (asks("a", "b") | asks("b", "a")) & _bound(a, b)
    small = rows(rest)
    near = small.alias("a").join(small.alias("b"), may, "left_semi").select(F.col("fp").alias("n_fp")).distinct()
    open_lines, rest = rest, stored(rest.join(near, same_key(F.col("fp"), F.col("n_fp")), "left_semi"), "lines-near")
    given_back(open_lines)
    # Two lines meet at the first of the words they share; only there the words of both are needed.
    before = [F.slice(F.col(f"{side}.prefix"), F.lit(1), F.col(f"{side}.pos")) for side in "ab"]
    wide = rows(rest, "prefix")
    here = may & (F.size(F.array_intersect(*before)) == 0) & _by_prefix(*(_of(side, "n", "prefix") for side in "ab"))
    first = wide.alias("a").join(wide.alias("b"), here, "left_semi")
    first = first.select(F.col("fp").alias("n_fp"), "pos", "word")
    whole = rest.select("rid", "fp", "n", "bits", "more", "open", "words")
    large = stored(first.join(whole, same_key(F.col("n_fp"), F.col("fp"))).drop("n_fp"), "lines-left")
    given_back(rest)
    one, other = large.dropna().alias("a"), large.dropna().alias("b")
    found = one.join(other, word & asks("a", "b") & _bound(a, b) & _enough("a", "b"), "left_semi")
    return found.select(F.col("fp").alias("g_fp")).distinct(), large


def _gone(lines: DataFrame, docs: DataFrame, room: int, order: Rarity) -> DataFrame:
    """``(f_fp, f_rid, f_lines, gone)``, stored: the first line of every set, its number of lines, and whether it resembles an earlier one."""
    least = F.min(F.struct("rid", "n", "prefix", "bits", "more")).alias("r")
    sets = stored(lines.groupBy("fp").agg(least, F.count(F.lit(1)).alias("lines")).select("fp", "lines", "r.*"), "line-sets")
    found = _resembling(sets, docs, room, order)
    gone = sets.join(found, same_key(F.col("fp"), F.col("g_fp")), "left").select(
        F.col("fp").alias("f_fp"), F.col("rid").alias("f_rid"), F.col("lines").alias("f_lines"), F.col("g_fp").isNotNull().alias("gone")
    )
    gone = stored(gone, "lines-gone")
    given_back(sets, found)
    return gone


def _judged(lines: DataFrame, gone: DataFrame) -> DataFrame:
    """The lines to remove: those of a set that is gone, and all but the first of any other."""
    total = gone.agg(F.sum("f_lines")).first()[0] or 0
    # At most FREQUENT sets: their lines, however many, need no shuffle.
    frequent = F.col("f_lines") * FREQUENT > total
    often = F.broadcast(gone.where(frequent))
    rest = lines.join(often, F.col("fp") == F.col("f_fp"), "left_anti").join(gone.where(~frequent), same_key(F.col("fp"), F.col("f_fp")))
    judged = lines.join(often, F.col("fp") == F.col("f_fp")).unionByName(rest)
    return judged.where(F.col("gone") | (F.col("rid") > F.col("f_rid")))


def removed_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with its place and a hash of its text, and ``(place, mark, removed)``: the numbers of lines to remove, from 0."""
    placed, room = _placed(docs.withColumn("mark", F.xxhash64("text")))
    texts = placed.select("place", "mark", "text")
    lines, order = _sets(texts, room)
    gone = _gone(lines, texts, room, order)
    judged = _judged(lines.select("rid", "mark", "fp"), gone)
    numbers = F.sort_array(F.collect_set((F.col("rid") % room).cast("int")))
    removed = judged.groupBy(F.floor(F.col("rid") / room).alias("r_place"), F.col("mark").alias("r_mark")).agg(numbers.alias("removed"))
    removed = stored(removed, "lines-removed")
    given_back(lines, gone)
    return placed, removed


def dedup_report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_removed, removed)`` of every document."""
    placed, removed = removed_lines(docs.select("doc_id", "text"))
    lines = F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0))
    narrow = placed.select("doc_id", "place", "mark", lines.cast("long").alias("n_lines"))
    numbers = F.coalesce("removed", F.array().cast("array<int>"))
    return _joined(narrow, removed).select(
        "doc_id", "n_lines", F.size(numbers).cast("long").alias("n_removed"), numbers.alias("removed")
    )


def dedup_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without the removed lines; documents that lose all their lines go.

    ``n_chars``, if there is such a column, follows the text.
    """
    # The row travels as one column, so that none of its names meets one used here.
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))
    placed, removed = removed_lines(rows)
    kept = F.filter(F.split("text", "\n"), lambda line, k: ~F.coalesce(F.array_contains("removed", k), F.lit(False)))
    whole = F.col("removed").isNull()
    left = _joined(placed, removed).withColumn("kept", kept).where(whole | (F.size("kept") > 0))
    left = left.withColumn("text", F.when(whole, F.col("text")).otherwise(F.array_join("kept", "\n")))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        value = F.col("row").getField(name)
        if name == "n_chars":
            value = F.when(whole, value).otherwise(F.length("text").cast(docs.schema[name].dataType))
        return value.alias(name)

    return left.select(*[column(c) for c in docs.columns])


def _joined(placed: DataFrame, removed: DataFrame) -> DataFrame:
    return placed.join(removed, same_key(F.col("place"), F.col("r_place")) & (F.col("mark") == F.col("r_mark")), "left")
