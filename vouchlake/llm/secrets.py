"""Secret scan: known shapes, and sliding-window entropy over candidate strings.

Three base kinds are patterns. Two more come from entropy: a candidate is a run
of at least one window of a character class (hexadecimal, base 64). A window
slides over it; the count of each character of the class goes up as it enters
and down as it leaves, and the sum of ``c * log2(c)`` is kept along, so each
step costs two updates whatever the window. Where a window reaches the class's
entropy, the span from the first such window to the last is reported, unless
the run is on the allow list (identifiers, placeholders). Windows must hold
digits and letters, as prose written without blanks comes close in entropy.

All of it is DataFrame expressions over one row; nothing is shuffled.

Defined cases: null text counts as empty; a text without spans has the digest
of the empty string and an empty list; spans of one kind do not overlap, spans
of different kinds may; positions are code points, the end is exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds. The pattern, the group whose length counts, and the least length.
BASE = {
    "assign": (
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 18),
    "hex": (r"([0-9a-f]{16,})", 1, 16),
}
# Runs that look random and are no secrets.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"(?:sha1|sha256|sha384|sha512|md5)[-_=/].*",
    r"[0-9]+(?:[-_/][0-9]+)+",
    r".*(?:EXAMPLE|example|xxxx|XXXX).*",
)


@dataclass(frozen=True)
class CharacterClass:
    kind: str
    pattern: str  # of one character
    alphabet: str  # digits first
    window: int
    bits: float


CLASSES = (
    CharacterClass("entropy_hex", "[0-9a-f]", "0123456789abcdef", 16, 2.75),
    CharacterClass(
        "entropy_base64",
        r"[A-Za-z0-9+/_=-]",
        "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-",
        20,
        3.6,
    ),
)
_SPANS = "array<struct<start:int,end:int,hit:string>>"


def _located(text: Column, pattern: str, group: int) -> Column:
    """Matches as ``(start, end, hit)``: what lies between them tells where they are."""
    hits = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("hit"),
        F.split(text, pattern, -1).alias("gap"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        spans = F.when(x["whole"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span)))
        return F.struct(end.alias("at"), spans.alias("spans"))

    found = F.aggregate(hits, zero, step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column, kind: str) -> Column:
    pattern, group, least = BASE[kind]
    return F.filter(_located(text, pattern, group), lambda x: F.length(x["hit"]) >= least)


def _hot_part(run: Column, c: CharacterClass) -> Column:
    """``(first, last)`` end position of a window over the bound; nulls where there is none."""
    weight = F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(c.window + 1)])
    codes = F.transform(F.split(run, ""), lambda ch: F.instr(F.lit(c.alphabet), ch))
    zero = F.struct(
        F.array_repeat(F.lit(0), len(c.alphabet)).alias("counts"),
        F.lit(0.0).alias("s"),
        F.lit(0).alias("digits"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )
    # Each step sees the character that enters and the one that leaves (0 at the start).
    leaving = F.concat(F.array_repeat(F.lit(0), c.window), codes)
    moves = F.filter(
        F.arrays_zip(codes.alias("new"), leaving.alias("old"), F.sequence(F.lit(1), F.length(run)).alias("at")),
        lambda m: m["new"].isNotNull(),
    )

    def at(counts: Column, code: Column) -> Column:
        return F.when(code > 0, F.get(counts, code - 1)).otherwise(F.lit(0))

    def step(acc: Column, m: Column) -> Column:
        same = m["new"] == m["old"]
        up, down = at(acc["counts"], m["new"]), at(acc["counts"], m["old"])
        counts = F.transform(
            acc["counts"],
            lambda n, k: n + (k + 1 == m["new"]).cast("int") - (k + 1 == m["old"]).cast("int"),
        )
        change = F.when(same, F.lit(0.0)).otherwise(
            F.get(weight, up + 1)
            - F.get(weight, up)
            - F.when(m["old"] > 0, F.get(weight, down) - F.get(weight, down - 1)).otherwise(F.lit(0.0))
        )
        digits = acc["digits"] + m["new"].between(1, 10).cast("int") - m["old"].between(1, 10).cast("int")
        return F.struct(
            F.when(same, acc["counts"]).otherwise(counts).alias("counts"),
            (acc["s"] + change).alias("s"),
            digits.alias("digits"),
            acc["first"].alias("first"),
            acc["last"].alias("last"),
            m["at"].alias("at"),
        )

    def marked(acc: Column) -> Column:
        entropy = math.log2(c.window) - acc["s"] / c.window
        hot = (
            (acc["at"] >= c.window)
            & (entropy >= c.bits - 1e-9)
            & acc["digits"].between(1, c.window - 1)
        )
        return F.struct(
            acc["counts"].alias("counts"),
            acc["s"].alias("s"),
            acc["digits"].alias("digits"),
            F.when(hot, F.coalesce(acc["first"], acc["at"])).otherwise(acc["first"]).alias("first"),
            F.when(hot, acc["at"]).otherwise(acc["last"]).alias("last"),
        )

    def named(acc: Column, m: Column) -> Column:
        # An array of one gives the step's result a name, so it is worked out once.
        return F.transform(F.array(step(acc, m)), marked)[0]

    return F.aggregate(moves, zero, named, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def entropy_spans(text: Column, c: CharacterClass) -> Column:
    """Spans of runs whose windows reach the class's entropy."""
    runs = F.filter(
        _located(text, f"({c.pattern}{{{c.window},}})", 1),
        lambda r: ~r["hit"].rlike(f"^(?:{'|'.join(ALLOWED)})$"),
    )
    hot = F.transform(
        runs, lambda r: F.struct(r["start"].alias("at"), r["hit"].alias("hit"), _hot_part(r["hit"], c).alias("hot"))
    )
    return F.transform(
        F.filter(hot, lambda r: r["hot"]["first"].isNotNull()),
        lambda r: F.struct(
            (r["at"] + r["hot"]["first"] - c.window).alias("start"),
            (r["at"] + r["hot"]["last"]).alias("end"),
            F.substring(r["hit"], r["hot"]["first"] - c.window + 1, r["hot"]["last"] - r["hot"]["first"] + c.window).alias(
                "hit"
            ),
        ),
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, <one array of (start, end, hit) for each kind>)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = [base_spans(text, kind).alias(kind) for kind in BASE]
    return docs.select("doc_id", *kinds, *[entropy_spans(text, c).alias(c.kind) for c in CLASSES])


def span_list(kinds: list[str]) -> Column:
    """``kind:start:end`` of the columns' spans by start, then in the order of ``kinds``."""

    def placed(k: int, kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), F.lit(kind).alias("kind")
            ),
        )

    every = F.concat(*[placed(k, kind) for k, kind in enumerate(kinds)])
    return F.array_join(
        F.transform(
            F.array_sort(every), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
