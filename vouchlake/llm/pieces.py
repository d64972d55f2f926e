"""SentencePiece encoding and decoding in numpy, all words of one length together.

A text is cut into units no piece reaches across: before a run of blanks, and
around characters that are in no longer piece. The distinct units of a chunk of
texts are encoded together, those of one length at a time, and laid out in the
order of the texts. Substrings are found by looking up their hashes in the
sorted hashes of the pieces. Decoding gathers the bytes of the pieces.

A unigram model is cut by Viterbi: for every end position the best sum of
scores over all pieces that end there, with length and piece as back pointer. A
BPE model has no such scores, only an order of merges; the sum of its ranks is
not what it stands for, and its greatest sum differs from the library's result
for most texts. It is cut by merging: of all neighbours in a word that make a
piece, those of the highest score first, the leftmost of equals, in all words at
once. That gives the ids that the library gives.

Defined cases: null text gives null, empty text no ids; a character without a
piece becomes its bytes, or the unknown id where the model has no bytes; the
character the model writes for a blank reads as a blank; ids that are no piece
decode to nothing, bytes that are no text to the replacement character; an
empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from vouchlake.llm.common import free_name
from vouchlake.llm.words import text_chunks, word_hashes
from vouchlake.session import ship_package

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 1_000_000
BLANK = "▁"
UNKNOWN_PENALTY = np.float32(10.0)
_BASE = np.uint64(0x5851F42D4C957F2D)


@dataclass(frozen=True)
class PieceModel:
    keys: np.ndarray  # sorted hashes of the pieces
    ids: np.ndarray  # the pieces' ids, in that order
    scores: np.ndarray
    longest: int  # bytes of the longest piece, a blank counted as one
    unknown_score: np.float32
    unknown_id: int
    byte_ids: np.ndarray | None  # id of each byte
    breaks: np.ndarray  # bytes that are characters in no longer piece
    prefix: bool  # whether texts get a blank in front
    merges: bool  # whether pieces are found by merging
    table: np.ndarray  # bytes of all pieces by id
    starts: np.ndarray


def piece_hashes(pieces: list[bytes]) -> np.ndarray:
    out = np.zeros(len(pieces), dtype=np.uint64)
    for k, piece in enumerate(pieces):
        h = 0
        for b in piece:
            h = (h * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
        out[k] = h
    return out


def load(path: str = MODEL) -> PieceModel:
    """The pieces of a model file; it must leave texts as they are but for blanks."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as file:
        proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    kinds = sentencepiece_model_pb2.TrainerSpec
    if proto.trainer_spec.model_type not in (kinds.UNIGRAM, kinds.BPE):
        raise ValueError("only unigram and BPE models can be used")
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only models that keep texts as they are can be used")
    size = sp.piece_size()
    plain = [k for k in range(size) if not (sp.is_unknown(k) or sp.is_control(k) or sp.is_byte(k) or sp.is_unused(k))]
    written = {k: sp.id_to_piece(k).replace(BLANK, " ") for k in plain}
    if any(" " in w.lstrip(" ") for w in written.values()):
        raise ValueError("a piece reaches across a blank")
    breaks = np.zeros(256, dtype=bool)
    breaks[:128] = True
    for w in written.values():
        if len(w) > 1:
            breaks[[ord(c) for c in w if ord(c) < 128]] = False
    breaks[32] = False
    keys = piece_hashes([written[k].encode() for k in plain])
    order = np.argsort(keys)
    scores = np.array([sp.get_score(k) for k in plain], dtype=np.float32)
    byte_ids = None
    if any(sp.is_byte(k) for k in range(size)):
        byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
    content = [written[k].encode() if k in written else b"" for k in range(size)]
    if byte_ids is not None:
        for b, k in enumerate(byte_ids.tolist()):
            content[k] = bytes([b])
    content[sp.unk_id()] = " ⁇ ".encode()
    return PieceModel(
        keys[order], np.array(plain, dtype=np.int32)[order], scores[order], max(len(w.encode()) for w in written.values()),
        scores.min() - UNKNOWN_PENALTY, sp.unk_id(), byte_ids, breaks, spec.add_dummy_prefix, proto.trainer_spec.model_type == kinds.BPE,
        np.frombuffer(b"".join(content), dtype=np.uint8), np.cumsum([0, *map(len, content)]),
    )


def unit_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, row)`` of the units of a chunk."""
    if not len(data):
        return (np.zeros(0, dtype=np.int64),) * 3
    blank, alone = data == 32, breaks[data]
    first = alone.copy()
    first[1:] |= alone[:-1] | (blank[1:] & ~blank[:-1])
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(first)
    return start, np.append(start[1:], len(data)), np.searchsorted(offsets[1:], start, side="right")


def _best_cuts(units: np.ndarray, m: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Back pointers, length and id, of units of one length; id -1 for an unknown character."""
    n, length = units.shape
    sums, power = _prefix_sums(units, min(length, m.longest))
    inside = (units & 0xC0) == 0x80  # bytes that continue a character
    best = np.full((n, length + 1), -np.inf, dtype=np.float32)
    best[:, 0] = 0
    back, piece = np.zeros((n, length + 1), dtype=np.int32), np.full((n, length + 1), -1, dtype=np.int32)
    every = np.arange(n)
    character = np.zeros(n, dtype=np.int32)  # bytes since the last character began
    for end in range(1, length + 1):
        character = np.where(inside[:, end - 1], character + 1, 1)
        whole = np.ones(n, dtype=bool) if end == length else ~inside[:, end]
        sizes = np.arange(min(end, max(m.longest, 4)), 0, -1)  # the longest first: it wins a tie
        probed = sizes[sizes <= m.longest]
        found = sums[:, end, None] - sums[:, end - probed] * power[probed]
        at, hit = _found(m, found)
        gain = np.full((n, len(sizes)), -np.inf, dtype=np.float32)
        gain[:, len(sizes) - len(probed) :] = np.where(hit, m.scores[at], np.float32(-np.inf))
        # A character that is no piece itself may be taken as unknown.
        column = len(sizes) - character
        lone = whole & (character <= len(sizes))
        rows = every[lone]
        rows = rows[gain[rows, column[rows]] == -np.inf]
        gain[rows, column[rows]] = m.unknown_score
        total = best[:, end - sizes] + gain
        pick = np.argmax(total, axis=1)
        best[:, end] = total[every, pick]
        back[:, end] = sizes[pick]
        place = pick - (len(sizes) - len(probed))
        known = (place >= 0) & hit[every, np.maximum(place, 0)]
        piece[:, end] = np.where(known, m.ids[at[every, np.maximum(place, 0)]], -1)
    return back, piece


def _merged_cuts(units: np.ndarray, m: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the boundaries that are left in units of one length after all merges."""
    n, length = units.shape
    sums, power = _prefix_sums(units, length)
    every = np.arange(n)[:, None]
    alive = np.ones((n, length + 1), dtype=bool)
    alive[:, 1:length] = (units[:, 1:] & 0xC0) != 0x80
    # Neighbours of each boundary among those alive.
    place = np.where(alive, np.arange(length + 1), 0)
    before = np.zeros_like(place)
    before[:, 1:] = np.maximum.accumulate(place, axis=1)[:, :-1]
    place = np.where(alive, np.arange(length + 1), length)
    after = np.full_like(place, length)
    after[:, :-1] = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, 1:]

    def scores(rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        at, hit = _found(m, sums[rows, last] - sums[rows, first] * power[last - first])
        return np.where(hit, m.scores[at], np.float32(-np.inf))

    gain = np.full((n, length + 1), -np.inf, dtype=np.float32)
    inner = alive.copy()
    inner[:, [0, length]] = False
    rows, cols = np.nonzero(inner)
    gain[rows, cols] = scores(rows, before[rows, cols], after[rows, cols])
    rows = every[:, 0]
    while True:
        pick = np.argmax(gain[rows], axis=1)
        going = gain[rows, pick] > -np.inf
        rows, pick = rows[going], pick[going]
        if not len(rows):
            return np.nonzero(alive)
        alive[rows, pick] = False
        gain[rows, pick] = -np.inf
        low, high = before[rows, pick], after[rows, pick]
        after[rows, low], before[rows, high] = high, low
        left, right = low > 0, high < length
        r, b = rows[left], low[left]
        gain[r, b] = scores(r, before[r, b], high[left])
        r, b = rows[right], high[right]
        gain[r, b] = scores(r, low[right], after[r, b])


def _prefix_sums(units: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all beginnings of units, and the powers that cut one from another."""
    sums = np.zeros((len(units), units.shape[1] + 1), dtype=np.uint64)
    for k in range(units.shape[1]):
        sums[:, k + 1] = sums[:, k] * _BASE + units[:, k] + np.uint64(1)
    power = np.full(longest + 1, _BASE)
    power[0] = 1
    return sums, np.multiply.accumulate(power)


def _found(m: PieceModel, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places among the pieces, and whether there is one."""
    at = np.minimum(np.searchsorted(m.keys, hashes), len(m.keys) - 1)
    return at, m.keys[at] == hashes


def _viterbi_spans(units: np.ndarray, m: PieceModel) -> tuple[np.ndarray, ...]:
    back, ids = _best_cuts(units, m)
    n, length = units.shape
    out = []
    at, rows = np.full(n, length), np.arange(n)
    while len(rows):
        step = back[rows, at]
        out.append((rows, at - step, step, ids[rows, at]))
        at = at - step
        rows, at = rows[at > 0], at[at > 0]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _merged_spans(units: np.ndarray, m: PieceModel) -> tuple[np.ndarray, ...]:
    rows, cols = _merged_cuts(units, m)
    last = np.append(rows[1:] != rows[:-1], True)
    first = np.flatnonzero(~last)
    row, start = rows[first], cols[first]
    size = cols[first + 1] - start
    sums, power = _prefix_sums(units, units.shape[1])
    at, hit = _found(m, sums[row, start + size] - sums[row, start] * power[size])
    return row, start, size, np.where(hit, m.ids[at], -1)


def encode_units(data: np.ndarray, start: np.ndarray, end: np.ndarray, m: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, offsets)`` of units."""
    lengths = end - start
    parts = []
    for length in np.unique(lengths).tolist():
        here = np.flatnonzero(lengths == length)
        units = data[start[here, None] + np.arange(length)].astype(np.uint64)
        row, first, size, piece = (_merged_spans if m.merges else _viterbi_spans)(units, m)
        parts.append((here[row], start[here[row]] + first, size, piece))
    if not parts:
        return np.zeros(0, dtype=np.int32), np.zeros(len(start) + 1, dtype=np.int64)
    unit, first, size, piece = map(np.concatenate, zip(*parts, strict=True))
    order = np.lexsort((first, unit))
    unit, first, size, piece = unit[order], first[order], size[order], piece[order].astype(np.int32)
    unknown = piece < 0
    if m.byte_ids is None:
        piece[unknown] = m.unknown_id
        times = np.ones(len(piece), dtype=np.int64)
    else:
        times = np.where(unknown, size, 1)
    ids = np.repeat(piece, times)
    if m.byte_ids is not None and unknown.any():
        inside = np.arange(len(ids)) - np.repeat(np.cumsum(times) - times, times)
        bytewise = np.repeat(unknown, times)
        ids[bytewise] = m.byte_ids[data[(np.repeat(first, times) + inside)[bytewise]]]
    counts = np.bincount(unit, weights=times, minlength=len(start)).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(counts)])


def _gather(values: np.ndarray, starts: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values one after another, and the length of each."""
    counts = starts[picked + 1] - starts[picked]
    before = np.cumsum(counts) - counts
    return values[np.repeat(starts[picked] - before, counts) + np.arange(int(counts.sum()))], counts


def _distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One unit of each content, and which of these every unit equals; hashes propose, bytes decide."""
    _, at, same = np.unique(word_hashes(data, start, end), return_index=True, return_inverse=True)
    size = end - start
    differs = size != size[at[same]]
    alike = np.flatnonzero(~differs)
    if len(alike):
        begin = np.cumsum(size[alike]) - size[alike]
        inside = np.arange(int(size[alike].sum())) - np.repeat(begin, size[alike])
        other = data[np.repeat(start[alike], size[alike]) + inside] != data[np.repeat(start[at[same[alike]]], size[alike]) + inside]
        differs[alike] = np.add.reduceat(other, begin, dtype=np.int64) > 0 if len(other) else False
    alone = np.flatnonzero(differs)
    same[alone] = len(at) + np.arange(len(alone))
    return np.concatenate([at, alone]), same


def encode_texts(texts: pa.Array, m: PieceModel) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, ids, offsets)`` for chunks of texts that have their blank in front."""
    for row, last, data, offsets in text_chunks(texts, CHUNK_BYTES):
        start, end, owner = unit_spans(data, offsets, m.breaks)
        at, same = _distinct(data, start, end)
        ids, starts = encode_units(data, start[at], end[at], m)
        ids, counts = _gather(ids, starts, same)
        per_row = np.bincount(owner, weights=counts, minlength=last - row).astype(np.int64)
        yield row, last, ids, np.concatenate([[0], np.cumsum(per_row)])


def decode_ids(ids: np.ndarray, offsets: np.ndarray, m: PieceModel) -> pa.Array:
    """Texts of rows of ids."""
    ids = np.where((ids >= 0) & (ids < len(m.starts) - 1), ids, 1)  # control ids hold nothing
    data, counts = _gather(m.table, m.starts, ids.astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(counts)])[offsets]
    first = ends[:-1].copy()
    if m.prefix and len(data):
        led = (ends[1:] > first) & (data[np.minimum(first, len(data) - 1)] == 32)
        keep = np.ones(len(data), dtype=bool)
        keep[first[led]] = False
        data = data[keep]
        ends = ends - np.concatenate([[0], np.cumsum(led)])
    buffers = [None, pa.py_buffer(np.ascontiguousarray(ends, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    out = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, buffers)
    try:
        out.validate(full=True)
    except pa.ArrowInvalid:
        raw = data.tobytes()
        out = pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)], pa.large_string())
    return out.cast(pa.string())


def encode(docs: DataFrame, m: PieceModel | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_ids`` and ``round_trip`` in place of the text: its ids, their number, whether they decode to it."""
    ship_package(docs.sparkSession)
    m = m or load()
    kept = [f for f in docs.schema if f.name not in (text, "ids", "n_ids", "round_trip")]
    names = [f.name for f in kept]
    given = free_name(docs, "given")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(given)
            for row, last, ids, offsets in encode_texts(column, m):
                part = column.slice(row, last - row)
                decoded = decode_ids(ids, offsets, m)
                bare = pa.compute.utf8_slice_codeunits(part, 1) if m.prefix else part
                kept_text = pa.compute.equal(bare.cast(pa.string()), decoded)
                null = pa.compute.is_null(part).to_numpy(zero_copy_only=False)
                listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids), mask=pa.array(null))
                number = pa.array(np.diff(offsets), pa.int64(), mask=null)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(row, last - row) for c in names], listed, number, kept_text],
                    names=[*names, "ids", "n_ids", "round_trip"],
                )

    plain = F.translate(F.col(f"`{text}`"), BLANK, " ")
    if m.prefix:
        plain = F.when(plain == "", plain).otherwise(F.concat(F.lit(" "), plain))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return docs.select(*[F.col(f"`{n}`") for n in names], plain.alias(given)).mapInArrow(
        encoded, f"{schema}ids array<int>, n_ids long, round_trip boolean"
    )


def decode(rows: DataFrame, m: PieceModel | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` with ``text`` in place of the ids."""
    ship_package(rows.sparkSession)
    m = m or load()
    kept = [f for f in rows.schema if f.name not in (ids, "text")]
    names = [f.name for f in kept]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids).cast(pa.large_list(pa.int32()))
            flat = pa.compute.fill_null(lists.flatten(), 1).to_numpy(zero_copy_only=False)
            sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = decode_ids(flat, np.concatenate([[0], np.cumsum(sizes)]), m)
            texts = pa.compute.if_else(pa.compute.is_null(lists), pa.scalar(None, pa.string()), texts)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], texts], names=[*names, "text"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return rows.mapInArrow(decoded, f"{schema}text string") if names else rows.mapInArrow(decoded, "text string")
