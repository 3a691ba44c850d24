"""Whole texts of Arrow batches as numpy arrays: words, their hashes, n-grams.

Words are the runs of bytes other than ASCII white space (the contracts' words,
as UTF-8 never uses those bytes inside a character).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one block of rows holds (a longer text is a block of its own).
BLOCK = 1 << 20
#: Bytes hashed at a time, so that a very long text needs no wide arrays of its size.
PIECE = 1 << 18

_ODD = 0x9E3779B97F4A7C15  # fixed value: golden-ratio multiplier


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python process: functions that
    travel by value bring new module globals with every task."""
    return sys.__dict__.setdefault("_martlet_cache", {}).setdefault(name, {})


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 bits (splitmix)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _table(name: str) -> np.ndarray:
    tables = process_cache("words")
    if not tables:
        powers = np.full(PIECE + 1, _ODD, np.uint64)
        inverse = np.full(PIECE + 1, pow(_ODD, -1, 1 << 64), np.uint64)
        powers[0] = inverse[0] = 1
        space = np.zeros(256, bool)
        space[[32, 9, 10, 11, 12, 13]] = True
        tables.update(powers=np.cumprod(powers), inverse=np.cumprod(inverse), space=space,
                      byte=mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD)))
    return tables[name]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
    if column.null_count:
        column = pc.fill_null(column, empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32) if offsets is not None and offsets.size else np.zeros(1, np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with up to
    ``size`` bytes, one row at least; offsets start at 0."""
    data, offsets = string_buffers(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray, inner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and the total) of all words; no
    word reaches from one row into the next. ``inner``: which of the 256 bytes
    belong to a word (default: all but white space)."""
    inside = ~_table("space")[data] if inner is None else inner[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    first[edges] |= inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = edges[edges > 0] - 1
    last[before] |= inside[before]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, by prefix sums of a polynomial that wrap
    around; spans are in order and a span longer than a piece is cut into parts."""
    out = np.empty(len(starts), np.uint64)
    powers, inverse, byte = _table("powers"), _table("inverse"), _table("byte")
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
            lo, hi = int(starts[i]), int(ends[j - 1])
            if hi - lo > PIECE:  # one very long word
                h = np.uint64(0)
                for k in range(lo, hi, PIECE):
                    part = byte[data[k:min(hi, k + PIECE)]]
                    h = (mix(np.array([h + np.uint64(1)])) * np.uint64(_ODD) + np.array([(part * powers[:len(part)]).sum()]))[0]
                out[i] = h
            else:
                sums = np.zeros(hi - lo + 1, np.uint64)
                np.cumsum(byte[data[lo:hi]] * powers[:hi - lo], out=sums[1:])
                s = starts[i:j] - lo
                out[i:j] = (sums[ends[i:j] - lo] - sums[s]) * inverse[s]
            i = j
        return mix(out + (ends - starts).astype(np.uint64))


def ngrams(h: np.ndarray, n: int, odd: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hashes of every ``n`` consecutive values (empty if there are fewer)."""
    k = len(h) - n + 1
    if k <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = h[:k].copy()
        for j in range(1, n):
            out *= np.uint64(odd)
            out += h[j:j + k]
        return mix(out)


def text_pieces(text: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """Consecutive pieces of about ``size`` bytes, each ending behind white
    space, so that no word is cut; their concatenation is the text."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(s, at, at + size) for s in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        if cut < 0:
            found = [x for s in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (x := text.find(s, at + size)) >= 0]
            if not found:
                break
            cut = min(found)
        yield text[at:cut + 1]
        at = cut + 1
    if at < len(text) or not text:
        yield text[at:]
