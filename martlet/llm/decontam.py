"""Benchmark decontamination by q-gram lemma filtering.

Items and documents are normalised alike (lower case, letters and digits, single
spaces), and measured in characters. An item is cut into overlapping segments; a
segment of length m with up to e edits in a document still shares at least
m - q + 1 - q*e of its q-grams with it, all near one diagonal. So the shared q-grams are counted in diagonal
bands that overlap by e, and bands that reach the bound are verified by banded
alignment. Documents that hold a segment of an item within its edit budget are
reported with the item. Segments start every e + 1 characters, so what a passage
lacks of one at its ends is paid as edits: a verbatim passage of m - e characters
(60, fewer in scripts of several bytes a letter) is found wherever it begins.

The benchmark is the stated query set: it is taken in blocks of bounded size,
each held against all documents (one pass a block, whose result is written before
the next block's index is built). Defined results: null or
empty texts hold nothing; items of fewer characters than a q-gram must occur
exactly, and not as a part of a longer word (scripts without spaces: anywhere);
items without a letter or digit never match; rows without item_id or text are no
items; rows that repeat an item_id are one item; a repeated document row repeats
its pairs; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.llm.registry import read_table, register
from martlet.llm.words import mix, string_buffers
from martlet.session import cut_lineage

#: Characters of a q-gram and of a segment; edits of a segment's characters;
#: width of a diagonal band without its overlap.
GRAM, SEGMENT, EDITS, BAND = 10, 64, 0.075, 16
#: Characters of the short q-grams that candidates are tested by, and their buckets.
TEST, BUCKETS = 4, 1024
#: Parts in which the segments are counted, since many lie over one another.
TURNS = 4
#: Bytes of item texts in a block, and of document texts searched at a time.
BLOCK, PART = 1 << 20, 1 << 20
SLOTS = 22  # bits of the table that drops most q-grams of no item
#: Pairs of q-gram hits and places, and candidate bands, that are held at a time.
PAIRS, CASES = 1 << 20, 1 << 12
#: Scripts from here on write words without spaces between them.
UNSPACED = 0x2E80

_ODD = 0x9E3779B97F4A7C15  # fixed value: golden-ratio multiplier

# Fixed value: ASCII bytes that are neither letters nor digits count as spaces.
_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def normalised(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_SPACED).split())


def characters(text: bytes) -> np.ndarray:
    """Code points of a normalised text."""
    return np.frombuffer(text, np.uint8) if text.isascii() else np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hashes of the q-grams at every character."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = data[:n].astype(np.uint64)
        for j in range(1, gram):
            out *= np.uint64(_ODD)
            out += data[j:j + n]
        return mix(out)


def _buckets(data: np.ndarray) -> np.ndarray:
    return (gram_hashes(data, TEST) % np.uint64(BUCKETS)).astype(np.int16)


class Index(NamedTuple):
    """Q-grams of a block of items, whose texts stand one behind the other."""

    text: np.ndarray      # normalised items, each behind GRAM line feeds
    items: np.ndarray     # item_id of each segment
    turns: np.ndarray     # part in which the segment is counted
    starts: np.ndarray    # first character of each segment
    lengths: np.ndarray
    edits: np.ndarray
    needed: np.ndarray    # shared q-grams that the lemma asks for
    hashes: np.ndarray    # sorted q-gram hashes, with their places
    places: np.ndarray
    table: np.ndarray     # whether any q-gram has these upper bits
    least: int            # fewest shared q-grams that any segment asks for
    short: dict[int, list[tuple[int, np.ndarray]]]  # items of fewer characters than a q-gram, by length
    tests: np.ndarray     # bucket of the short q-gram at each character


def build_index(items: list[tuple[int, str]], gram: int = GRAM) -> Index | None:
    """Index of the items; None if none has a letter or digit."""
    gap, parts, segments, short, at = np.full(gram, 10, np.uint8), [], [], {}, 0
    for item, text in items:
        raw = normalised(text)
        body = characters(raw)
        if not len(body):
            continue
        if len(body) < gram:
            short.setdefault(len(body), []).append((item, body))
            continue
        at += gram
        parts += [gap, body]
        sizes = {SEGMENT}
        if 2 * len(raw) >= 3 * len(body):  # letters of several bytes say more: as many as fill a segment's bytes
            sizes.add(max(gram, SEGMENT * len(body) // len(raw)))
        for m in sorted({min(x, len(body)) for x in sizes}):
            e = min(int(EDITS * m), (m - gram) // gram)
            last = len(body) - m
            for i, lo in enumerate(sorted({*range(0, last, e + 1), last})):
                segments.append((item, i % TURNS, at + lo, m, e, m - gram + 1 - gram * e))
        at += len(body)
    if not segments and not short:
        return None
    text = np.concatenate([*parts, gap])
    hashes = gram_hashes(text, gram)
    cols = [np.array(c, np.int64) for c in zip(*segments)] or [np.zeros(0, np.int64)] * 6
    places = np.flatnonzero(text != 10)  # gaps alone hold line feeds
    places = places[places + gram <= len(text)]
    places = places[text[places + gram - 1] != 10]
    order = np.argsort(hashes[places], kind="stable")
    places = places[order]
    hashes = hashes[places]
    table = np.zeros(1 << SLOTS, bool)
    table[(hashes >> np.uint64(64 - SLOTS)).astype(np.int64)] = True
    order = np.argsort(cols[2], kind="stable")
    cols = [c[order] for c in cols]
    return Index(text, *cols, hashes, places, table, int(cols[5].min(initial=SEGMENT)), short, _buckets(text))


def banded_edits(pattern: np.ndarray, text: np.ndarray, low: int, high: int, limit: int) -> int:
    """Least edits that turn ``pattern`` into a stretch of ``text``, over
    alignments whose diagonals (text minus pattern place) stay within low..high;
    ``limit + 1`` if there are more than ``limit``."""
    one = np.array([0])
    return int(banded_edits_of(pattern[None, :], text, one, one + len(text), one + low, high - low + 1, limit)[0])


def banded_edits_of(patterns: np.ndarray, text: np.ndarray, lo: np.ndarray, hi: np.ndarray, diagonal: np.ndarray,
                    width: int, limit: int) -> np.ndarray:
    """The same for many patterns (rows) of one length, each against its stretch
    lo..hi of ``text`` and the ``width`` diagonals from its ``diagonal`` on. All
    advance together by a character; those beyond the limit are left behind."""
    out = np.full(len(patterns), limit + 1, np.int64)
    live, steps = np.arange(len(patterns)), np.arange(width)
    row = np.zeros((len(patterns), width), np.int64)  # the stretch may begin on any diagonal
    for i in range(patterns.shape[1]):
        place = diagonal[live, None] + i + steps
        there = (place >= 0) & (place < (hi - lo)[live, None])
        at = np.where(there, place + lo[live, None], 0)
        same = there & (text[at] == patterns[live, i, None])
        new = row + ~same
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        within = row.min(axis=1) <= limit
        if not within.all():
            live, row = live[within], row[within]
            if not len(live):
                return out
    out[live] = row.min(axis=1)
    return out


def _dense(hits: np.ndarray, least: int, reach: int) -> np.ndarray:
    """Hits that lie in some stretch of ``reach`` characters with ``least`` hits."""
    if len(hits) < least:
        return hits[:0]
    ok = np.flatnonzero(hits[least - 1:] - hits[:len(hits) - least + 1] <= reach)
    step = np.zeros(len(hits) + 1, np.int64)
    np.add.at(step, ok, 1)
    np.add.at(step, ok + least, -1)
    return hits[np.cumsum(step[:-1]) > 0]


def leaks(index: Index, data: np.ndarray, edges: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, item, edits) of the rows that hold a segment of an item. ``data``:
    characters of normalised texts, each with GRAM line feeds behind; ``edges``: their starts."""
    hashes = gram_hashes(data)
    hits = np.flatnonzero(index.table[(hashes >> np.uint64(64 - SLOTS)).astype(np.int64)])
    reach = SEGMENT + int(EDITS * SEGMENT)
    hits = _dense(hits, index.least, reach)
    lo = np.searchsorted(index.hashes, hashes[hits], "left")
    hi = np.searchsorted(index.hashes, hashes[hits], "right")
    found = hi > lo
    hits, lo, hi = hits[found], lo[found], hi[found]
    n = hi - lo
    # A frequent q-gram has many places: pairs are made for a bounded number of hits at a time.
    out: dict[tuple[int, int], int] = {}
    row = np.searchsorted(edges, hits, "right") - 1
    first, total, tests = 0, np.concatenate([[0], np.cumsum(n)]), _buckets(data)
    while first < len(hits):
        end = max(first + 1, int(np.searchsorted(total, total[first] + PAIRS, "right")) - 1)
        if end < len(hits):  # parts overlap by what a segment can reach, so that one of them holds all of its hits
            end = max(end, int(np.searchsorted(hits, hits[first] + 2 * reach, "right")))
        for turn in range(TURNS):
            _pairs(index, turn, data, tests, edges, hits[first:end], lo[first:end], n[first:end], row[first:end], out)
        if end >= len(hits):
            break
        first = int(np.searchsorted(hits, hits[end - 1] - reach, "left"))
    for length, items in index.short.items():
        _short(length, items, data, edges, out)
    return [(r, i, e) for (r, i), e in sorted(out.items())]


def _short(length: int, items: list[tuple[int, np.ndarray]], data, edges, out) -> None:
    """Exact matches of items of ``length`` characters that do not cut a word."""
    if len(data) < length:
        return
    spaced = (data != 32) & (data != 10) & (data < UNSPACED)
    joined = np.concatenate([[False], spaced[:-1] & spaced[1:], [False]])  # whether a word goes on from the place before
    hashes = gram_hashes(data, length)
    wanted = np.concatenate([gram_hashes(body, length) for _, body in items])
    places = np.flatnonzero(np.isin(hashes, wanted))
    for item, body in items if len(places) else ():
        at = places[hashes[places] == gram_hashes(body, length)[0]]
        at = at[(data[at[:, None] + np.arange(length)] == body).all(axis=1) & ~joined[at] & ~joined[at + length]]
        for r in np.unique(np.searchsorted(edges, at, "right") - 1):
            out[int(r), item] = 0


def _pairs(index: Index, turn: int, data, tests, edges, hits, lo, n, row, out) -> None:
    """Counts the shared q-grams of each row, segment of this turn and band, and
    verifies; pairs of a row and an item that were found before are left out."""
    if not len(hits):
        return
    at = np.repeat(np.arange(len(hits)), n)
    place = index.places[np.repeat(lo, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
    # A place lies in the last of the turn's segments that starts there or before, and maybe in some ahead of it.
    mine = np.flatnonzero(index.turns == turn)
    if not len(mine):
        return
    begins = index.starts[mine]
    overlap = int((np.arange(len(mine)) - np.searchsorted(begins, begins - (SEGMENT - GRAM), "left")).max()) + 1
    last = np.searchsorted(begins, place, "right") - 1
    if turn and out:
        names, owner = np.unique(index.items, return_inverse=True)
        spot = np.searchsorted(names, [i for _, i in out])
        known = [r * len(names) + int(s) for (r, _), s in zip(out, spot)]
        new = ~np.isin(row[at] * len(names) + owner[mine[last]], known)
        at, place, last = at[new], place[new], last[new]
    cases = []
    for back in range(overlap):
        ok = last >= back
        seg = mine[last - back]
        ok[ok] &= place[ok] + GRAM <= index.starts[seg[ok]] + index.lengths[seg[ok]]
        diagonal = hits[at[ok]] - place[ok] + len(index.text)
        seg, hit = seg[ok], at[ok]
        band = diagonal // BAND
        cases.append((hit, seg, band))
        over = diagonal % BAND < index.edits[seg]  # the overlap belongs to the band before, too
        cases.append((hit[over], seg[over], band[over] - 1))
    hit, seg, band = (np.concatenate(x) for x in zip(*cases))
    order = np.lexsort((hit, band, seg, row[hit]))
    hit, seg, band = hit[order], seg[order], band[order]
    r = row[hit]
    new = np.concatenate([[True], (r[1:] != r[:-1]) | (seg[1:] != seg[:-1]) | (band[1:] != band[:-1])]) if len(hit) else np.zeros(0, bool)
    groups = np.flatnonzero(new)
    distinct = np.concatenate([[True], hit[1:] != hit[:-1]]) | new if len(hit) else new
    shared = np.add.reduceat(distinct.astype(np.int64), groups) if len(groups) else np.zeros(0, np.int64)
    good = groups[shared >= index.needed[seg[groups]]]
    _verify(index, data, tests, edges, r[good], seg[good], band[good], out)


def _verify(index: Index, data, tests, edges, row, seg, band, out) -> None:
    """Verifies candidates (in order) until each pair of a row and an item is
    found: rounds take one, two, four ... candidates of every open pair, and
    align those of a round together."""
    likely = np.concatenate([_likely(index, tests, row[i:i + CASES], seg[i:i + CASES], band[i:i + CASES]) for i in range(0, len(row), CASES)] or [[]])
    row, seg, band = (x[likely.astype(bool)] for x in (row, seg, band))
    owner = index.items[seg]
    order = np.lexsort((np.arange(len(row)), owner, row))
    row, seg, band, owner = row[order], seg[order], band[order], owner[order]
    take = 1
    while len(row):
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (owner[1:] != owner[:-1])])
        place = np.arange(len(row)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        now = place < take
        edits = np.concatenate([_aligned(index, data, edges, *(x[now][i:i + CASES] for x in (row, seg, band)))
                                for i in range(0, int(now.sum()), CASES)])
        for r, item, e in zip(row[now][edits >= 0].tolist(), owner[now][edits >= 0].tolist(), edits[edits >= 0].tolist()):
            out.setdefault((r, item), e)
        group = np.cumsum(new) - 1
        found = np.zeros(group[-1] + 1, bool)
        found[group[now][edits >= 0]] = True
        stay = ~now & ~found[group]
        row, seg, band, owner = row[stay], seg[stay], band[stay], owner[stay]
        take *= 2


def _likely(index: Index, tests, row, seg, band) -> np.ndarray:
    """Whether a candidate's stretch of text has enough of the segment's short
    q-grams, by buckets: an edit spoils as many as a q-gram has characters."""
    out = np.zeros(len(row), bool)
    start = band * BAND - len(index.text) + index.starts[seg]
    for m, e in {*zip(index.lengths[seg].tolist(), index.edits[seg].tolist())}:
        pick = np.flatnonzero((index.lengths[seg] == m) & (index.edits[seg] == e))
        lines = np.arange(len(pick))[:, None]
        there = np.zeros((len(pick), BUCKETS), bool)
        there[lines, tests[np.clip(start[pick, None] - e + np.arange(m + BAND + 4 * e), 0, len(tests) - 1)]] = True
        missing = ~there[lines, index.tests[index.starts[seg[pick], None] + np.arange(m - TEST + 1)]]
        out[pick] = missing.sum(axis=1) <= TEST * e
    return out


def _aligned(index: Index, data, edges, row, seg, band) -> np.ndarray:
    """Edits of each candidate; -1 where they exceed the segment's budget."""
    out = np.full(len(row), -1, np.int64)
    a, b = edges[row], edges[row + 1] - GRAM
    start = band * BAND - len(index.text) + index.starts[seg] - a
    for m, e in {*zip(index.lengths[seg].tolist(), index.edits[seg].tolist())}:
        pick = np.flatnonzero((index.lengths[seg] == m) & (index.edits[seg] == e))
        patterns = index.text[index.starts[seg[pick], None] + np.arange(m)]
        found = banded_edits_of(patterns, data, a[pick], b[pick], start[pick] - e, BAND + 3 * e + 1, e)
        out[pick] = np.where(found <= e, found, -1)
    return out


def _leaks_of(index: Index, column: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(row, item, edits) over a column of texts, some rows at a time."""
    data, offsets = string_buffers(column)
    first, gap = 0, b"\n" * GRAM
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PART, "right")) - 1)
        texts = [normalised(data[offsets[i]:offsets[i + 1]].tobytes().decode()) + gap for i in range(first, end)]
        texts = [characters(x) for x in texts]
        edges = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        for r, item, edits in leaks(index, np.concatenate(texts), edges):
            yield first + r, item, edits
        first = end


def _search(documents: DataFrame, index: Index, id_col: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_leaks_of(index, batch.column(1)))
            at = pa.array([r for r, _, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([i for _, i, _ in rows], pa.int64()),
                                              pa.array([e for _, _, e in rows], pa.int32())], names=["doc_id", "item_id", "edits"])

    df = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return df.mapInArrow(run, "doc_id long, item_id long, edits int")


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about BLOCK bytes; the driver holds one block."""
    block, size, last = [], 0, None
    items = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    for r in items.orderBy("item_id", "text").toLocalIterator():
        if size >= BLOCK and r[0] != last:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size, last = size + len(r[1]), r[0]
    if block:
        yield block


def _indices(benchmark: DataFrame) -> Iterator[tuple[Index, bool]]:
    """The blocks' indices, and whether another follows."""
    index = None
    for following in (build_index(block) for block in _blocks(benchmark)):
        if index and following:
            yield index, True
        index = following or index
    if index:
        yield index, False


def contaminated(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, edits): documents that hold a segment of an item."""
    found = documents.sparkSession.createDataFrame([], "doc_id long, item_id long, edits int")
    for index, more in _indices(benchmark):
        part = _search(documents, index, id_col, text)
        found = found.unionByName(cut_lineage(part, "leaks") if more else part)
    return found


def clean_documents(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``documents`` that hold no segment of any item."""
    kept = documents
    for index, more in _indices(benchmark):
        kept = _without(kept, index, text)
        kept = cut_lineage(kept, "clean") if more else kept
    return kept.select(*documents.columns)


def _without(documents: DataFrame, index: Index, text: str) -> DataFrame:
    column = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[r for r, _, _ in _leaks_of(index, batch.column(column))]] = False
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.select("*").schema)


@register("op6_benchmark_decontamination")
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and the benchmark items that they hold."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
