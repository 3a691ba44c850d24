"""Secret scans: patterns, and a linear-chain conditional random field.

Tokens are runs of ASCII letters and digits and of other scripts' bytes. The
field tags each as secret begin, inside or outside, from its shape, its
neighbours (the words before, what stands between) and features of the file,
and is decoded by Viterbi. It learns from the patterns' own matches, in a
bounded sample of windows, and finds secrets of like shape and place that the
patterns miss. A token whose best case for a secret tag loses to "outside" under
any neighbours is outside in every optimal path, so the exact path needs Viterbi
over the short runs in between only.

Pattern spans always stay; a field's span is added where it meets none of them.
Defined results: null text counts as empty and has no span; a sample without any
match gives no field, so patterns alone decide; equal rows get equal results;
other columns pass through. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martlet.llm.registry import read_table, register
from martlet.llm.words import blocks, span_hashes, word_spans

# The contract's kinds, in order, with the length that a match
# (for assign: its value) must have.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")  # runs are maximal, so shorter ones drop by themselves
HEX = re.compile(rb"[0-9a-f]{16,}")
ASSIGN_LENGTH = 12
# Words that a match of ASSIGN must hold, and words that announce secrets.
HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
KEYWORDS = (b"password", b"passwd", b"pwd", b"secret", b"token", b"apikey", b"key", b"auth", b"bearer", b"credential",
            b"credentials", b"passphrase", b"signature", b"private")

#: Windows of the training sample, with and without matches; bytes on each side.
SAMPLE, PLAIN, SIDE = 1000, 700, 200
#: Rows that are searched for windows at first.
POOL = 50_000
#: What "outside" gains in every token: the field must be sure.
MARGIN = 2.0
STEPS, RATE, DECAY = 100, 0.2, 1e-2

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.StringType()),
                                  T.StructField("end", T.IntegerType())]))

OUT, BEGIN, INSIDE = 0, 1, 2
Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: bytes) -> list[Span]:
    """The patterns' matches in byte offsets, by start and then kind."""
    out = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    return sorted(out)


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each byte: token member, shape bits, kind (for changes), bits of a gap."""
    b = np.arange(256)
    digit, upper, lower, other = (b >= 48) & (b < 58), (b >= 65) & (b < 91), (b >= 97) & (b < 123), b >= 128
    shape = digit * 1 + upper * 2 + lower * 4 + other * 8 + ((lower & (b > 102)) * 16) + ((upper & (b > 70)) * 32)
    gap = np.where(digit | upper | lower | other, 0, 32)
    for bit, chars in ((1, b"="), (2, b":"), (4, b"\"'`"), (8, b" \t\r\f\v"), (16, b"+/_.-"), (64, b"\n")):
        gap[list(chars)] = bit
    return digit | upper | lower | other, shape.astype(np.uint8), (digit * 1 + upper * 2 + lower * 3).astype(np.uint8), gap.astype(np.uint8)


#: Sizes of the feature groups: shape bits, length, changes of kind, gap before,
#: gap behind, words before, shape of the next token, file.
GROUPS = (64, 16, 16, 128, 128, 8, 64, 32)


def _designs() -> list[np.ndarray]:
    """Features of each group's values: single bits, and steps of a scale, so
    that values that the sample lacks still get what their parts have shown."""
    def bits(n):
        v = np.arange(1 << n)[:, None]
        return np.hstack([(v >> np.arange(n)) & 1, np.ones((1 << n, 1), int)])

    def steps(n):
        return (np.arange(n)[:, None] >= np.arange(n)[None, :]).astype(int)

    v = np.arange(64)
    mixed = ((v & 1) > 0) & ((v & 6) > 0)
    file = np.arange(32)
    return [np.hstack([bits(6), mixed[:, None]]), steps(16), steps(16), bits(7), bits(7), bits(3), bits(6),
            np.hstack([(file & 1)[:, None], steps(4)[(file >> 1) & 3], steps(4)[file >> 3]])]


class Tokens(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray       # each row's first token, and the total
    groups: list[np.ndarray]  # a value of each group for each token


def tokenise(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Tokens of a block of rows with the values of their feature groups."""
    inner, shape_of, kind_of, gap_of = _byte_tables()
    starts, ends, first = word_spans(data, offsets, inner)
    if not len(starts):
        return Tokens(starts, ends, first, [np.zeros(0, np.int64) for _ in GROUPS])
    n = len(starts)
    shape = np.bitwise_or.reduceat(shape_of[data], starts)
    behind = np.bitwise_or.reduceat(gap_of[data], np.minimum(ends, len(data) - 1))
    behind[ends == len(data)] = 0
    kind = kind_of[data]
    changed = np.zeros(len(data) + 1, np.int32)
    np.cumsum(kind[1:] != kind[:-1], out=changed[1:-1])
    changes = changed[ends - 1] - changed[starts]
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    edge = np.flatnonzero(np.diff(row)) + 1
    before = np.zeros(n, np.uint8)
    before[1:] = behind[:-1]
    before[edge], behind[edge - 1] = 64, 64
    low = data | np.where((data >= 65) & (data < 91), np.uint8(32), np.uint8(0))
    words = np.frombuffer(b" ".join(KEYWORDS), np.uint8)
    ks, ke, _ = word_spans(words, np.array([0, len(words)]))
    key = np.isin(span_hashes(low, starts, ends), span_hashes(words, ks, ke))
    near = np.zeros(n, np.int64)
    for back, bit in ((1, 1), (2, 2), (3, 4)):
        same = np.zeros(n, bool)
        same[back:] = key[:-back] & (row[back:] == row[:-back]) if n > back else False
        near += bit * same
    following = np.zeros(n, np.uint8)
    following[:-1] = shape[1:]
    following[edge - 1] = 0
    length = ends - starts
    size = np.minimum(np.searchsorted(np.array([2, 4, 6, 8, 10, 12, 14, 16, 18, 20, 24, 32, 40, 48, 64]), length, "right"), 15)
    held = np.zeros(len(first) - 1, np.int64)
    np.maximum.at(held, row, key.astype(np.int64))
    rows = np.diff(offsets)
    words_in = np.maximum(np.diff(first), 1)
    file = held + 2 * np.minimum(np.searchsorted(np.array([200, 1000, 5000]), rows, "right"), 3) + 8 * np.minimum(
        np.searchsorted(np.array([5, 7, 10]), rows / words_in, "right"), 3)
    return Tokens(starts, ends, first, [shape & 63, size, np.minimum(changes, 15), before & 127, behind & 127, near, following & 63, file[row]])


class Field(NamedTuple):
    """Weights: a (size, 3) table of each feature group, and transitions (from, to)."""

    tables: list[np.ndarray]
    moves: np.ndarray

    def scores(self, groups: list[np.ndarray]) -> np.ndarray:
        out = self.tables[0][groups[0]].copy()
        for table, values in zip(self.tables[1:], groups[1:]):
            out += table[values]
        return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(windows: list[tuple[bytes, list[tuple[int, int]]]], steps: int = STEPS) -> Field | None:
    """Field of greatest regularised likelihood over the windows, each a text
    with the byte spans of its secrets; forward-backward over all at once."""
    seqs, tags = [], []
    for text, spans in windows:
        t = tokenise(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        tag = np.zeros(len(t.starts), np.int64)
        for a, b in spans:
            hit = np.flatnonzero((t.starts < b) & (t.ends > a))
            tag[hit] = INSIDE
            tag[hit[:1]] = BEGIN
        if len(tag):
            seqs.append(np.stack(t.groups))
            tags.append(tag)
    if not any((x == BEGIN).any() for x in tags):
        return None
    n, longest = len(seqs), max(len(x) for x in tags)
    real = np.zeros((n, longest), bool)
    gold = np.zeros((n, longest), np.int64)
    groups = np.zeros((len(GROUPS), n, longest), np.int64)
    for i, (s, tag) in enumerate(zip(seqs, tags)):
        real[i, :len(tag)], gold[i, :len(tag)], groups[:, i, :len(tag)] = True, tag, s
    designs = _designs()
    params = [np.zeros((d.shape[1], 3)) for d in designs] + [np.zeros((3, 3))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat = real.ravel()
    values = [v.ravel()[flat] for v in groups]
    wanted = [np.stack([np.bincount(v, gold.ravel()[flat] == k, size) for k in range(3)], 1) for v, size in zip(values, GROUPS)]
    both = real[:, 1:]
    moved = np.bincount((gold[:, :-1] * 3 + gold[:, 1:])[both], minlength=9).reshape(3, 3)
    total = flat.sum()
    for step in range(1, steps + 1):
        em = sum((d @ p)[v] for d, p, v in zip(designs, params, groups)) * real[:, :, None]
        moves = params[-1]
        alpha, beta = np.zeros_like(em), np.zeros_like(em)
        alpha[:, 0] = em[:, 0]
        for t in range(1, longest):
            nxt = _lse(alpha[:, t - 1, :, None] + moves, 1) + em[:, t]
            alpha[:, t] = np.where(real[:, t, None], nxt, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            nxt = _lse(moves + (em[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(real[:, t + 1, None], nxt, beta[:, t + 1])
        z = _lse(alpha[:, -1], 1)
        post = np.exp(alpha + beta - z[:, None, None]).reshape(-1, 3)[flat]
        pair = np.exp(alpha[:, :-1, :, None] + moves + (em + beta)[:, 1:, None, :] - z[:, None, None, None]) * both[:, :, None, None]
        grads = [d.T @ (np.stack([np.bincount(v, post[:, k], size) for k in range(3)], 1) - want)
                 for d, v, size, want in zip(designs, values, GROUPS, wanted)] + [pair.sum((0, 1)) - moved]
        for i, (p, grad) in enumerate(zip(params, grads)):
            grad = grad / total * 100 + DECAY * p
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.99 * second[i] + 0.01 * grad * grad
            p -= RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    return Field([(d @ p).astype(np.float32) for d, p in zip(designs, params)], params[-1])


def viterbi(scores: np.ndarray, moves: np.ndarray) -> list[int]:
    """Best tags of a run whose neighbours on both sides are outside."""
    best, back = scores[0] + moves[OUT], []
    for s in scores[1:]:
        ways = best[:, None] + moves
        back.append(ways.argmax(0))
        best = ways.max(0) + s
    at = int((best + moves[:, OUT]).argmax())
    path = [at]
    for b in reversed(back):
        at = int(b[at])
        path.append(at)
    return path[::-1]


def decode(scores: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags of all rows' tokens (rows are chains of their own)."""
    tags = np.zeros(len(scores), np.int8)
    maybe = np.zeros(len(scores), bool)
    for x in (BEGIN, INSIDE):
        gain = (moves[:, x] - moves[:, OUT]).max() + (moves[x] - moves[OUT]).max()
        maybe |= scores[:, OUT] - scores[:, x] <= gain
    at = np.flatnonzero(maybe)
    if len(at):
        row = np.searchsorted(first, at, "right")
        for run in np.split(at, np.flatnonzero((np.diff(at) > 1) | (np.diff(row) > 0)) + 1):
            tags[run] = viterbi(scores[run].astype(np.float64), moves)
    return tags


def field_spans(tokens: Tokens, tags: np.ndarray, row: int, at: int) -> list[tuple[int, int]]:
    """Byte spans of a row's tagged tokens, relative to its first byte ``at``.
    An inside tag behind an outside one begins a span."""
    out: list[tuple[int, int]] = []
    lo, hi = tokens.first[row], tokens.first[row + 1]
    last = None
    for i in lo + np.flatnonzero(tags[lo:hi]):
        a, b = int(tokens.starts[i] - at), int(tokens.ends[i] - at)
        if tags[i] == INSIDE and last == i - 1:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
        last = i
    return out


def merged(base: list[Span], found: list[tuple[int, int]]) -> list[Span]:
    """Base spans, and the parts of ``found`` that lie in none of them."""
    cover: list[list[int]] = []  # the base spans as stretches apart from each other
    for s, _, e in sorted(base):
        if cover and s <= cover[-1][1]:
            cover[-1][1] = max(cover[-1][1], e)
        else:
            cover.append([s, e])
    extra, first = [], 0
    for a, b in sorted(found):
        while first < len(cover) and cover[first][1] <= a:
            first += 1
        at = first
        while at < len(cover) and cover[at][0] < b:
            if a < cover[at][0]:
                extra.append((a, 3, cover[at][0]))
            a = max(a, cover[at][1])
            at += 1
        if a < b:
            extra.append((a, 3, b))
    return sorted(base + extra)


def redacted(text: bytes, spans: list[Span], mark: bytes) -> bytes:
    """``text`` with every stretch of spans (in order) that overlap or touch
    replaced by ``mark``."""
    parts, at, reach = [], 0, -1
    for a, _, b in spans:
        if a > reach:
            parts += [text[at:a], mark]
        reach = at = max(reach, b)
    return b"".join([*parts, text[at:]])


def _to_points(text: bytes, spans: list[Span]) -> list[Span]:
    """Byte offsets as code points."""
    if not spans or text.isascii():
        return spans
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(points[a]), k, int(points[b])) for a, k, b in spans]


def _windows_of(documents: DataFrame, fields: list[str], rate: float, plain_rate: float) -> DataFrame:
    """(hit, draw, window, spans): a window around each match, from the rows
    whose draw falls into the ``rate``, and one of each text without, from those
    in the ``plain_rate``; spans are flat byte pairs."""
    plain_draws = int(plain_rate * (1 << 62))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, draw in zip(batch.column(1), batch.column(0).to_pylist()):
                text = x.as_buffer().to_pybytes() if x.is_valid else b""
                spans = base_spans(text)
                for a, _, b in spans[:4]:
                    lo, hi = max(0, a - SIDE), min(len(text), b + SIDE)
                    inside = [max(0, v - lo) for s, _, e in spans if lo <= s and e <= hi for v in (s, e)]
                    rows.append((True, draw + a, text[lo:hi], inside))
                if not spans and text and draw < plain_draws:
                    lo = draw % max(1, len(text) - 2 * SIDE)
                    rows.append((False, draw, text[lo:lo + 2 * SIDE], []))
            cols = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.bool_(), pa.int64(), pa.binary(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["hit", "draw", "window", "spans"])

    draw = F.xxhash64(*fields, F.lit("crf")).bitwiseAND((1 << 62) - 1)
    df = documents.select(draw.alias("draw"), F.col("text").cast("binary").alias("text"))
    df = df.filter(F.col("draw") < int(rate * (1 << 62)))
    return df.mapInArrow(run, "hit boolean, draw long, window binary, spans array<int>")


def _secret_part(window: bytes, a: int, b: int) -> tuple[int, int]:
    m = ASSIGN.fullmatch(window[a:b])
    return (a + m.start(2), b) if m else (a, b)


def train(documents: DataFrame, fields: list[str], sample: int = SAMPLE, plain: int = PLAIN) -> Field | None:
    """Field learnt from at most ``sample`` windows around matches and ``plain``
    windows without: those of least draw, so that reruns agree. About ``POOL``
    rows are searched first, and eight times as many as long as they hold less
    than half of the sample, so that what the tasks send stays bounded."""
    n_rows = max(1, documents.count())
    rate = min(1.0, POOL / n_rows)
    while True:
        windows = _windows_of(documents, fields, rate, min(1.0, 4 * plain / n_rows))
        hits, others = (windows.filter(F.col("hit") == hit).orderBy("draw", "window").limit(n).collect()
                        for hit, n in ((True, sample), (False, plain)))
        if rate == 1 or len(hits) >= sample // 2:
            break
        rate = min(1.0, 8 * rate)
    rows = hits + others
    texts = [bytes(r["window"]) for r in rows]
    known = [(t, [_secret_part(t, *p) for p in zip(r["spans"][::2], r["spans"][1::2])]) for t, r in zip(texts, rows)]
    return fit(known + [_restyled(t, spans, i) for i, (t, spans) in enumerate(known) if spans])


# Alphabets of secrets.
ALPHABETS = ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEF0123456789", "abcdefghijklmnopqrstuvwxyz0123456789",
             "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def _restyled(text: bytes, spans: list[tuple[int, int]], number: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The window with its first secret in another alphabet and length (every
    third time in parts joined by dashes), so that the field learns the place
    and the randomness of secrets and not one format."""
    draw = random.Random(number)
    letters = ALPHABETS[number % len(ALPHABETS)]
    new = "".join(draw.choice(letters) for _ in range(draw.randint(18, 44)))
    if number % 3 == 0:
        new = "-".join(new[i:i + 8] for i in range(0, len(new), 8))
    (a, b), raw = spans[0], new.encode()
    shift = len(raw) - (b - a)
    rest = [(s, e) for s, e in spans[1:] if e <= a] + [(s + shift, e + shift) for s, e in spans[1:] if s >= b]
    return text[:a] + raw + text[b:], [(a, a + len(raw)), *rest]


def _spans_of(column: pa.Array, field: Field | None, margin: float) -> Iterator[tuple[bytes, list[Span]]]:
    """(text, its spans in bytes) of each row."""
    for _, _, data, offsets in blocks(column):
        if field:
            tokens = tokenise(data, offsets)
            scores = field.scores(tokens.groups)
            scores[:, OUT] += margin
            tags = decode(scores, tokens.first, field.moves)
        for r in range(len(offsets) - 1):
            raw = data[offsets[r]:offsets[r + 1]].tobytes()
            yield raw, merged(base_spans(raw), field_spans(tokens, tags, r, int(offsets[r])) if field else [])


def _trained(docs: DataFrame, text: str, fields: tuple[str, ...], sample: int, plain: int) -> Field | None:
    return train(docs.select(*dict.fromkeys(fields), F.col(text).alias("text")), list(fields), sample, plain)


def scan(documents: DataFrame, text: str = "text", fields: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE,
         plain: int = PLAIN, margin: float = MARGIN) -> DataFrame:
    """``documents`` with ``spans``: arrays of (start, kind, end)."""
    names = [c for c in documents.columns if c != "spans"]
    docs = documents.select(*names)
    field = _trained(docs, text, fields, sample, plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
        for batch in batches:
            out = [[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in _to_points(raw, spans)]
                   for raw, spans in _spans_of(batch.column(names.index(text)), field, margin)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*names, "spans"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("spans", SPANS)]))


def redact(documents: DataFrame, text: str = "text", mark: str = "[SECRET]", fields: tuple[str, ...] = ("doc_id",),
           sample: int = SAMPLE, plain: int = PLAIN, margin: float = MARGIN) -> DataFrame:
    """``documents`` with every span (overlapping or touching ones as one)
    replaced by ``mark``, in the pass that finds them. Null texts stay null."""
    at = documents.columns.index(text)
    field = _trained(documents, text, fields, sample, plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            out = [redacted(raw, spans, mark.encode()) if ok else None
                   for ok, (raw, spans) in zip(column.is_valid().to_pylist(), _spans_of(column, field, margin))]
            columns = [*batch.columns[:at], pa.array(out, pa.binary()).cast(pa.string()), *batch.columns[at + 1:]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return documents.mapInArrow(run, documents.select("*").schema)


@register("op8_secret_scans")
def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    counts = [count(kind) for kind in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"))
