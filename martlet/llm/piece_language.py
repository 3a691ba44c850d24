"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities of the pieces of a fixed public vocabulary
(their letters, lower case, and all single bytes). A word's probability is the
sum over all ways to cut it into pieces, by a forward pass; expectation and
maximisation steps over a bounded sample of labelled rows learn the piece
probabilities. A text's score for a language is the product over all its words;
the reported score is the best language's share at equal priors.

Defined results: null texts and texts without a letter are ``und`` with score 0;
without a labelled row everything is ``und``; rows without lang teach nothing;
equal rows get equal results; extra columns are not read.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.llm.gbt_quality import held_out
from martlet.llm.registry import read_table, register
from martlet.llm.words import process_cache, string_buffers, text_pieces

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Bytes of a piece at most; labelled rows of each language in the sample (about).
LONGEST, SAMPLE = 6, 400
ROUNDS, SMOOTHING = 4, 0.02
#: Bytes of a word beyond which its probability is kept as a logarithm.
LINEAR = 64
#: Scored words that a task remembers.
REMEMBERED = 300_000

_LETTERS = regex.compile(r"\p{L}+")
_SCALE = 24.0  # per byte, keeps the sums of ordinary words near 1


def vocabulary(name: str = VOCABULARY, longest: int = LONGEST) -> list[bytes]:
    """Pieces of a public vocabulary file: letters only, lower case, without a
    leading space; and all single bytes."""
    import os

    if not os.path.exists(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    pieces = {bytes([b]) for b in range(256)}
    with open(name, "rb") as f:
        for line in f:
            piece = base64.b64decode(line.split()[0]).removeprefix(b" ").lower()
            if 1 < len(piece) <= longest and all(c >= 128 or 97 <= c < 123 for c in piece):
                pieces.add(piece)
    return sorted(pieces)


class Pieces(NamedTuple):
    """The vocabulary as a hash table with two places for each piece."""

    keys: np.ndarray
    ids: np.ndarray
    count: int
    salt: int


_BITS = 18
_BASE, _ALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _places(h: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        shift, other = np.uint64(64 - _BITS), h ^ (h >> np.uint64(29)) ^ np.uint64(salt)
        return ((h * _BASE) >> shift).astype(np.int64), ((other * _ALT) >> shift).astype(np.int64) + (1 << _BITS)


def piece_table(pieces: list[bytes]) -> Pieces:
    """Every piece goes to its first place, or its second if that is taken; the
    second places are drawn anew until no two pieces meet there."""
    # Up to seven bytes and their length: no two pieces have the same number.
    values = np.array([int.from_bytes(p, "big") * 8 + len(p) for p in pieces], np.uint64)
    for salt in range(1000):
        a, b = _places(values, salt)
        _, first = np.unique(a, return_index=True)
        rest = np.setdiff1d(np.arange(len(pieces)), first)
        if len(np.unique(b[rest])) == len(rest):
            keys, ids = np.zeros(2 << _BITS, np.uint64), np.full(2 << _BITS, len(pieces), np.int32)
            at = a.copy()
            at[rest] = b[rest]
            keys[at], ids[at] = values, np.arange(len(pieces))
            return Pieces(keys, ids, len(pieces), salt)
    raise ValueError("the vocabulary is too large for the table")


def _lookup(table: Pieces, h: np.ndarray) -> np.ndarray:
    """Piece numbers of the values (``count`` where there is none)."""
    a, b = _places(h, table.salt)
    out = np.where(table.keys[a] == h, table.ids[a], table.count)
    return np.where(table.keys[b] == h, table.ids[b], out)


def _matrix(words: list[bytes]) -> np.ndarray:
    longest = max(map(len, words))
    return np.frombuffer(b"".join(w.ljust(longest, b"\0") for w in words), np.uint8).reshape(len(words), longest)


def _grid(table: Pieces, chars: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each length l the piece numbers of chars[:, j:j + l], for every j."""
    out, value = [], np.zeros(chars.shape, np.uint64)
    for size in range(1, min(longest, chars.shape[1]) + 1):
        n = chars.shape[1] - size + 1
        value = value[:, :n] * np.uint64(256) + chars[:, size - 1:]
        ids = _lookup(table, value * np.uint64(8) + np.uint64(size))
        ids[chars[:, size - 1:] == 0] = table.count
        out.append(ids)
    return out


def _forward(grid: list[np.ndarray], probs: np.ndarray, rows: int, length: int) -> list[np.ndarray]:
    """alpha[j]: summed probability of all segmentations of the first j bytes."""
    alpha = [np.ones((rows, probs.shape[1]))]
    for j in range(1, length + 1):
        alpha.append(sum(alpha[j - l] * probs[grid[l - 1][:, j - l]] for l in range(1, min(j, len(grid)) + 1)))
    return alpha


def _scaled(probs: np.ndarray, pieces: list[bytes]) -> np.ndarray:
    """Probabilities times a constant per byte, and a last row of zeros."""
    lengths = np.array([len(p) for p in pieces])
    return np.vstack([probs * (_SCALE ** lengths)[:, None], np.zeros((1, probs.shape[1]))])


def word_scores(words: list[bytes], table: Pieces, scaled: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Log probability of each word in each language, over all segmentations."""
    out = np.zeros((len(words), scaled.shape[1]))
    sizes = np.array([len(w) for w in words])
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        size = int(sizes[order[at]])
        if size > LINEAR:
            out[order[at]] = _long_word(words[order[at]], table, scaled, longest)
            at += 1
            continue
        end = int(np.searchsorted(sizes[order], min(LINEAR, size + 3), "right"))
        end = min(end, at + 8192)
        pick = order[at:end]
        alpha = _forward(_grid(table, _matrix([words[i] for i in pick]), longest), scaled, len(pick), int(sizes[pick].max()))
        total = np.stack(alpha)[sizes[pick], np.arange(len(pick))]
        out[pick] = np.log(total) - (sizes[pick] * np.log(_SCALE))[:, None]
        at = end
    return out


def _long_word(word: bytes, table: Pieces, scaled: np.ndarray, longest: int) -> np.ndarray:
    """The same for one long word: sums are rescaled at every byte."""
    chars = np.frombuffer(word, np.uint8)
    recent, log = [np.ones(scaled.shape[1])], np.zeros(scaled.shape[1])
    for lo in range(0, len(chars), 1 << 16):  # a stretch of places at a time
        part = chars[max(0, lo - longest):lo + (1 << 16)][None, :]
        back = lo - max(0, lo - longest)
        grid = _grid(table, part, longest)
        for j in range(back + 1, part.shape[1] + 1):
            new = sum(recent[-l] * scaled[grid[l - 1][0, j - l]] for l in range(1, min(j, len(grid), len(recent)) + 1))
            recent = [r / new for r in recent[-(longest - 1):]] + [np.ones_like(new)]
            log += np.log(new)
    return log - len(word) * np.log(_SCALE)


class Model(NamedTuple):
    languages: list[str]
    scaled: np.ndarray  # (pieces + 1, languages)


def fit(counts: dict[str, dict[bytes, int]], pieces: list[bytes], rounds: int = ROUNDS, longest: int = LONGEST) -> Model:
    """Piece probabilities of each language from its word counts."""
    table = piece_table(pieces)
    languages = sorted(counts)
    probs = np.full((len(pieces), len(languages)), 1 / len(pieces))
    for k, lang in enumerate(languages):
        words = [w for w in counts[lang] if 0 < len(w) <= LINEAR]
        times = np.array([counts[lang][w] for w in words], float)
        order = np.argsort([len(w) for w in words], kind="stable")
        for _ in range(rounds):
            scaled, expected = _scaled(probs[:, k:k + 1], pieces), np.zeros(len(pieces) + 1)
            for at in range(0, len(order), 8192):
                pick = order[at:at + 8192]
                some = [words[i] for i in pick]
                chars, sizes = _matrix(some), np.array([len(w) for w in some])
                grid, length = _grid(table, chars, longest), chars.shape[1]
                alpha = [a[:, 0] for a in _forward(grid, scaled, len(some), length)]
                beta = [(sizes == length).astype(float)]
                for j in range(length - 1, -1, -1):  # beta[0] is the latest place
                    beta.insert(0, (sizes == j) + sum(scaled[grid[l - 1][:, j], 0] * beta[l - 1] for l in range(1, min(length - j, len(grid)) + 1)))
                share = times[pick] / np.stack(alpha)[sizes, np.arange(len(some))]
                for l, ids in enumerate(grid, 1):
                    for j in range(length - l + 1):
                        expected += np.bincount(ids[:, j], alpha[j] * scaled[ids[:, j], 0] * beta[j + l] * share, len(pieces) + 1)
            found = expected[:-1] + SMOOTHING
            probs[:, k] = found / found.sum()
    return Model(languages, _scaled(probs, pieces))


def letters(text: bytes) -> Iterator[list[str]]:
    """The words of letters, lower case, piece by piece of the text."""
    for piece in text_pieces(text):
        yield _LETTERS.findall(piece.decode().lower())


def sampled(documents: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` teaching rows of each lang (all of rarer ones): those
    whose id's hash falls into the language's share."""
    rows = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), 4, 2))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    draw = F.xxhash64("doc_id", F.lit("lang")).bitwiseAND((1 << 40) - 1) / float(1 << 40)
    rate = F.lit(0.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, sample / n).otherwise(rate)
    return rows.filter(draw < rate).select("lang", "text")


def learn(documents: DataFrame, sample: int = SAMPLE, name: str = VOCABULARY) -> Model:
    """Counts the sample's words on the executors and fits on the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for words in letters(text.as_buffer().to_pybytes()):
                    counts.update((lang, w) for w in words)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])

    words = sampled(documents, sample).mapInArrow(run, "lang string, word string, n long")
    counts: dict[str, dict[bytes, int]] = {}
    for r in words.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word").toLocalIterator():
        counts.setdefault(r["lang"], {})[r["word"].encode()] = r["n"]
    return fit(counts, vocabulary(name))


#: Words that are looked up at a time.
AT_A_TIME = 200_000


def _some_words(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[str]]]:
    """The words of a column of texts and the rows they are from, many at a time."""
    data, offsets = string_buffers(texts)
    rows, counts, held = [], [], []
    for i in range(len(texts)):
        for words in letters(data[offsets[i]:offsets[i + 1]].tobytes()):
            if words:
                rows.append(i)
                counts.append(len(words))
                held += words
            if len(held) >= AT_A_TIME:
                yield np.repeat(rows, counts), held
                rows, counts, held = [], [], []
    if held:
        yield np.repeat(rows, counts), held


class Known:
    """Scores of the words met so far; starts anew beyond REMEMBERED words."""

    def __init__(self, table: Pieces, scaled: np.ndarray):
        self.table, self.scaled = table, scaled
        self.places: dict[str, int] = {}
        self.parts = np.zeros((0, scaled.shape[1]))

    def scores(self, words: list[str]) -> np.ndarray:
        if len(self.places) > REMEMBERED:
            self.places, self.parts = {}, self.parts[:0]
        new = sorted(set(words).difference(self.places))
        if new:
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
            self.parts = np.concatenate([self.parts, word_scores([w.encode() for w in new], self.table, self.scaled)])
        return self.parts[np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))]


def predict(documents: DataFrame, model: Model, name: str = VOCABULARY) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``documents``."""
    languages, scaled = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = process_cache("pieces")
        if "table" not in cache:
            cache["table"] = piece_table(vocabulary(name))
        known = Known(cache["table"], scaled)
        for batch in batches:
            totals, any_word = np.zeros((batch.num_rows, len(languages))), np.zeros(batch.num_rows, bool)
            for rows, words in _some_words(batch.column(1)):
                first = np.flatnonzero(np.diff(rows, prepend=-1))
                totals[rows[first]] += np.add.reduceat(known.scores(words), first)
                any_word[rows[first]] = True
            best = totals.argmax(1) if languages else np.zeros(batch.num_rows, int)
            share = 1 / np.exp(totals - totals.max(1, keepdims=True)).sum(1) if languages else np.zeros(batch.num_rows)
            named = any_word & bool(languages)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([languages[b] if ok else "und" for b, ok in zip(best, named)], pa.string()),
                 pa.array(np.where(named, share, 0.0))], names=["doc_id", "lang_pred", "score"])

    df = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return df.mapInArrow(run, "doc_id long, lang_pred string, score double")


@register("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(docs, learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
