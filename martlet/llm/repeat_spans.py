"""Substring dedup by seeds and the windows around them.

Seeds are winnowed anchors: of the word k-grams in every window of ``length``
words the one with the least hash, so that equal windows have equal anchors.
Anchors that several documents share are the seeds; documents join on them.
Instead of extending a match word by word, all windows whose anchor a shared seed
is are listed: a match is the union of its windows. Where the windows around a seed are the same set in every document
that has it, they are whole repeats; else the windows themselves are held
against each other, by 96 bits of hash over their words. What a smaller doc_id
holds too is removed: the union of the windows found.

Both joins meet pre-aggregated sides (an anchor's or window's least doc_id), so
a passage of a third of all documents adds one row a document, never pairs of
documents. Defined results: null or blank text has no words; rows without a
doc_id are neither removed from nor held against others; rows that repeat a
doc_id are one document, each with its own text; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.llm.registry import read_table, register
from martlet.llm.words import blocks, mix, ngrams, span_hashes, word_spans
from martlet.session import cut_lineage

#: Words of a window, and of the k-grams whose least one is its anchor.
LENGTH, GRAM = 13, 4
#: Bytes of texts unpacked at a time; documents of an anchor from which it counts
#: as frequent at the earliest.
BLOCK, HOT = 1 << 20, 1000
#: Rows of an output batch at most.
ROWS = 1 << 17

Batches = Iterator[pa.RecordBatch]


def _windows(h: np.ndarray, first: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, row, anchor hash) of every window that lies within a row; ``h``
    are the words' hashes, ``first`` each row's first word and the total."""
    grams = ngrams(h, gram)
    if len(h) < length:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.flatnonzero(row[:len(h) - length + 1] == row[length - 1:])
    least = grams[:len(h) - length + 1].copy()
    for j in range(1, length - gram + 1):
        np.minimum(least, grams[j:j + len(least)], out=least)
    return starts, row[starts], least[starts]


def _emit(ids: np.ndarray, *values: np.ndarray, names: list[str]) -> Batches:
    for at in range(0, len(ids), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(x[at:at + ROWS]) for x in (ids, *values)], names=names)


def _anchor_sets(start: np.ndarray, row: np.ndarray, least: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, sum of its windows' hashes) of each row's distinct anchors."""
    def summed(row, least, values):
        at = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])]))
        return row[at], least[at], np.add.reduceat(values, at)

    row, least, sums = summed(row, least, whole[start])
    order = np.lexsort((least, row))
    return summed(row[order], least[order], sums[order])


def anchors(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(anchor, around, doc_id): the distinct anchors of each row's windows, and
    a fingerprint of the set of windows around each."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, _, data, offsets in blocks(batch.column(1)):
                starts, ends, first = word_spans(data, offsets)
                h = span_hashes(data, starts, ends)
                start, row, least = _windows(h, first, length, gram)
                if len(row):
                    row, least, around = _anchor_sets(start, row, least, ngrams(h, length))
                    yield from _emit(least.view(np.int64), around.view(np.int64), ids[lo + row], names=["anchor", "around", "doc_id"])

    found = documents.filter("doc_id is not null").select("doc_id", "text")
    return found.mapInArrow(run, "anchor long, around long, doc_id long")


def _second(h: np.ndarray, length: int) -> np.ndarray:
    """Another 32 bits over the same windows."""
    with np.errstate(over="ignore"):
        return (ngrams(mix(h + np.uint64(0x5851F42D4C957F2D)), length, 0xDA942042E4DD58B5) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def packed_texts(documents: DataFrame) -> DataFrame:
    """(doc_id, packed): texts compressed, for the shuffle."""
    def run(batches: Batches) -> Batches:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [pack.compress(x.as_buffer()) if x.is_valid else None for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, packed binary")


def _unpacked(packed: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows' texts, a block
    of them at a time (a longer text is a block of its own)."""
    unpack = zstandard.ZstdDecompressor()
    texts: list[bytes] = []
    size = 0
    for i, x in enumerate(packed, 1):
        texts.append(unpack.decompress(x.as_buffer()) if x.is_valid else b"")
        size += len(texts[-1])
        if size >= BLOCK or i == len(packed):
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            yield i - len(texts), i, np.frombuffer(b"".join(texts), np.uint8), offsets
            texts, size = [], 0


class Listed:
    """The hashes that a column lists for each row (none where it is null)."""

    def __init__(self, column: pa.Array):
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        self.at = np.concatenate([[0], np.cumsum(lengths)])
        self.values = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)

    def holds(self, first: int, end: int, row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Whether the list of row ``first + row`` holds the hash, for all at once."""
        own = np.repeat(np.arange(end - first), np.diff(self.at[first:end + 1]))
        salt = mix(np.arange(1, end - first + 1, dtype=np.uint64))
        return np.isin(hashes ^ salt[row], self.values[self.at[first]:self.at[end]] ^ salt[own])


def seeded_windows(documents: DataFrame, seeds: list[str], length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(h1, h2, doc_id): the windows around the anchors that each row's
    ``seeds`` columns list."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            lists = [Listed(c) for c in batch.columns[2:]]
            some = np.flatnonzero(np.sum([np.diff(x.at) for x in lists], axis=0))
            batch = batch.take(pa.array(some))  # rows without seeds are not unpacked
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = [Listed(c) for c in batch.columns[2:]]
            for lo, hi, data, offsets in _unpacked(batch.column(1)):
                starts, ends, first = word_spans(data, offsets)
                h = span_hashes(data, starts, ends)
                start, row, least = _windows(h, first, length, gram)
                if len(start):
                    take = np.logical_or.reduce([x.holds(lo, hi, row, least) for x in lists])
                    start, row = start[take], row[take]
                    h1, h2 = ngrams(h, length)[start], _second(h, length)[start]
                    order = np.lexsort((h1, row))  # a window once a row, however often it occurs there
                    row, h1, h2 = row[order], h1[order], h2[order]
                    new = np.ones(len(row), bool)
                    new[1:] = (h1[1:] != h1[:-1]) | (row[1:] != row[:-1])
                    yield from _emit(h1[new].view(np.int64), h2[new], ids[lo + row[new]], names=["h1", "h2", "doc_id"])

    return documents.select("doc_id", "packed", *seeds).mapInArrow(joined(run), "h1 long, h2 int, doc_id long")


def joined(run):
    """Gathers small output batches into larger ones."""
    def gather(batches: Batches) -> Batches:
        held, rows = [], 0
        for batch in run(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return gather


def covered_words(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at ``starts``."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, n), -1)
    return np.cumsum(step[:n]) > 0


def _removed(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text); ``whole`` lists anchors whose
    windows all go, ``gone`` the hashes of further windows that go."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            whole, gone = Listed(batch.column(2)), Listed(batch.column(3))
            out: list[tuple[int, int, bytes]] = []
            for lo, hi, data, offsets in _unpacked(batch.column(1)):
                texts = data.tobytes()
                listed = whole.at[hi] > whole.at[lo] or gone.at[hi] > gone.at[lo]
                if listed:
                    starts, ends, first = word_spans(data, offsets)
                    h = span_hashes(data, starts, ends)
                    start, row, least = _windows(h, first, length, gram)
                    goes = whole.holds(lo, hi, row, least) | gone.holds(lo, hi, row, ngrams(h, length)[start])
                    drop = covered_words(len(h), start[goes], length)
                for i in range(hi - lo):
                    words, cut = texts[offsets[i]:offsets[i + 1]].split(), 0
                    n = len(words)
                    if listed and (cut := int(drop[first[i]:first[i + 1]].sum())):
                        words = list(compress(words, ~drop[first[i]:first[i + 1]]))
                    out.append((n, cut, b" ".join(words)))
            n, cut, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(cut, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    df = documents.select("doc_id", "packed", "whole", "gone")
    return df.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every row of ``documents``:
    its words without those in a window that a smaller doc_id holds too."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = anchors(docs, length, gram)
    shared = (found.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.count("*").alias("n"), F.min("around").alias("a"),
                                          F.max("around").alias("b")).filter("n > 1").select("anchor", "lo", "n", (F.col("a") != F.col("b")).alias("mixed")))
    met = found.select("anchor", "doc_id").join(shared, "anchor")
    later = F.col("doc_id") > F.col("lo")
    # An anchor's first document loses nothing around it, but others may lose to it.
    limit = max(HOT, docs.count() // 100)
    kinds = {"whole": ~F.col("mixed") & later, "first": F.col("mixed") & ~later, "later": F.col("mixed") & later,
             "busy": F.col("mixed") & ~later & (F.col("n") > limit)}
    seeds = met.filter(F.col("mixed") | later).groupBy("doc_id").agg(
        *[F.collect_list(F.when(test, F.col("anchor"))).alias(name) for name, test in kinds.items()])
    seeds = cut_lineage(seeds.select("doc_id", *[F.when(F.size(c) > 0, F.col(c)).alias(c) for c in kinds]), "seeds")

    # The joins below read the packed texts in the same form, so that Spark
    # shuffles them once.
    texts = cut_lineage(packed_texts(docs), "texts").join(seeds.drop("busy"), "doc_id", "left")
    everywhere = seeded_windows(texts, ["first", "later"], length, gram).groupBy("h1", "h2")
    least = everywhere.agg(F.min("doc_id").alias("lo"))
    met = seeded_windows(texts, ["later"], length, gram)
    # Windows in more than a hundredth of the documents are a hundred times the
    # windows of a document at most: a bounded table, broadcast. Rows of such
    # windows spread over the join's tasks by doc_id. Only anchors as frequent can
    # have such windows around them.
    own = F.col("h1")
    if seeds.filter("busy is not null").limit(1).count():
        counts = everywhere.agg(F.min("doc_id").alias("hot_lo"), F.count("*").alias("n"))
        met = met.join(F.broadcast(counts.filter(F.col("n") > limit).drop("n")), ["h1", "h2"], "left")
        own = F.when(F.col("hot_lo").isNull(), own).otherwise(F.xxhash64("doc_id", "h1"))
    else:
        met = met.withColumn("hot_lo", F.lit(None).cast("long"))
    met = met.withColumn("key", own).join(least.withColumnRenamed("h1", "key"), ["key", "h2"], "left")
    gone = met.filter(F.col("doc_id") > F.coalesce("hot_lo", "lo")).groupBy("doc_id").agg(F.collect_set("h1").alias("gone"))
    return _removed(texts.join(gone, "doc_id", "left"), length, gram)


_SQL = r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
n AS (SELECT doc_id, w, len(w) AS n FROM t),
g AS (SELECT doc_id, unnest(range(1, n - 11)) AS i, w FROM n WHERE n >= 13),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM g),
f AS (SELECT win, min(doc_id) AS lo FROM s GROUP BY win),
r AS (SELECT DISTINCT doc_id, i + j AS p FROM s JOIN f USING (win), (SELECT unnest(range(0, 13)) AS j) WHERE lo < doc_id),
p AS (SELECT doc_id, unnest(range(1, n + 1)) AS p, unnest(w) AS word FROM n),
k AS (SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.p) AS kept, count(*) AS m
      FROM p ANTI JOIN r ON p.doc_id = r.doc_id AND p.p = r.p GROUP BY p.doc_id)
SELECT n.doc_id, n AS n_words, n - coalesce(m, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM n LEFT JOIN k ON n.doc_id = k.doc_id
"""


@register("op3_substring_dedup", _SQL)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that every document keeps, as a digest."""
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
