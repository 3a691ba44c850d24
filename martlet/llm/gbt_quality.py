"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are measured once, into a table. Trees grow level
by level on histograms of binned statistics with logistic loss, from a bounded
sample of labelled rows. They are complete trees, flattened into arrays, so a
batch walks all trees at once with numpy.

Defined results: null, empty and blank texts have the statistics of no words and
get a score too; repeated labels of a document count by their mean; without a
labelled row every score is 0.5; rows that repeat a doc_id are scored each by its
own text; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from martlet.llm.registry import read_table, register
from martlet.llm.words import blocks, ngrams, span_hashes, word_spans
from martlet.session import cut_lineage

#: Labelled rows that the trees learn from at most (those of least hash).
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LEAST = 80, 4, 64, 0.15, 5.0
THRESHOLD = 0.3

STATISTICS = ("bytes", "words", "word_bytes", "upper", "lower", "digits", "spaces", "points", "bangs", "pipes", "symbols",
              "beyond_ascii", "distinct_words", "stutter", "distinct_trigrams", "top_word", "lines", "distinct_lines",
              "longest_word", "plain_words")


def _class_table() -> np.ndarray:
    table = np.full(256, 9)
    for k, chars in enumerate((range(65, 91), range(97, 123), range(48, 58), b" \t\n\v\f\r", b".,;:?", b"!", b"|", b"#*$%&<>",
                               range(128, 256))):
        table[list(chars)] = k
    return table.astype(np.uint8)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text of a block."""
    classes = _class_table()[data]
    starts, ends, first = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    trigrams = ngrams(hashes, 3)
    lengths = ends - starts
    letters = np.concatenate([[0], np.cumsum((classes <= 1) | (classes == 8))])
    plain = (letters[ends] - letters[starts]) == lengths
    out = np.zeros((len(offsets) - 1, len(STATISTICS)), np.float32)
    for r in range(len(out)):
        a, b, lo, hi = offsets[r], offsets[r + 1], first[r], first[r + 1]
        n, words = max(1, b - a), hi - lo
        counts = np.bincount(classes[a:b], minlength=10) / n
        line_words = [x for x in data[a:b].tobytes().split(b"\n") if x.strip()]
        h = hashes[lo:hi]
        top = same = distinct = tri = longest = tidy = mean = 0.0
        if words:
            _, times = np.unique(h, return_counts=True)
            top, distinct = times.max() / words, len(times) / words
            same = float((h[1:] == h[:-1]).mean()) if words > 1 else 0.0
            tri = len(np.unique(trigrams[lo:hi - 2])) / (words - 2) if words > 2 else 1.0
            longest, tidy, mean = np.log1p(lengths[lo:hi].max()), plain[lo:hi].mean(), lengths[lo:hi].mean()
        lines = max(1, len(line_words))
        out[r] = (np.log1p(b - a), np.log1p(words), mean, counts[0], counts[1], counts[2], counts[3], counts[4], counts[5],
                  counts[6], counts[7], counts[8], distinct, same, tri, top, np.log1p(len(line_words)),
                  len(set(line_words)) / lines, longest, tidy)
    return out


def with_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without the text, with ``stats``, an array of STATISTICS."""
    rest = [c for c in documents.columns if c not in (text, "stats")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(data, offsets) for _, _, data, offsets in blocks(batch.column(len(rest)))]
            flat = np.concatenate([np.zeros((0, len(STATISTICS)), np.float32), *rows])
            at = pa.array(np.arange(len(flat) + 1, dtype=np.int32) * len(STATISTICS), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(at, pa.array(flat.ravel()))],
                                             names=[*rest, "stats"])

    df = documents.select(*rest, F.col(text))
    return df.mapInArrow(run, T.StructType([*df.schema.fields[:-1], T.StructField("stats", T.ArrayType(T.FloatType()))]))


class Trees(NamedTuple):
    """Complete trees in arrays: node i's children are 2i+1 (statistic up to the
    limit) and 2i+2; ``leaves`` are what the last level adds to the score."""

    start: float
    feature: np.ndarray  # (trees, inner nodes)
    limit: np.ndarray    # (trees, inner nodes)
    leaves: np.ndarray   # (trees, leaves)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds: all rows walk all trees, a level at a time."""
        if not len(self.feature):
            return np.full(len(x), self.start)
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(int(np.log2(self.leaves.shape[1]))):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.limit[trees, node])
        return self.start + self.leaves[trees, node - self.feature.shape[1]].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _edges(x: np.ndarray) -> list[np.ndarray]:
    """Bin limits of each statistic: quantiles of the sample."""
    return [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])).astype(np.float32) for c in x.T]


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Gradient boosting on histograms with logistic loss."""
    if not len(y):
        return Trees(0.0, np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 1)))
    start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if not 0 < y.mean() < 1:
        return Trees(start, np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 1)))
    edges = _edges(x)
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    inner, margin = 2 ** depth - 1, np.full(len(y), start)
    feature, limit, leaves = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, 2 ** depth))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width, base = 2 ** level, 2 ** level - 1
            best = np.full(width, 1e-6)
            cut = np.full(width, BINS)
            for f in range(x.shape[1]):
                key = (node - base) * BINS + binned[:, f]
                g = np.bincount(key, grad, width * BINS).reshape(width, BINS).cumsum(1)
                h = np.bincount(key, hess, width * BINS).reshape(width, BINS).cumsum(1)
                n = np.bincount(key, minlength=width * BINS).reshape(width, BINS).cumsum(1)
                gt, ht, nt = g[:, -1:], h[:, -1:], n[:, -1:]
                gain = g * g / (h + 1) + (gt - g) ** 2 / (ht - h + 1) - gt * gt / (ht + 1)
                gain[(n < LEAST) | (nt - n < LEAST)] = 0
                at = gain.argmax(1)
                new = gain[np.arange(width), at] > best
                best[new], cut[new] = gain[np.arange(width), at][new], at[new]
                feature[t, base:base + width][new] = f
            for k in np.flatnonzero(cut < BINS):
                e = edges[feature[t, base + k]]
                limit[t, base + k] = e[cut[k]] if cut[k] < len(e) else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > limit[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, 2 ** depth), np.bincount(leaf, hess, 2 ** depth)
        leaves[t] = -RATE * g / (h + 1)
        margin = margin + leaves[t, leaf]
    return Trees(start, feature, limit, leaves)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id's text leaves ``part`` by ``parts`` (null: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def learn(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from the ``sample`` labelled rows of least hash; held-out ones never."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"), 5, 0))
    marked = usable.groupBy("doc_id").agg(F.avg("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = measured.join(marked, "doc_id").select("doc_id", "stats", "y").orderBy("doc_id", "stats").limit(2 * sample).toPandas()
    x = np.stack(rows["stats"].to_list()).astype(np.float32) if len(rows) else np.zeros((0, len(STATISTICS)), np.float32)
    return fit(x, (rows["y"].to_numpy(float) >= 0.5).astype(float))


def score_quality(documents: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``documents``."""
    measured = cut_lineage(with_statistics(documents.select("doc_id", text), text), "statistics")
    trees = learn(measured, labels, sample)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["stats"].to_list())
                yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": trees.score(x)})

    scored = measured.mapInPandas(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@register("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
