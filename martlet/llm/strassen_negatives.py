"""Hard negatives by Strassen products of anchor and candidate tiles.

Anchors and rows meet in the cells of a grid: a cell holds a block of anchors and
a block of rows, both bounded by a parameter, and every pair of blocks has one
cell. Anchors are copied along the grid's columns, rows along its lines; both come
by a shuffle on the cell, so no side passes through the driver or is broadcast.

In a cell, tiles of 64-bit integers are multiplied by Strassen's recursion (seven
products of halves, padded with zeros to even sizes, down to a small leaf). Only
additions, subtractions and products of integers take place, so scores are exact.
A first pass keeps a heap of each anchor's best rows of its label; heaps merge
across tiles, and the cells' heaps by rank. The second pass keeps one heap per
anchor and positive, of the different-label rows within the positive's window.

Defined results: rows with a null label, a null or empty vector or a null or
non-finite component take no part; shorter vectors count as padded with zeros;
rows that repeat a vec_id are rows of their own (each may be an anchor, and none is
a positive of an anchor with its id); a null id is never an anchor and comes last
among ties; an anchor without positives, or whose windows are empty, has no rows;
scores are longs and wrap as those do; an empty table gives no rows; other columns
of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martlet.llm.registry import read_table, register
from martlet.llm.vectors import usable, vectors_of
from martlet.session import cut_lineage

SCALE, KEPT = 256, 5
#: A negative's score is at least this many hundredths of the positive's.
LEAST_PERCENT = 80
#: Anchors and rows of a cell, and rows of a tile.
ANCHORS, ROWS, TILE = 512, 4096, 2048
#: Strassen's recursion ends where a side is this short.
LEAF = 16
LAST = (1 << 63) - 1


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two integer matrices."""
    if min(*a.shape, b.shape[1]) <= leaf:
        return a @ b
    (m, k), n = a.shape, b.shape[1]
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, b.shape[1] // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :h], a[:i, h:], a[i:, :h], a[i:, h:]
    b11, b12, b21, b22 = b[:h, :j], b[:h, j:], b[h:, :j], b[h:, j:]
    out = np.empty((2 * i, 2 * j), a.dtype)
    p = strassen(a11 + a22, b11 + b22, leaf)
    out[:i, :j], out[i:, j:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    out[i:, :j] = p
    out[i:, j:] -= p
    p = strassen(a11, b12 - b22, leaf)
    out[:i, j:] = p
    out[i:, j:] += p
    p = strassen(a22, b21 - b11, leaf)
    out[:i, :j] += p
    out[i:, :j] += p
    p = strassen(a11 + a12, b22, leaf)
    out[:i, :j] -= p
    out[:i, j:] += p
    out[i:, j:] += strassen(a21 - a11, b11 + b12, leaf)
    out[:i, :j] += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


def heap_of(row: np.ndarray, score: np.ndarray, ident: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``kept`` best entries of each row: higher scores first, ties by the
    smaller id. The heap of joined heaps is the heap of all their entries."""
    order = np.lexsort((ident, ~score, row))
    row, score, ident = row[order], score[order], ident[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    best = place < kept
    return row[best], score[best], ident[best]


def tile_heap(scores: np.ndarray, allowed: np.ndarray, ident: np.ndarray, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heap of the allowed entries of a tile of scores (anchors x rows)."""
    n = scores.shape[1]
    if n > kept:  # what is below the kept-th of a line cannot be in its heap
        floor = np.where(allowed, scores, -LAST - 1)
        allowed = allowed & (scores >= np.partition(floor, n - kept, axis=1)[:, n - kept, None])
    line, at = np.nonzero(allowed)
    return heap_of(line, scores[line, at], ident[at], kept)


def _join(heaps: list[tuple], kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return heap_of(*(np.concatenate(x) for x in zip(*heaps)), kept)


class Tile:
    """Anchors or rows of a cell as numbers."""

    def __init__(self, table: pa.Table, length: int, scale: int):
        column = table.column("vector").combine_chunks()
        _, z = vectors_of(column, scale, length)
        if z.dtype == object:  # longs wrap
            z = np.array([(int(v) + (1 << 63)) % (1 << 64) - (1 << 63) for v in z.ravel()], np.int64).reshape(z.shape)
        self.z = z
        self.label = table.column("label").to_numpy()
        self.ident = table.column("ident").fill_null(LAST).to_numpy()
        self.row = table.column("row").to_numpy()


def _longest(*tables: pa.Table) -> int:
    sizes = [t.column("vector").combine_chunks().value_lengths().to_numpy() for t in tables]
    return max([0, *(int(s.max()) for s in sizes if len(s))])


def positives_of(anchors: Tile, rows: Tile, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heap of each anchor's best other rows of its label: labels are multiplied
    apart from each other."""
    heaps = [(np.zeros(0, np.int64),) * 3]
    for label in np.intersect1d(anchors.label, rows.label):
        a, r = np.flatnonzero(anchors.label == label), np.flatnonzero(rows.label == label)
        for at in range(0, len(r), TILE):
            part = r[at:at + TILE]
            scores = strassen(anchors.z[a], np.ascontiguousarray(rows.z[part].T))
            line, score, ident = tile_heap(scores, anchors.ident[a, None] != rows.ident[None, part], rows.ident[part], kept)
            heaps.append((a[line], score, ident))
    return _join(heaps, kept)


def negatives_of(anchors: Tile, rows: Tile, high: np.ndarray, percent: int, kept: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heap of each (anchor, positive) window; its line is the anchor's number
    times the number of positives plus the positive's. ``high`` holds the
    positives' scores, masked where an anchor has fewer."""
    per = high.shape[1]
    # percent * positive <= 100 * negative, in whole numbers of any size.
    low = np.array([-(-percent * int(h) // 100) for h in high.data.ravel()], object)
    low = np.clip(low, -LAST - 1, LAST).astype(np.int64).reshape(high.shape)
    there = ~np.ma.getmaskarray(high)
    heaps = [(np.zeros(0, np.int64),) * 3]
    for at in range(0, len(rows.z), TILE):
        part = slice(at, at + TILE)
        scores = strassen(anchors.z, np.ascontiguousarray(rows.z[part].T))
        other = anchors.label[:, None] != rows.label[None, part]
        for j in range(per):
            inside = other & there[:, j, None] & (scores >= low[:, j, None]) & (scores <= high.data[:, j, None])
            line, score, ident = tile_heap(scores, inside, rows.ident[part], kept)
            heaps.append((line * per + j, score, ident))
    return _join(heaps, kept)


def _grid(anchors: DataFrame, rows: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` on every cell of anchors and rows."""
    n, m = rows.count(), anchors.count()
    across, down = -(-n // ROWS) or 1, -(-m // ANCHORS) or 1
    dealt = lambda k: F.pmod(F.xxhash64("row"), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = anchors.withColumn("down", dealt(down)).withColumn("across", every(across))
    right = rows.withColumn("across", dealt(across)).withColumn("down", every(down))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        return work(a, b)

    return left.groupBy("down", "across").cogroup(right.groupBy("down", "across")).applyInArrow(cell, schema)


def _ranked(cells: DataFrame, keys: list[str], score: str, ident: str, kept: int) -> DataFrame:
    """The cells' heaps merged: the ``kept`` best of each key, with their rank."""
    best = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(ident).asc_nulls_last())
    return cells.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= kept)


def _nullable(ident: np.ndarray) -> pa.Array:
    return pa.array(ident, pa.int64(), mask=ident == LAST)


def mine(vectors: DataFrame, anchor: Column, label: Column | str = "label", id_col: str = "vec_id", vector: str = "embedding",
         positives: int = KEPT, negatives: int = KEPT, percent: int = LEAST_PERCENT, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row that ``anchor`` marks and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of other
    labels that score from ``percent`` hundredths of the positive's score to all of it."""
    label = F.col(label) if isinstance(label, str) else label
    usable_rows = usable(vectors.filter(label.isNotNull()), vector)
    rows = cut_lineage(usable_rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("ident"), label.cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("asks")), "vectors")
    anchors, rows = rows.filter("asks AND ident IS NOT NULL").drop("asks"), rows.drop("asks")

    def find_positives(a: pa.Table, b: pa.Table) -> pa.Table:
        length = _longest(a, b)
        left, right = Tile(a, length, scale), Tile(b, length, scale)
        line, score, ident = positives_of(left, right, positives)
        return pa.table({"row": left.row[line], "positive": _nullable(ident), "score": score})

    found = _ranked(_grid(anchors, rows, find_positives, "row long, positive long, score long"), ["row"], "score", "positive", positives)
    listed = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "positive", "score"))).alias("found"))
    asking = cut_lineage(anchors.join(listed, "row").select(
        *anchors.columns, F.col("found.positive").alias("positive"), F.col("found.score").alias("score")), "anchors")

    def find_negatives(a: pa.Table, b: pa.Table) -> pa.Table:
        length = _longest(a, b)
        left, right = Tile(a, length, scale), Tile(b, length, scale)
        scores, names = a.column("score").to_pylist(), a.column("positive").to_pylist()
        high = np.ma.masked_all((len(scores), positives), np.int64)
        high.data[:] = 0
        for i, own in enumerate(scores):
            high[i, :len(own)] = own
        line, score, ident = negatives_of(left, right, high, percent, negatives)
        at, j = line // positives, line % positives
        return pa.table({"row": left.row[at], "place": j, "anchor_id": left.ident[at],
                         "positive_id": pa.array([names[i][k] for i, k in zip(at.tolist(), j.tolist())], pa.int64()),
                         "positive_score": high.data[at, j], "negative_id": _nullable(ident), "negative_score": score})

    schema = "row long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    out = _ranked(_grid(asking, rows, find_negatives, schema), ["row", "place"], "negative_score", "negative_id", negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


_SQL = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS z
           FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
                           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS id,
             CAST(list_sum(list_transform(range(least(len(a.z), len(r.z))), lambda i: a.z[i + 1] * r.z[i + 1])) AS BIGINT) AS score
      FROM v a CROSS JOIN v r WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same AND id <> anchor_id
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {KEPT})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {LEAST_PERCENT} * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= {KEPT}"""


@register("op12_hard_negatives", _SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, against all vectors."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)
