"""Vector code compression: product codes found in the Walsh-Hadamard domain.

A vector's integer components are cut into equal parts; every part gets the
number of the nearest entry of its position's codebook, and the codebooks are
moved to the means of their parts for a number of rounds.

Parts and entries are padded with zeros to a power of two m and transformed by
the integer Walsh-Hadamard transform, which multiplies every squared distance
by m. Squared differences are accumulated coefficient by coefficient in order
of sequency (sign changes), and an entry goes as soon as what it has gathered
exceeds m times a distance that some entry is known to have: no partial sum can
shrink. All sums are integers: 64 bits wide where the values' size proves that
they fit, Python's integers elsewhere. No distance is a floating-point number.

Codebooks (parts x entries x part length numbers) are all that reaches the
driver: the sums of a round come there as one row per component. Every round
is one pass over the vectors; nothing else about them is kept.

Defined results: rows whose vector is null, empty or holds a null or non-finite
component are dropped; vectors shorter than the longest, and lengths that do not
divide into equal parts, count as padded with zeros at the end; with fewer rows
than entries the codebooks are that short; rows that repeat a vec_id are rows of
their own (smaller vectors first among the initial entries), null ids come last;
an error beyond a long is the largest long; an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.llm.registry import read_table, register
from martlet.llm.vectors import usable, vectors_of
from martlet.session import cut_lineage

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Rows whose distances to all entries are held at a time.
ROWS = 512
LONGEST = (1 << 63) - 1


def sequency_order(m: int) -> np.ndarray:
    """Hadamard rows of order ``m`` (a power of two) by their sign changes."""
    bits = m.bit_length() - 1
    gray = np.arange(m) ^ (np.arange(m) >> 1)
    out = np.zeros(m, np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def walsh(parts: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of the rows, padded with zeros to a
    power of two, coefficients in order of sequency."""
    n, length = parts.shape
    m = 1 << max(0, length - 1).bit_length()
    out = np.zeros((n, m), parts.dtype)
    out[:, :length] = parts
    step = 1
    while step < m:
        pairs = out.reshape(n, m // (2 * step), 2, step)
        a, b = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0], pairs[:, :, 1] = a + b, a - b
        step *= 2
    return out[:, sequency_order(m)]


def _width(*arrays: np.ndarray):
    """The integers that hold every sum of squared differences of the rows'
    transforms (a coefficient adds up to m components)."""
    if any(a.dtype == object for a in arrays):
        return object
    m = 1 << max(0, arrays[0].shape[1] - 1).bit_length()
    most = m * max([1, *(int(np.abs(a).max()) for a in arrays if a.size)])
    return np.int64 if (2 * most) ** 2 * m < LONGEST else object


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest entry, lowest of equals; squared distance) of each
    row, by transforms in order of sequency with early elimination."""
    kind = _width(parts, entries)
    x, e = walsh(parts.astype(kind)), walsh(entries.astype(kind))
    m = x.shape[1]
    best, error = np.zeros(len(x), np.int64), np.zeros(len(x), kind)
    for first in range(0, len(x), ROWS):
        block = x[first:first + ROWS]
        rows = np.arange(len(block))
        total = np.zeros((len(block), len(e)), kind)
        bound, done, live = None, 0, None
        while done < m:
            upto = min(m, done + max(1, m // 8))
            if live is None:  # all entries: a column of coefficients at a time
                for t in range(done, upto):
                    gap = block[:, t, None] - e[None, :, t]
                    total += gap * gap
                leader = total.argmin(axis=1)
                gap = block - e[leader]
                full = (gap * gap).sum(axis=1)
                bound = full if bound is None else np.minimum(bound, full)
                open_ = total <= bound[:, None]
                if 4 * np.count_nonzero(open_) <= open_.size:  # few are left: go on with those alone
                    live = np.nonzero(open_)
                    sums = total[live]
            else:
                r, k = live
                gap = block[r, done:upto] - e[k, done:upto]
                sums = sums + (gap * gap).sum(axis=1)
                stays = sums <= bound[r]
                live, sums = (r[stays], k[stays]), sums[stays]
            done = upto
        if live is None:
            leader = total.argmin(axis=1)
            least = total[rows, leader]
        else:  # rows ascend, entries ascend in a row: the first of the least is the lowest
            r, k = live
            order = np.lexsort((k, sums, r)) if kind is not object else np.array(sorted(range(len(r)), key=lambda i: (r[i], sums[i], k[i])), np.int64)
            head = order[np.searchsorted(r[order], rows)]
            leader, least = k[head], sums[head]
        best[first:first + ROWS], error[first:first + ROWS] = leader, least // m
    return best, error


class Codebooks:
    """One array (entries x part length) per part position."""

    def __init__(self, books: list[np.ndarray], scale: int):
        self.books, self.scale = books, scale
        self.part = books[0].shape[1]

    def parts_of(self, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        kept, ints = vectors_of(column, self.scale, self.part * len(self.books))
        return kept, [ints[:, i * self.part:(i + 1) * self.part] for i in range(len(self.books))]

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position within the part."""
        text = ",".join(str(int(v)) for book in self.books for v in book.ravel())
        return hashlib.sha256(text.encode()).hexdigest()


def _sums(vectors: DataFrame, books: Codebooks, vector: str) -> DataFrame:
    """(part, entry, position, total, n): each component's sum over the parts
    next to an entry. A task adds its own up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, object) for b in books.books]
        counts = [np.zeros(len(b), np.int64) for b in books.books]
        for batch in batches:
            for p, part in enumerate(books.parts_of(batch.column(0))[1]):
                if not len(part):
                    continue
                code, _ = nearest(part, books.books[p])
                narrow = part.dtype != object and int(np.abs(part).max()) < (1 << 62) // len(part)
                add = np.zeros(books.books[p].shape, np.int64 if narrow else object)
                np.add.at(add, code, part)
                sums[p] += add
                counts[p] += np.bincount(code, minlength=len(counts[p]))
        out: list[tuple] = []
        for p, count in enumerate(counts):
            out += [(p, int(k), i, str(int(v)), int(count[k])) for k in np.flatnonzero(count) for i, v in enumerate(sums[p][k])]
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()))],
                                         names=["part", "entry", "position", "total", "n"])

    told = vectors.select(vector).mapInArrow(run, "part int, entry int, position int, total string, n long")
    return told.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def learn_codebooks(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
                    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of the vectors' parts, from those of the smallest ids; None
    where there is no vector."""
    longest = vectors.agg(F.max(F.size(vector))).first()[0]
    if not longest:
        return None
    first = vectors.orderBy(F.col(id_col).asc_nulls_last(), vector).limit(entries).select(vector).collect()
    part = -(-longest // parts)
    _, ints = vectors_of(pa.array([r[0] for r in first], pa.list_(pa.float64())), scale, part * parts)
    books = Codebooks([ints[:, i * part:(i + 1) * part].copy() for i in range(parts)], scale)
    for _ in range(rounds):
        moved = [b.astype(object) for b in books.books]
        for r in _sums(vectors, books, vector).collect():
            moved[r["part"]][r["entry"], r["position"]] = int(r["total"]) // r["n"]
        fits = all(abs(v) < 1 << 62 for b in moved for v in b.ravel())
        books = Codebooks([b.astype(np.int64) if fits else b for b in moved], scale)
    return books


def encode(vectors: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """All columns of ``vectors`` with ``code`` (two hex digits a part; four if
    a codebook has more than 256 entries) and ``error``."""
    names = [c for c in vectors.columns if c not in ("code", "error")]
    digits = 2 if len(books.books[0]) <= 256 else 4
    schema = vectors.select(*names).schema.add("code", "string").add("error", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, cut = books.parts_of(batch.column(names.index(vector)))
            found = [nearest(p, b) for p, b in zip(cut, books.books)]
            text = ["".join(f"{int(k):0{digits}x}" for k in row) for row in zip(*(f[0] for f in found))]
            error = [min(LONGEST, sum(map(int, row))) for row in zip(*(f[1] for f in found))]
            rows = batch.take(pa.array(kept))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(text, pa.string()), pa.array(error, pa.int64())],
                                             names=[*names, "code", "error"])

    return vectors.select(*names).mapInArrow(run, schema)


def compress(vectors: DataFrame, id_col: str = "vec_id", label: str = "label", vector: str = "embedding",
             scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every usable
    row; ``label_error`` adds up the errors of rows with an equal label."""
    vectors = usable(vectors.select(id_col, label, vector), vector)
    books = learn_codebooks(vectors, id_col, vector, scale, parts, entries, rounds)
    if books is None:
        return vectors.select(id_col, label).limit(0).withColumns(
            {"code": F.lit(""), "error": F.lit(0).cast("long"), "label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")})
    coded = cut_lineage(encode(vectors, books, vector).drop(vector), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)"))
    labels = coded.groupBy(F.col(label).alias("_label")).agg(total.cast("long").alias("label_error"))
    return (coded.join(labels, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
            .withColumn("codebooks_sha256", F.lit(books.digest())))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same by plain distances to every entry."""
    steps = [f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS z
           FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT CAST(ceil(max(len(z)) / {parts}) AS BIGINT) AS w FROM v),
n AS (SELECT row_number() OVER (ORDER BY vec_id, z) AS r, vec_id, label,
             list_transform(range(w * {parts}), lambda i: coalesce(z[i + 1], 0)) AS z, w FROM v, l),
p AS (SELECT r, p, list_slice(z, p * w + 1, (p + 1) * w) AS x FROM n, range({parts}) AS t(p)),
e0 AS (SELECT p, r - 1 AS k, x AS y FROM p WHERE r <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS (SELECT r, p, any_value(x) AS x, min(struct_pack(d := list_sum(list_transform(range(len(x)), lambda i: (x[i + 1] - y[i + 1]) * (x[i + 1] - y[i + 1]))), k := k)) AS f
       FROM p JOIN e{i} USING (p) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT p, k, list(CAST(floor(s / c) AS BIGINT) ORDER BY i) AS y FROM (
         SELECT p, f.k AS k, i, CAST(sum(x[i + 1]) AS DOUBLE) AS s, count(*) AS c FROM a{i}, l, range(l.w) AS t(i) GROUP BY p, f.k, i) GROUP BY p, k),
e{i + 1} AS (SELECT p, k, coalesce(m{i}.y, e{i}.y) AS y FROM e{i} LEFT JOIN m{i} USING (p, k))""")
    return ",".join(steps) + f""",
o AS (SELECT vec_id, label, string_agg(printf('%02x', f.k), '' ORDER BY p) AS code, CAST(sum(f.d) AS BIGINT) AS error
      FROM a{rounds} JOIN n USING (r) GROUP BY r, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, k)) FROM e{rounds}) AS codebooks_sha256
FROM o"""


@register("op13_vector_codes", _sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and errors of every usable vector."""
    coded = compress(read_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
