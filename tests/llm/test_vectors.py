"""Vector codes and hard negatives against brute force on Python integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import strassen_negatives as sn, walsh_codes as wc

INF, NAN = float("inf"), float("nan")
KIND = "vec_id long, embedding array<float>, label int, row string, code string, rank int"


def usable(rows):
    return [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]


@pytest.fixture(scope="module")
def odd_rows():
    """Null and bad vectors and ids, equal vectors, repeated rows, several lengths."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=10)], int(i % 3)) for i in range(120)]
    rows += [(200 + i, [0.5] * 10, i % 2) for i in range(60)]  # ties
    rows += [(300, None, 1), (301, [], 1), (302, [1.0, None], 1), (303, [NAN] * 10, 1), (304, [INF] * 10, 1), (305, [1.0] * 10, None),
             (400, [0.25] * 7, 0), (400, [0.25] * 7, 0), (100, [0.5] * 10, 2), (None, [0.5] * 10, 1), (-700, [-0.5] * 12, -4)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], KIND)


# ---------------------------------------------------------------- codes


def brute_codes(rows, scale, parts, entries, rounds):
    kept = sorted(usable(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(len(r[1]) for r in kept) // parts)
    cut = []
    for _, v, _ in kept:
        z = [math.floor(scale * x) for x in v] + [0] * (width * parts - len(v))
        cut.append([z[p * width:(p + 1) * width] for p in range(parts)])
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            held = {}
            for c in cut:
                held.setdefault(near(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(x) // len(held[k]) for x in zip(*held[k])] if k in held else e for k, e in enumerate(book)]
    out = []
    for (i, _, label), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    text = ",".join(str(v) for b in books for e in b for v in e)
    return [(i, code, e, sum(x[2] for x in out if x[3] == label), hashlib.sha256(text.encode()).hexdigest()) for i, code, e, label in out]


@pytest.mark.parametrize("parts,entries,rounds", [(4, 256, 4), (4, 16, 3), (3, 5, 2), (1, 8, 1)])
def test_codes_equal_brute_force(spark, odd_rows, parts, entries, rounds):
    got = wc.compress(frame(spark, odd_rows).repartition(5), parts=parts, entries=entries, rounds=rounds)
    assert got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    rows = [tuple(r) for r in got.drop("label").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(rows, key=key) == sorted(brute_codes(odd_rows, 1024, parts, entries, rounds), key=key)


def test_codes_of_huge_components(spark):
    rows = [(i, [1e30 * i, -1e12, 0.1 * i, 3.0], i % 2) for i in range(1, 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.code, r.error) for r in wc.compress(df, parts=2, entries=4, rounds=2).collect()}
    want = {r[0]: (r[1], min(r[2], (1 << 63) - 1)) for r in brute_codes(rows, 1024, 2, 4, 2)}
    assert got == want


def test_codes_of_no_rows(spark):
    assert wc.compress(frame(spark, [(1, None, 1)])).collect() == []
    assert wc.compress(spark.createDataFrame([], KIND)).collect() == []


@pytest.mark.parametrize("length", [1, 3, 8, 16, 21])
def test_transform_scales_squared_distances(length):
    rng = np.random.default_rng(length)
    a, b = rng.integers(-999, 999, (2, 5, length))
    m = 1 << max(0, length - 1).bit_length()
    assert (((wc.walsh(a) - wc.walsh(b)) ** 2).sum(1) == m * ((a - b) ** 2).sum(1)).all()


def test_order_of_sequency():
    rows = np.eye(16, dtype=np.int64)
    changes = (np.diff(wc.walsh(rows).T, axis=1) != 0).sum(axis=1)
    assert changes.tolist() == list(range(16))


def test_nearest_takes_the_lowest_of_equals():
    rng = np.random.default_rng(3)
    entries = rng.integers(-3, 4, (64, 5))
    parts = rng.integers(-3, 4, (1500, 5))
    k, d = wc.nearest(parts, entries)
    far = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert (k == far.argmin(1)).all() and (d == far.min(1)).all()


# ---------------------------------------------------------------- hard negatives


def brute_negatives(rows, step, scale=256, percent=80, kept=5):
    rows = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in usable(rows) if label is not None]
    last = lambda i: (i is None, i or 0)
    out = []
    for i, z, label in rows:
        if i is None or i % step:
            continue
        seen = sorted(((-sum(a * b for a, b in zip(z, y)), last(j), j, other) for j, y, other in rows), key=lambda s: s[:2])
        for s, _, p, _ in [x for x in seen if x[3] == label and x[2] != i][:kept]:
            inside = [x for x in seen if x[3] != label and percent * -s <= 100 * -x[0] <= 100 * -s][:kept]
            out += [(i, p, rank, x[2], -s, -x[0]) for rank, x in enumerate(inside, 1)]
    return out


@pytest.mark.parametrize("cell,tile", [((512, 4096), 2048), ((3, 20), 7)])
def test_negatives_equal_brute_force(spark, odd_rows, monkeypatch, cell, tile):
    """Also over many small cells and tiles."""
    monkeypatch.setattr(sn, "ANCHORS", cell[0])
    monkeypatch.setattr(sn, "ROWS", cell[1])
    monkeypatch.setattr(sn, "TILE", tile)
    got = [tuple(r) for r in sn.mine(frame(spark, odd_rows).repartition(4), F.col("vec_id") % 10 == 0).collect()]
    key = lambda r: (r[0], r[1] is None, r[1] or 0, r[2], r[3] is None, r[3] or 0, *r[4:])
    want = brute_negatives(odd_rows, 10)
    assert len(want) > 200 and sorted(got, key=key) == sorted(want, key=key)


def test_negatives_of_no_rows(spark):
    assert sn.mine(spark.createDataFrame([], KIND), F.col("vec_id") % 10 == 0).collect() == []
    assert sn.mine(frame(spark, [(1, [1.0], 1)]), F.col("vec_id") % 10 == 0).collect() == []
    assert sn.mine(frame(spark, [(10, [1.0], 1), (11, [1.0], 2)]), F.col("vec_id") % 10 == 0).collect() == []


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 16, 40), (37, 65, 90), (64, 33, 128)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-10**6, 10**6, (m, k)), rng.integers(-10**6, 10**6, (k, n))
    assert (sn.strassen(a, b, leaf=4) == a @ b).all()


def test_heaps_merge():
    rng = np.random.default_rng(1)
    row, score, ident = rng.integers(0, 4, 300), rng.integers(-5, 5, 300), rng.permutation(300)
    whole = sn.heap_of(row, score, ident, 5)
    parts = [sn.heap_of(row[i::3], score[i::3], ident[i::3], 5) for i in range(3)]
    for x, y in zip(whole, sn._join(parts, 5)):
        assert (x == y).all()
