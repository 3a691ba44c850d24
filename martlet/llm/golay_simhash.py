"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 23 bits. Two
fingerprints with three differing bits or fewer have two segments with one
differing bit or none each (pigeonhole). The perfect binary Golay code maps a
segment to the 12-bit index of its nearest codeword. A fingerprint is filed
under the index pairs of its own segments, and asks for the pairs reached from
segments with one bit flipped or none (one or six indices each), so the segment
that its partner holds is always among them. Candidates of the equi-join are
verified by their bit distance; linked fingerprints are joined to components.

Only distinct fingerprints take part, so a group of equal texts, however large,
counts once. Defined results: null, empty or blank text has fingerprint zero;
a null doc_id never names a component unless the whole component has none;
rows that repeat a doc_id are judged each by its own text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.llm.components import connected_components
from martlet.llm.registry import read_table, register
from martlet.llm.words import process_cache, text_pieces
from martlet.session import cut_lineage

# Generator polynomial of the binary Golay code (23, 12, 7); its
# length; the checksum bits.
GENERATOR, LENGTH, CHECKS = 0b101011100011, 23, 11

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: (shift, bits) of the segments.
SEGMENTS = ((0, 21), (21, 21), (42, 22))


def shingle_bits(text: bytes, shingle: int = SHINGLE) -> tuple[np.ndarray, int]:
    """How often each bit (highest first) is set in the shingles' hashes, and
    the number of shingles. Long texts are taken piece by piece."""
    total, n, carry = np.zeros(64, np.int64), 0, []
    for piece in text_pieces(text):
        words = carry + piece.lower().split()
        carry = words[-(shingle - 1):] if shingle > 1 else []
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
        begin, end = starts[:-shingle].tolist(), (starts[shingle:] - 1).tolist()
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begin, end)], ">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        n += len(hashes)
    if not n and carry:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], ">u8")
        total, n = np.unpackbits(hashes.view(np.uint8)).astype(np.int64), 1
    return total, n


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in more than half of the shingles' hashes, as a signed long."""
    total, n = shingle_bits(text, shingle)
    bits = (2 * total > n).astype(np.uint8) if n else np.zeros(64, np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


def with_fingerprints(documents: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``documents`` with a column ``_fp``."""
    names = [c for c in documents.columns if c != "_fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in batch.column(names.index(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*names, "_fp"])

    return documents.select(*names).mapInArrow(run, documents.select(*names).schema.add("_fp", "long"))


def _remainders() -> np.ndarray:
    """Remainder of x^i by the generator, for each bit i of a word."""
    out, r = [], 1
    for _ in range(LENGTH):
        out.append(r)
        r <<= 1
        if r >> CHECKS:
            r ^= GENERATOR
    return np.array(out, np.int64)


def golay_index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the nearest codeword of each 23-bit word. Each of the
    2048 syndromes belongs to one error pattern of three bits or fewer."""
    one = _remainders()
    errors = np.zeros(1 << CHECKS, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            errors[np.bitwise_xor.reduce(one[list(bits)])] = sum(1 << b for b in bits)
    syndrome = np.zeros(words.shape, np.int64)
    for i in range(LENGTH):
        syndrome ^= ((words >> i) & 1) * one[i]
    return (words ^ errors[syndrome]) >> CHECKS


def _indices() -> np.ndarray:
    """The index of every 23-bit word (16 MB of 16-bit numbers, from the rule above)."""
    index = process_cache("golay")
    if not index:
        parts = [golay_index(np.arange(a, a + (1 << 19))).astype(np.uint16) for a in range(0, 1 << LENGTH, 1 << 19)]
        index["all"] = np.concatenate(parts)
    return index["all"]


def segment_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, key) of the filed keys and (row, key) of the asked keys, where a
    key holds the number of the segment pair and its two indices."""
    own, near = [], []
    table = _indices()
    for shift, bits in SEGMENTS:
        part = (fps.view(np.uint64) >> np.uint64(shift)).astype(np.int64) & ((1 << bits) - 1)
        flips = np.concatenate([[0], 1 << np.arange(bits)])
        around = np.sort(table[part[:, None] ^ flips[None, :]].astype(np.int64), axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
        own.append(table[part].astype(np.int64))
        near.append(np.nonzero(around >= 0) + (around[around >= 0],))
    rows = np.arange(len(fps))
    filed, asked = [], []
    for number, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        filed.append((rows, (number << 24) + (own[a] << 12) + own[b]))
        (ra, _, ka), (rb, _, kb) = near[a], near[b]
        # All combinations of a row's two lists: repeat the first, tile the second.
        na, nb = np.bincount(ra, minlength=len(fps)), np.bincount(rb, minlength=len(fps))
        first = np.repeat(np.arange(len(ra)), nb[ra])
        at = np.arange(len(first)) - np.repeat(np.cumsum(nb[ra]) - nb[ra], nb[ra])
        second = (np.cumsum(nb) - nb)[ra[first]] + at
        asked.append((ra[first], (number << 24) + (ka[first] << 12) + kb[second]))
        assert len(first) == int((na * nb).sum())
    join = [np.concatenate(x) for x in (*zip(*filed), *zip(*asked))]
    return join[0], join[1], join[2], join[3]


def _keys(fps: DataFrame, ask: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                fp = batch.column(0).slice(at, 2000).to_numpy(zero_copy_only=False)
                x = segment_keys(fp)
                row, key = x[2:] if ask else x[:2]
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(fp[row])], names=["key", "fp"])

    return fps.select("_fp").mapInArrow(run, "key int, fp long")


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct pairs (u, v), u < v, of distinct fingerprints ``_fp`` that
    differ in ``max_bits`` bits or fewer (three at most)."""
    if max_bits > 3:
        raise ValueError("the segments guarantee links of three bits or fewer")
    asked, filed = _keys(fps, True).withColumnRenamed("fp", "u"), _keys(fps, False).withColumnRenamed("fp", "v")
    close = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    return asked.join(filed, "key").filter(close).select("u", "v").distinct()


def near_groups(prints: DataFrame, id_col: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """(``_fp``, ``_label``, ``component_id``) of every distinct fingerprint."""
    fps = prints.groupBy("_fp").agg(F.min(id_col).alias("_least"))
    labels = connected_components(near_pairs(fps, max_bits))
    groups = fps.join(labels, fps["_fp"] == labels["node"], "left").select("_fp", "_least", F.coalesce("label", "_fp").alias("_label"))
    least = groups.groupBy("_label").agg(F.min("_least").alias("component_id"))
    return groups.select("_fp", "_label").join(least, "_label").select("_fp", "_label", "component_id")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, ``_fp``, ``component_id``) of every row."""
    prints = cut_lineage(with_fingerprints(documents.select(id_col, text), text, shingle).drop(text), "fingerprints")
    return prints.join(near_groups(prints, id_col, max_bits).drop("_label"), "_fp")


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: one whose id names it (any of several equal
    ids; one without id where the component has none)."""
    columns = documents.columns
    full = cut_lineage(with_fingerprints(documents, text, shingle), "fingerprints")
    groups = cut_lineage(near_groups(full.select(id_col, "_fp"), id_col, max_bits), "groups")
    first = F.col(id_col).eqNullSafe(F.col("component_id"))
    # Only where ids repeat does a component have several such rows.
    several = full.select(id_col, "_fp").join(groups, "_fp").filter(first).groupBy("_label").count().filter("count > 1").limit(1).count()
    kept = full.join(groups, "_fp").filter(first)
    return (kept.dropDuplicates(["_label"]) if several else kept).select(*columns)


@register("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")
