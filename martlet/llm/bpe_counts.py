"""Token counts with overlap resynchronisation.

A huge document is encoded in chunks that overlap. The tokenizer first cuts a
text into pre-tokens, scanning left to right; what the scan finds from a
pre-token's start on does not depend on what came before, and a pre-token that
ends well before the chunk's end does not depend on what comes behind. So a
position inside the overlap at which both chunks start a pre-token (clear of
the left chunk's end by a guard) is a stable common boundary: tokens before it
come from the left chunk, tokens from it on from the right one. Where an overlap
holds no such position, it is doubled, at last up to the whole rest.

Defined results: null text counts as empty (0 tokens); special strings inside
texts are handled as the library does by default; equal rows get equal results;
other columns pass through.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.llm.registry import read_table, register
from martlet.llm.words import process_cache

TOKENIZER = "byte_bpe_50k.json"
#: Characters of a chunk and of an overlap; texts beyond a chunk are cut.
CHUNK, OVERLAP = 1 << 15, 512
#: Characters of short texts that the library gets at a time.
BATCH = 1 << 18
LIMIT = 1024


def load_tokenizer(name: str):
    """The tokenizer of a file, or of a public vocabulary's name; one a worker."""
    loaded = process_cache("tokenizers")
    if name not in loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        if not os.path.exists(name):
            import public_tokenizers

            loaded[name] = Tokenizer.from_file(public_tokenizers.path(name))
        else:
            loaded[name] = Tokenizer.from_file(name)
    return loaded[name]


class Chunk:
    """The encoding of ``text[lo:hi]``: absolute token starts and pre-token starts."""

    def __init__(self, tokenizer, text: str, lo: int, hi: int):
        encoding = tokenizer.encode(text[lo:hi], add_special_tokens=False)
        words = encoding.word_ids
        self.hi = hi
        self.starts = [lo + a for a, _ in encoding.offsets]
        self.bounds = [s for i, s in enumerate(self.starts) if i == 0 or words[i] is None or words[i] != words[i - 1]]

    def tokens(self, lo: int, hi: int) -> int:
        """Tokens that start from ``lo`` on and before ``hi``."""
        return sum(lo <= s < hi for s in self.starts)


def count_tokens(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, encoded in overlapping chunks."""
    n = len(text)
    guard = 16 + max((len(x.content) for x in tokenizer.get_added_tokens_decoder().values()), default=0)
    overlap = max(overlap, 2 * guard)
    chunk = max(chunk, 2 * overlap)
    total, valid = 0, 0  # valid: a proven pre-token start; all tokens before it are counted
    left = Chunk(tokenizer, text, 0, min(n, chunk))
    while left.hi < n:
        width, size = overlap, chunk
        while True:
            lo = left.hi - width
            if lo <= valid:  # no room to the left: a longer chunk from the last boundary
                size *= 2
                left = Chunk(tokenizer, text, valid, min(n, valid + size))
                width = overlap
                if left.hi == n:
                    break
                continue
            right = Chunk(tokenizer, text, lo, min(n, lo + max(size, 2 * width)))
            common = {s for s in left.bounds if lo <= s <= left.hi - guard}
            at = next((s for s in right.bounds if s in common), None)
            if at is not None:
                total += left.tokens(valid, at)
                valid, left = at, right
                break
            width *= 2
    return total + left.tokens(valid, n + 1)


def with_token_counts(documents: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, chunk: int = CHUNK,
                      overlap: int = OVERLAP) -> DataFrame:
    """``documents`` without the text, with n_bytes (UTF-8) and n_tokens."""
    rest = [c for c in documents.columns if c not in (text, "n_bytes", "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(tokenizer)
        for batch in batches:
            column = batch.column(len(rest))
            n_bytes, n_tokens = [0] * batch.num_rows, [0] * batch.num_rows
            short, size = [], 0
            for i in range(batch.num_rows + 1):
                done = i == batch.num_rows
                if short and (done or size >= BATCH):
                    for k, e in zip([k for k, _ in short], tok.encode_batch_fast([x for _, x in short], add_special_tokens=False)):
                        n_tokens[k] = len(e)
                    short, size = [], 0
                if done or not column[i].is_valid:
                    continue
                raw = column[i].as_buffer().to_pybytes()
                n_bytes[i], one = len(raw), raw.decode()
                if len(one) > chunk:
                    n_tokens[i] = count_tokens(tok, one, chunk, overlap)
                elif one:
                    short.append((i, one))
                    size += len(one)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                                             names=[*rest, "n_bytes", "n_tokens"])

    df = documents.select(*rest, F.col(text))
    return df.mapInArrow(run, documents.select(*rest).schema.add("n_bytes", "long").add("n_tokens", "long"))


@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_counts(docs).withColumn("over_limit", F.col("n_tokens") > LIMIT)
