"""Packing by power-of-two decomposition.

A document of n tokens (its ids and a closing token) is cut into n // L pieces of the full
length L and one piece for each binary digit of the rest, longest first. Every piece has a
power-of-two length, is a sequence of its own, and so is never padded and never mixes documents;
``bucket`` (log2 of the length) groups sequences of equal length for batches without padding.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLUSH_TOKENS = 1 << 20   # an output batch is closed after so many tokens
LONG_RUN = 10_000        # characters without a break from which the library's own encoder is taken


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others are shifted to 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(moved)}


@lru_cache(maxsize=4)
def _encoder(path: str):
    """text -> ids as uint32, for the byte-level BPE in the tokenizer file at ``path``.

    The file's own library gives the ids; where its merges are in id order (checked here) the same
    ids come several times faster from the rank encoder, over the file's vocabulary and split pattern.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()

    def by_library(text: str) -> np.ndarray:
        return np.array(library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, vocab = spec["model"], spec["model"]["vocab"]
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    plain = (spec["normalizer"] is None and spec["pre_tokenizer"] == {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        and not model.get("dropout") and not model.get("ignore_merges")
        and merged == sorted(set(merged)) and len(vocab) == 256 + len(merged)
        and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"]))
    if not plain:
        return by_library
    import public_tokenizers
    import regex
    import tiktoken

    byte = _byte_of_char()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in special}
    quick = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens=special)
    long_run = regex.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

    def by_rank(text: str) -> np.ndarray:
        if len(text) >= LONG_RUN and long_run.search(text):
            return by_library(text)
        return quick.encode_to_numpy(text, allowed_special="all")

    return by_rank


def piece_lengths(n: int, max_len: int) -> list[int]:
    """Full pieces, then the binary digits of the rest from the highest down."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in range(max_len.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack_documents(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                   max_len: int = 1024, closing_id: int = 0) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, bucket, sequence_id, offset.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers. A null or empty text is the
    closing token alone: one piece of length 1. Repeated rows and null ids are packed row by row like any
    other; an empty table gives no rows; other columns are not read. ``max_len`` is a power of two.

    Nothing is shuffled: a task streams its documents, and ``sequence_id`` is unique over the table (task
    number, then position). It stays the same when a task is run again if ``docs`` is a scan or checkpoint.
    """
    if max_len < 2 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two, 2 or more")
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("doc_tokens", T.LongType()), T.StructField("bucket", T.IntegerType())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        end = np.array([closing_id], dtype=np.uint32)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            first, held, tokens = 0, 0, []
            for i in range(len(texts)):
                tokens += [encode(texts[i].as_py() or ""), end]
                held += len(tokens[-2]) + 1
                if held >= FLUSH_TOKENS or i == len(texts) - 1:
                    yield _pieces(ids.slice(first, i + 1 - first), tokens, max_len)
                    first, held, tokens = i + 1, 0, []

    packed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(pieces, schema)
    return packed.select(F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens", "bucket",
                         F.monotonically_increasing_id().alias("sequence_id"),
                         F.lit(0).cast("long").alias("offset"))


def _pieces(ids: pa.Array, tokens: list[np.ndarray], max_len: int) -> pa.RecordBatch:
    """``tokens``: for each document its ids, then the closing id."""
    sizes = [len(t) + 1 for t in tokens[::2]]
    cut = [piece_lengths(n, max_len) for n in sizes]
    counts = np.array([len(c) for c in cut])
    lengths = np.array([x for c in cut for x in c], dtype=np.int64)
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(sizes)), counts)
    doc_start = np.cumsum(sizes) - sizes
    buffer = np.concatenate(tokens).astype("<u4", copy=False)
    offsets = np.concatenate(([0], ends * 4)).astype(np.int32)
    blob = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)])
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(doc)), pa.array(ends - lengths - doc_start[doc]), pa.array(lengths), blob,
         pa.array(np.array(sizes, dtype=np.int64)[doc]),
         pa.array(np.log2(lengths).astype(np.int32))],
        names=["id", "start", "length", "ids", "doc_tokens", "bucket"])


def write_buckets(packed: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length, ready for batches of equal length."""
    packed.write.partitionBy("bucket").parquet(path)
