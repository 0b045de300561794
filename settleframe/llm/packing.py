"""Packing by power-of-two decomposition.

A document's ids (with the end id) are cut into pieces whose lengths are powers
of two: as many whole ``max_length`` pieces as fit, then the binary digits of the
rest, longest first. Pieces of equal length form a bucket; every piece is a
sequence of its own, so no sequence crosses documents and, the lengths being
powers of two, none is padded. Sequences are numbered bucket by bucket. Work is one
pass over the documents without a shuffle; ``write_buckets`` lays the sequences out
by length, one folder for each bucket.

Defined results: a null or empty text is the end id alone (one piece of length
1). Repeated rows are packed each. A very long text is tokenised alone; one with a
blank run that is too long for the faster encoder is left to the slower one. An empty
table gives no rows. Sequence ids are the bucket, the task's number and a count within
both, so they are unique and the same in a rerun over the same splits.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from settleframe.llm.arrays import slices
from settleframe.llm.workers import ship

MAX_LENGTH = 1024
END_ID = 0

# Fixed value: the pattern by which this kind of vocabulary splits a text.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies use: printable
    Latin-1 bytes stand for themselves, the others take code points from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteTokenizer:
    """Ids of a byte-level BPE file in the ``tokenizers`` format, as packed
    little-endian 32-bit ids. The vocabulary and the added tokens of the file are
    handed to the faster ``tiktoken`` encoder; a text that holds an added token
    literally gets its id, as in ``tokenizers``. The tests hold the ids against it."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        bound = any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        if model["type"] != "BPE" or spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or bound:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        chars = byte_characters()
        ranks = {bytes(chars[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        self._encoding = tiktoken.Encoding("file", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self._path, self._slower = path, None

    def encode(self, text: str) -> bytes:
        try:
            ids = self._encoding.encode(text, allowed_special="all")
        except ValueError:   # its pattern tracks back over blanks, some 400,000 at most
            ids = self._encode_slower(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_slower(self, text: str) -> list[int]:
        if self._slower is None:
            from tokenizers import Tokenizer

            self._slower = Tokenizer.from_file(self._path)
        return self._slower.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteTokenizer:
    """One per worker and file."""
    return ByteTokenizer(path)


def piece_lengths(tokens: int, max_length: int = MAX_LENGTH) -> list[int]:
    """Powers of two that sum to ``tokens``, longest first, none over ``max_length``."""
    rest = tokens % max_length
    return [max_length] * (tokens // max_length) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


_FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _packer(path: str, max_length: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokenizer(path).encode, struct.pack("<I", end_id)
        task = TaskContext.get().partitionId() << 33
        count = dict.fromkeys((1 << k for k in range(max_length.bit_length())), 0)   # sequences of each bucket
        for batch in batches:
            for piece in slices(batch):
                rows: dict[str, list] = {f: [] for f in _FIELDS}
                ids: list[bytes] = []
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    raw = encode(text or "") + end
                    lengths = piece_lengths(len(raw) // 4, max_length)
                    at = 0
                    for n in lengths:
                        own = raw[4 * at: 4 * (at + n)]
                        rows["sequence_id"].append((n.bit_length() - 1) << 57 | task | count[n])
                        count[n] += 1
                        rows["start"].append(at)
                        rows["ids_crc32"].append(zlib.crc32(own))
                        if keep_ids:
                            ids.append(own)
                        at += n
                    k = len(lengths)
                    rows["doc_id"] += [doc_id] * k
                    rows["length"] += lengths
                    rows["doc_tokens"] += [at] * k
                    rows["offset"] += [0] * k
                arrays = [pa.array(rows[f], pa.int64()) for f in _FIELDS] + ([pa.array(ids, pa.binary())] if keep_ids else [])
                yield pa.RecordBatch.from_arrays(arrays, [*_FIELDS, *(["ids"] if keep_ids else [])])
    return run


def pack(docs: DataFrame, tokenizer_path: str, max_length: int = MAX_LENGTH, end_id: int = END_ID,
         keep_ids: bool = False, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``keep_ids`` the ids themselves (binary,
    little-endian 32-bit)."""
    if max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    ship(docs.sparkSession)
    schema = StructType([StructField(f, LongType()) for f in _FIELDS] + ([StructField("ids", BinaryType())] if keep_ids else []))
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return slim.mapInArrow(_packer(tokenizer_path, max_length, end_id, keep_ids), schema)


def write_buckets(docs: DataFrame, path: str, tokenizer_path: str, **options) -> None:
    """Sequences with their ids, one folder per length: a training job reads a
    folder as batches of equal length."""
    pack(docs, tokenizer_path, keep_ids=True, **options).write.partitionBy("length").parquet(path)
