"""Token files: the ids of all documents, one after the other, with Elias-Fano coded
document boundaries.

Documents are dealt by ranges of their ids and sorted, so that the files, in the
order of the manifest, hold them in ascending order. A task encodes its texts and
writes files of a bounded size. A file is a header line (facts and the place of each
array) and

* the ids, in two bytes each where the vocabulary allows it, else four;
* the documents' ends within the file, a monotone sequence in Elias-Fano form:
  about two bits and the logarithm of the mean length for each, no table of 64-bit
  offsets. Its select structure gives any document's first and last id at once;
* the document ids less the smallest, another such sequence.

The manifest is a stored table with one row per file; only files of task attempts
that succeeded are in it. A file's first id counted over all files is a running sum
over the manifest.

The tokenizer's library runs on words, not on whole texts: a token never reaches across
ASCII white space, so a text's ids are those of its pieces between white space, and a
worker remembers the pieces it met (a bounded number; longer ones are not kept).

Defined results: a null or empty text is the end id alone. Null ids come first, then
ids ascend; rows of equal ids ascend by a hash of the text, repeated rows are
written each. A very long text may make a file of its own that is larger than the
bound. An empty table gives no files and no rows. Extra columns are not carried.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from settleframe.llm.arrays import slices
from settleframe.llm.elias_fano import EliasFano, from_arrays, pack_file
from settleframe.llm.packing import byte_characters
from settleframe.llm.warc import open_shared
from settleframe.llm.workers import ship
from settleframe.session import scratch_path

END_ID = 2
FILE_BYTES = 32 << 20     # ids of a file
KNOWN = 1 << 19           # pieces a worker remembers
KNOWN_BYTES = 64          # length of the longest
# A word of ASCII or Latin-1 letters and the punctuation behind it.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+)([.,;:!?]*)").fullmatch
_UNITS = {b: c for c, b in byte_characters().items()}   # how a byte-level vocabulary writes a byte
ID_SPAN = 1 << 62         # document ids of a file span less

MANIFEST = "part int, nth int, path string, documents long, tokens long"


class PieceEncoder(dict):
    """Ids of texts as packed little-endian numbers, by the ``tokenizers`` library.

    The dictionary holds the pieces met so far. The splitting rules make two of a word
    of Latin letters with punctuation behind it; such a word alone, in lower case, is
    one unit for the library's model. All other pieces are encoded by the library."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark deals out the work
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self.kind = "<u2" if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"

    def _pack(self, ids: list[int]) -> bytes:
        packed = array("H" if self.kind == "<u2" else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def __missing__(self, piece: bytes) -> bytes:
        plain = _PLAIN(piece)
        if plain is None:
            ids = self._pack(self._tokenizer.encode(piece.decode(), add_special_tokens=False).ids)
        elif plain[2]:
            ids = self[plain[1]] + self[plain[2]]
        else:
            unit = piece.decode().lower().encode().decode("latin-1").translate(_UNITS)
            ids = self._pack([t.id for t in self._model.tokenize(unit)])
        if len(piece) <= KNOWN_BYTES:
            if len(self) >= KNOWN:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        # bytes: split at [\x20\x09-\x0D] only
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One per worker and file."""
    return PieceEncoder(path)


def file_bytes(documents: list[tuple[int | None, bytes]], kind: str) -> bytes:
    """A file of documents (id, packed ids), in ascending order with null ids first."""
    ends = np.cumsum([len(ids) // np.dtype(kind).itemsize for _, ids in documents], dtype=np.uint64)
    keys = [d for d, _ in documents if d is not None]
    least = keys[0] if keys else 0
    bounds = EliasFano.encode(ends, int(ends[-1]) + 1)
    names = EliasFano.encode(np.array([k - least for k in keys], np.uint64), keys[-1] - least + 1 if keys else 1)
    arrays = {"ids": np.frombuffer(b"".join(ids for _, ids in documents), kind)}
    for prefix, ef in (("ends", bounds), ("names", names)):
        arrays |= {f"{prefix}_{k}": a for k, a in ef.arrays().items()}
    return pack_file(arrays, {"documents": len(documents), "nulls": len(documents) - len(keys), "least": least,
                              "ends": [bounds.n, bounds.low_bits], "names": [names.n, names.low_bits]})


class TokenFile:
    """Documents of one file, by place, by id or by token."""

    def __init__(self, data: pa.Buffer | bytes):
        raw = np.frombuffer(data, np.uint8)
        head = bytes(raw[: 1 << 16]).partition(b"\n")[0]
        spec = json.loads(head)
        at = lambda kind, n, place: raw[len(head) + 1 + place: len(head) + 1 + place + np.dtype(kind).itemsize * n].view(kind)
        arrays, facts = {name: at(*where) for name, where in spec["arrays"].items()}, spec["facts"]
        self.ids, self.documents, self._nulls, self._least = arrays["ids"], facts["documents"], facts["nulls"], facts["least"]
        self._ends, self._names = (from_arrays(arrays, k, *facts[k]) for k in ("ends", "names"))

    def bounds(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id and the one behind the last, of the documents at ``places``."""
        ends = self._ends.access(places).astype(np.int64)
        starts = np.where(places > 0, self._ends.access(np.maximum(places - 1, 0)).astype(np.int64), 0)
        return starts, ends

    def doc_ids(self, places: np.ndarray) -> list[int | None]:
        held = places[places >= self._nulls] - self._nulls
        known = iter(self._names.access(held).tolist() if len(held) else [])
        return [None if p < self._nulls else next(known) + self._least for p in places.tolist()]

    def place(self, doc_id: int) -> int | None:
        """Place of the first document with an id."""
        off = doc_id - self._least
        if not 0 <= off < ID_SPAN:
            return None
        at = int(self._names.search(np.array([off], np.uint64))[0])
        return None if at < 0 else at + self._nulls

    def at_token(self, tokens: np.ndarray) -> np.ndarray:
        """Places of the documents that hold the ids at ``tokens``: successor search."""
        lo, hi = np.zeros(len(tokens), np.int64), np.full(len(tokens), self.documents - 1)
        while (live := lo < hi).any():
            mid = (lo + hi) >> 1
            behind = self._ends.access(mid).astype(np.int64) <= tokens
            lo, hi = np.where(live & behind, mid + 1, lo), np.where(live & ~behind, mid, hi)
        return lo


def _writer(folder: str, tokenizer_path: str, end_id: int, file_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_shared(folder)
        pieces = encoder(tokenizer_path)
        encode, kind = pieces.encode, pieces.kind
        end, part = np.array([end_id], kind).tobytes(), TaskContext.get().partitionId()
        held: list[tuple[int | None, bytes]] = []
        size = nth = 0
        first = None

        def done() -> pa.RecordBatch:
            path = f"{uuid.uuid4().hex}.ids"
            with fs.open_output_stream(f"{base}/{path}", compression=None) as out:
                out.write(file_bytes(held, kind))
            row = [part], [nth], [path], [len(held)], [size // len(end)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                                              ["part", "nth", "path", "documents", "tokens"])

        for batch in batches:
            for piece in slices(batch):
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text"), strict=True):
                    ids = encode(text.as_buffer().to_pybytes()) if text.is_valid else b""
                    if held and (size >= file_size or first is not None and doc_id - first >= ID_SPAN):
                        yield done()
                        size, nth, first = 0, nth + 1, None
                    first = doc_id if first is None else first
                    held.append((doc_id, ids + end))
                    size += len(ids) + len(end)
        if held:
            yield done()
    return run


def write_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, file_size: int = FILE_BYTES,
                text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Write the documents' ids to files in ``folder``; the stored manifest, in the
    files' order: part, nth, path, documents, tokens, start (ids in all files before)."""
    spark = docs.sparkSession
    ship(spark)
    fs, base = open_shared(folder)
    fs.create_dir(base, recursive=True)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # The last key splits repeated rows; it is the same whenever the table is scanned.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    rows = rows.withColumns({"__h": order[1], "__tie": order[2]})
    order = [order[0], F.col("__h"), F.col("__tie")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    dealt.mapInArrow(_writer(folder, tokenizer_path, end_id, file_size), MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file; one task sums them up."""
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
            .withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))))


def open_file(folder: str, path: str) -> TokenFile:
    fs, base = open_shared(folder)
    with fs.open_input_file(f"{base}/{path}") as f:
        return TokenFile(f.read_buffer())


def _reader(folder: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, documents, tokens in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "documents", "tokens")), strict=True):
                file = open_file(folder, path)
                if (file.documents, len(file.ids)) != (documents, tokens):
                    raise ValueError(f"{path} holds {file.documents} documents of {len(file.ids)} ids, not {documents} of {tokens}")
                for a in range(0, documents, 4096):
                    places = np.arange(a, min(a + 4096, documents))
                    begins, ends = file.bounds(places)
                    own = [file.ids[i:j].astype("<u4").tobytes() for i, j in zip(begins, ends, strict=True)]
                    columns = [pa.array(file.doc_ids(places), pa.int64()), pa.array(begins + start), pa.array(ends - begins),
                               pa.array([zlib.crc32(x) for x in own], pa.int64()), *([pa.array(own, pa.binary())] if keep_ids else [])]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else [])])
    return run


def read_files(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32, and with ``keep_ids`` the ids (binary, little-endian 32-bit)."""
    ship(spark)
    manifest = read_manifest(spark, folder)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    files = max(1, spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").count())
    return manifest.select("path", "start", "documents", "tokens").repartition(files).mapInArrow(_reader(folder, keep_ids), schema)


def round_trip(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write the documents to a fresh folder under the shared work folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_files(docs, folder, tokenizer_path, **options)
    return read_files(docs.sparkSession, folder)
