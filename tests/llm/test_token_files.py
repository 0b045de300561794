"""Token files against the tokenizer run on whole texts."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_plain import DOCS_DDL
from settleframe.llm import token_files
from settleframe.llm.catalog import QUERIES, tokenizer_path
from settleframe.session import scratch_path

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def plain(rows, whole):
    """(doc_id, n_tokens, ids_crc32) of rows (doc_id, text), and the starts of rows whose id is alone."""
    encoded = [(d, whole(t)) for d, t in rows]
    starts = {d: sum(len(x) for e, x in encoded if e is None or d is not None and e < d)
              for d, n in Counter(d for d, _ in encoded).items() if n == 1}
    return Counter((d, len(x), crc(x)) for d, x in encoded), starts


def check(df, rows, whole):
    got = df.collect()
    expected, starts = plain(rows, whole)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    assert all(r.start == starts[r.doc_id] for r in got if r.doc_id in starts)
    ordered = sorted(got, key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:], strict=False))
    assert [r.doc_id or -1 for r in ordered] == sorted(r.doc_id or -1 for r in got)


@pytest.mark.parametrize("size", [token_files.FILE_BYTES, 100])
def test_odd_rows(spark, odd, whole, size):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    check(token_files.round_trip(odd, PATH, file_size=size), rows, whole)


def test_no_rows(no_docs):
    df = token_files.round_trip(no_docs, PATH)
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and not df.collect()


def test_registered_query(spark, docs, whole):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(QUERIES["op12_token_files"](spark, "/root/testdata/sf0.001"), rows, whole)


def test_pieces_equal_whole_texts(whole):
    """Any Unicode text: ids of its pieces between ASCII white space are those of the text."""
    rng = random.Random(5)
    ranges = [(0, 128), (0x80, 0x250), (0x300, 0x370), (0x370, 0x400), (0x600, 0x700), (0x1100, 0x1200), (0x2000, 0x2070),
              (0x3000, 0x3100), (0xAC00, 0xAD00), (0x1F300, 0x1F400)]
    spaces = " \t\n\x0b\x0c\r\x1c\x1f\x85\xa0 　"
    bits = ["<|endoftext|>", "<|startoftext|>", "'s", "I'LL", "İ", "Σς", "é", " ́", "12.5", "…", "\x00"]
    encode, texts = token_files.PieceEncoder(PATH), []
    for _ in range(3000):
        text = ""
        for _ in range(rng.randrange(12)):
            a, b = rng.choice(ranges)
            text += rng.choice([chr(rng.randrange(a, b)) * rng.randrange(1, 4), rng.choice(spaces), rng.choice(bits), "word"])
        texts.append(text)
    texts += [" " * 1_000_000, "\n" * 100_000, "a" * 100_000, "a b " * 50_000, "." * 70_000]
    texts += ["Word's", "it's,", "don't!?", "WORD!!", "a.b", "end...", "'s,", "..", "A1.", "I'm:", "straße,", "ÉCOLE!", "Ðéjà", "a×b", "÷,", "ÿ?", "e\u0301,", "x" * 100 + ".", "x" * 100]
    for text in texts:
        assert np.frombuffer(encode.encode(text.encode()), encode.kind).tolist() == whole(text)[:-1]


def test_file_lookups():
    rng = random.Random(6)
    ids = [None, None, -7, 0, 3, 3, 900, 2**40]
    documents = [(d, np.array([rng.randrange(40000) for _ in range(rng.randrange(1, 50))], "<u2").tobytes()) for d in ids]
    file = token_files.TokenFile(token_files.file_bytes(documents, "<u2"))
    starts, ends = file.bounds(np.arange(len(ids)))
    assert [file.ids[i:j].tobytes() for i, j in zip(starts, ends, strict=True)] == [x for _, x in documents]
    assert file.doc_ids(np.arange(len(ids))) == ids
    assert [file.place(d) for d in (-7, 0, 3, 900, 2**40, 5, -8, 2**41)] == [2, 3, 4, 6, 7, None, None, None]
    owner = [k for k, (a, b) in enumerate(zip(starts, ends, strict=True)) for _ in range(a, b)]
    assert file.at_token(np.arange(len(owner))).tolist() == owner


def test_boundaries_are_small():
    """About two bits and the logarithm of the mean length for each document."""
    documents = [(i, b"\0\0" * 300) for i in range(20_000)]
    size = len(token_files.file_bytes(documents, "<u2")) - 2 * 300 * 20_000
    assert size < 20_000 * 3   # 8 bytes each in a table of offsets, as much again for the ids


def test_ids_far_apart(spark, whole):
    rows = [(-2**63, "first"), (0, "middle"), (2**63 - 1, "last"), (None, "none")]
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS_DDL).coalesce(1)
    got = {r.doc_id: r for r in token_files.round_trip(df, PATH).collect()}
    assert [got[d].start for d, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))] == [0, 2, 4, 6]
    assert all(got[d].ids_crc32 == crc(whole(t)) for d, t in rows)


def test_equal_ids_are_a_third(spark, whole):
    rows = [(7, f"copy {i % 3}") for i in range(600)] + [(i + 10, f"text number {i}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(token_files.round_trip(df, PATH), rows, whole)
    path = scratch_path(spark, "token-files-ids")
    token_files.write_files(df, path, PATH)
    kept = token_files.read_files(spark, path, keep_ids=True).filter(F.col("doc_id") == 10).first()
    assert np.frombuffer(kept.ids, "<u4").tolist() == whole("text number 0")
