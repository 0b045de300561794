"""The Merkle manifest against a plain tree in Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_plain import DOCS_DDL, lower
from settleframe.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(hashes):
    """(top, path of each: (before, after) per level)."""
    paths, nodes, at = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // 8 * 8: k // 8 * 8 + 8]
            paths[i].append(("".join(run[:k % 8]), "".join(run[k % 8 + 1:])))
        nodes = [h("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
        at = [k // 8 for k in at]
    return nodes[0], paths


def plain(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    by_lang = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = lambda t: h("".join(map(field, (doc_id, source, lang, n_chars, t))))  # noqa: E731, B023
        hit = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        by_lang[lang].append(((doc_id is not None, doc_id or 0, leaf(text)), doc_id, leaf(lower(text)) if hit else leaf(text)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[0])
        trees[lang] = tree([x[0][2] for x in by_lang[lang]])
    root, above = tree([trees[lang][0] for lang in langs]) if langs else (None, [])
    out = []
    for lang, up in zip(langs, above, strict=True):
        subroot, paths = trees[lang]
        for (key, doc_id, start), path in zip(by_lang[lang], paths, strict=True):
            folded = start
            for before, after in path + up:
                folded = h(before + folded + after)
            out.append((doc_id, key[2], subroot, root, h("".join(b + a for b, a in path + up)), folded, folded == root))
    return out


def found(df):
    assert df.columns == COLUMNS
    return Counter(map(tuple, df.collect()))


def test_odd_rows(spark, odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert found(merkle.tamper_test(odd)) == Counter(plain(rows))


def test_no_rows(no_docs):
    assert found(merkle.tamper_test(no_docs)) == Counter()


def test_one_row(spark):
    rows = [(7, "Only ONE", "en", "a", 3)]
    got = found(merkle.tamper_test(spark.createDataFrame(rows, DOCS_DDL)))
    assert got == Counter(plain(rows))
    (doc_id, leaf, subroot, root, proof, *_), = got
    assert leaf == subroot == root and proof == h("")


@pytest.mark.parametrize("sizes", [(8, 9), (512, 513, 1), (4097,), (1,) * 70])
def test_sizes_around_runs_and_blocks(spark, sizes):
    """Full and broken runs, blocks and levels; more languages than a run holds."""
    rows = [(1000 * k + i * 7 % n, f"Text {i}", None if k == 1 else f"l{k}", "s", i) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, DOCS_DDL).repartition(5, "n_chars")
    assert found(merkle.tamper_test(df)) == Counter(plain(rows))


def test_equal_rows_are_a_third(spark):
    rows = [(5, "same TEXT", "en", "a", 1)] * 900 + [(i, f"Text {i}", "en", "a", i) for i in range(1800)]
    assert found(merkle.tamper_test(spark.createDataFrame(rows, DOCS_DDL).repartition(4))) == Counter(plain(rows))


def test_proofs_find_every_change(spark):
    """A path proves its own row alone: any other text leads to another root."""
    rows = [(i, f"text {i}", "en", "a", i) for i in range(100)]
    df = merkle.manifest(spark.createDataFrame(rows, DOCS_DDL), F.concat("text", F.lit("!")))
    got = df.select((merkle.fold(F.col("path"), F.col("leaf")) == F.col("root")).alias("right"),
                    (merkle.fold(F.col("path"), F.col("other")) == F.col("root")).alias("wrong")).collect()
    assert all(r.right and not r.wrong for r in got)
