"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm_plain import DOCS_DDL, lower
from settleframe.llm import phrases

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower(text))]


def plain(rows, min_count, top=2000):
    """rows: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text or ""):
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    inside = set()
    for (lang, words), a in candidates.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = lang, words[i:i + k]
                if candidates.get(part) is not None and 100 * a >= 100 * candidates[part]:
                    inside.add(part)
    found = []
    for (lang, words), a in candidates.items():
        if (lang, words) not in inside:
            score, k = min((1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
            found.append((lang, -score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    out, ranks = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return out


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def rows_of(df):
    return [tuple(r) for r in df.select("text", "lang").collect()]


@pytest.mark.parametrize("min_count", [1, 3, 25])
def test_odd_rows(odd, min_count):
    short = odd.filter("length(text) < 20000 or text is null")
    assert found(phrases.mine(short, min_count, 100)) == sorted(plain(rows_of(short), min_count, 100))


def test_long_text(odd):
    assert found(phrases.mine(odd, 5)) == sorted(plain(rows_of(odd), 5))


def test_no_rows(no_docs):
    assert found(phrases.mine(no_docs)) == []


def test_documents(docs):
    assert found(phrases.mine(docs, 20)) == sorted(plain(rows_of(docs), 20))


@pytest.fixture
def many_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_hot_words_over_many_ranges(spark, many_ranges):
    """A pair begins a third of all windows and ranges end within its phrases; some
    phrases overlap themselves, words sort below a space or hold accents."""
    rng = random.Random(9)
    words = ["of", "the", "a", "é", "ß\x01", "x\x00", "zz", "of\x02"]
    rows = []
    for i in range(300):
        text = " ".join("of the" if rng.random() < 0.4 else rng.choice(words) for _ in range(60))
        rows.append((i, text + rng.choice([".", "! ", "\n", ""]) + "ha ha ha ha ha ha", rng.choice(["en", "en", "de", None, "und"]), None, None))
    df = spark.createDataFrame(rows, DOCS_DDL).repartition(6)
    assert found(phrases.mine(df, 4)) == sorted(plain([(r[1], r[2]) for r in rows], 4))


def test_windows_flushed_early(spark, monkeypatch, docs):
    """Workers get the package as shipped, so the small bounds are tried in this process."""
    texts = [r.text or "" for r in docs.limit(40).collect()]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    everything = np.full(1 << 13, 255, np.uint8)

    class Held:
        value = everything

    def count():
        total = Counter()
        for b in phrases._windows([Held] * 2, 16)(iter([batch.slice(i, 5) for i in range(0, len(texts), 5)])):
            for p, n in zip(b.column("phrase").to_pylist(), b.column("n").to_pylist(), strict=True):
                total[p] += n
        return total

    whole = count()
    monkeypatch.setattr(phrases, "HELD_WINDOWS", 50)
    assert count() == whole
    assert whole[""] == sum(len(w) for t in texts for w in pieces(t))


def test_splitting():
    texts = ["A b,c  D\te.", "", None, ".x", "é!É", "one two", "three"]
    got = phrases.split_pieces(pa.array(texts, pa.string()))
    words = [got.raw[a:b].tobytes().decode() for a, b in zip(got.start, got.end, strict=True)]
    expected = [p for t in texts for p in pieces(t or "") if p]
    assert words == [w for p in expected for w in p]
    assert got.left.tolist() == [len(p) - i for p in expected for i in range(len(p))]


def test_exact_beyond_64_bits(spark):
    """Scores come from 38-digit products."""
    a, n, part = 10**15, 9 * 10**17, 10**15 + 1
    row = spark.sql(f"select (cast(1000 * {a}L as decimal(19,0)) * cast({n}L as decimal(19,0))) div "
                    f"(cast({part}L as decimal(19,0)) * cast({part}L as decimal(19,0))) as s").first()
    assert row.s == 1000 * a * n // (part * part)
