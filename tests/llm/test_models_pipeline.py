"""Byte network, n-gram trie and the whole pipeline."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from llm_plain import SF, lower, prose, words
from settleframe.llm import byte_cnn, lm_trie
from settleframe.llm.arrays import split_words
from settleframe.llm.elias_fano import EliasFano, map_file, pack_file


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abAB \t\n\x0b\x1f éß日")), max_size=30) | st.none(), max_size=8))
def test_split_words(texts):
    got = split_words(pa.array(texts, pa.string()))
    plain = [words(lower(t)) for t in texts]
    assert got.counts.tolist() == [len(w) for w in plain]
    named = {}
    for h, w in zip(got.hashes.tolist(), [w for ws in plain for w in ws], strict=True):
        assert named.setdefault(w, h) == h
    assert len(set(named.values())) == len(named)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300), st.integers(0, 2**40), st.lists(st.integers(0, 2**41), max_size=30))
def test_elias_fano(values, more, asked):
    values = sorted(set(values))
    ef = EliasFano.encode(np.array(values, np.uint64), (values[-1] if values else 0) + more + 1)
    if values:
        assert ef.access(np.arange(len(values))).tolist() == values
    ask = np.array(asked + values, np.uint64)
    place = {v: i for i, v in enumerate(values)}
    assert ef.search(ask).tolist() == [place.get(int(x), -1) for x in ask]


def test_elias_fano_pointers_repeat(tmp_path):
    pointers = np.array([0, 0, 0, 3, 3, 9, 9], np.int64)
    ef = EliasFano.encode(pointers, 10)
    assert ef.access(np.arange(7)).tolist() == pointers.tolist()
    path = tmp_path / "f"
    path.write_bytes(pack_file(ef.arrays(), {"n": ef.n}))
    arrays, facts = map_file(str(path))
    assert facts == {"n": 7} and all((arrays[k] == a).all() for k, a in ef.arrays().items())


def plain_lm(rows, order=3, least=2):
    """The model of the docstring with Python dictionaries: (doc_id, text) -> scores."""
    tokens = [[*words(lower(t)), "\0end"] for _, t in rows]
    train = [t for (d, _), t in zip(rows, tokens, strict=True) if d is None or zlib.crc32(str(d).encode()) % 10 != 0]
    grams = [Counter(tuple(t[i:i + k]) for t in train for i in range(len(t) - k + 1)) for k in range(1, order + 1)]
    n, v = sum(grams[0].values()), len(grams[0])
    kept = [dict(grams[0])] + [{g: c for g, c in level.items() if c >= least} for level in grams[1:]]
    q = [{g: 2.0 ** (-min(255, max(0, round(-math.log2((c - 0.75) / kept[k - 1][g[:-1]]) * 10))) / 10) for g, c in kept[k].items()}
         for k in range(1, order)]
    back = []
    for level in q:
        held = Counter()
        for g, p in level.items():
            held[g[:-1]] += p
        back.append({g: 2.0 ** (-min(255, math.ceil(-math.log2(max(1 - s, 1e-3)) * 32 - 1e-9)) / 32) for g, s in held.items()})
    out = []
    for (d, _), t in zip(rows, tokens, strict=True):
        base = score = 0.0
        for i, w in enumerate(t):
            p = (grams[0][w,] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            for k in range(1, order):
                context = tuple(t[i - k:i]) if i >= k else None
                if context in kept[k - 1]:
                    p = q[k - 1].get((*context, w), 0.0) + back[k - 1].get(context, 1.0) * p
            score += math.log10(p)
        out.append((d, len(t), sum((w,) in kept[0] for w in t), n, base, score))
    return out


def check_lm(df, **options):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    key = lambda r: (str(r[0]), *r[1:4], round(r[4], 4))
    want = sorted(plain_lm(rows, options.get("order", 3)), key=key)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                  for r in lm_trie.train_and_score(df, **options).collect()), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-7, atol=1e-7)


def test_lm_against_dictionaries(odd, docs, no_docs):
    check_lm(odd)
    check_lm(docs)
    assert lm_trie.train_and_score(no_docs).count() == 0


def test_lm_many_segments(docs, monkeypatch):
    monkeypatch.setattr(lm_trie, "WORD_SEGMENT_BYTES", 1 << 16)
    monkeypatch.setattr(lm_trie, "MAX_HELD", 20_000)
    check_lm(docs)


def test_lm_orders(docs):
    check_lm(docs, order=2)
    check_lm(docs, order=4)


def test_lm_without_training_rows(spark):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    df = spark.createDataFrame([(held, "some words")], "doc_id long, text string")
    r = lm_trie.train_and_score(df).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and r.base_score == pytest.approx(0.0)


@given(st.lists(st.integers(0, 3000), min_size=1, max_size=20))
def test_chunks_cover_whole_texts(lengths):
    text, start = byte_cnn.chunk_starts(np.array(lengths))
    for i, n in enumerate(lengths):
        own = start[text == i]
        assert own[0] == 0 and (np.diff(own) == byte_cnn.CHUNK - byte_cnn.OVERLAP).all()
        assert own[-1] + byte_cnn.CHUNK >= n


def test_network_learns_and_generalises():
    rng = random.Random(4)
    make = lambda good: (prose(rng, rng.randrange(30, 300)) if good else
                         " ".join(f"{w}###" for w in prose(rng, rng.randrange(30, 300)).split())).encode()
    y = np.array([i % 4 > 0 for i in range(400)], np.float32)
    texts = [make(v) for v in y]
    net = byte_cnn.train(texts[:300], y[:300], float(y.mean()), steps=60)
    raw, offsets = np.frombuffer(b"".join(texts[300:]), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts[300:]])))
    p = byte_cnn.probabilities(net, raw, offsets)
    assert ((p >= 0.5) == y[300:]).mean() > 0.97
    one = byte_cnn.probabilities(net, np.frombuffer(texts[310], np.uint8), np.array([0, len(texts[310])]))
    assert one[0] == pytest.approx(p[10], rel=1e-4)    # a score does not depend on its neighbours


def test_classifier_held_out_accuracy_and_odd_rows(spark, odd, no_docs):
    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    net = byte_cnn.fit(docs, labels)
    scored = {r.doc_id: r for r in byte_cnn.score(docs, net).collect()}
    assert len(scored) == docs.count()
    test = [(r.quality, scored[r.doc_id].predicted) for r in labels.collect() if scored[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in scored.items())
    assert sum(a == b for a, b in test) / len(test) > 0.9
    rows = byte_cnn.score(odd, net).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert byte_cnn.score(no_docs, net).count() == 0


def test_classifier_without_labels(docs, spark):
    for rows in ([], [(1, None, 0)], [(d, 1, 0) for d in range(30)], [(5, 1, 0), (5, 0, 0)]):
        net = byte_cnn.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
        assert net.constant is not None
        assert {r.score for r in byte_cnn.score(docs, net).collect()} == {net.constant}


def test_pipeline_stages(spark, docs):
    from test_dedup_jaccard import plain_components, plain_dedup
    from test_mixing_sharding import check_mix
    from test_rules_license import plain_quality

    names, seen = [n for n, _ in corpus_pipeline.STAGES], {"documents": docs}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        at = seen[name] = spark.createDataFrame(stage(spark, at, SF).collect(), stage(spark, at, SF).schema)
        if name != names[-1]:
            assert at.columns == docs.columns
    pairs = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert not any(plain_quality(t)[5] for _, t in pairs(seen["quality_rules"]))
    assert set(pairs(seen["quality_rules"])) <= set(pairs(docs))
    kept = {k[0] for k in plain_dedup(pairs(seen["quality_rules"])) if k[3]}
    assert Counter(d for d, _ in pairs(seen["exact_dedup"])) == Counter(kept)
    groups = plain_components(pairs(seen["exact_dedup"]), k=5, percent=80)
    assert Counter(d for d, _ in pairs(seen["jaccard_join"])) == Counter({c for (_, n, c) in groups if n} | {d for (d, n, _) in groups if not n})
    want = Counter({r.doc_id: len(r.shards) for r in check_mix(seen["jaccard_join"], lambda *a: 10**9) if r.shards})
    assert Counter(d for d, _ in pairs(seen["mixing"])) == want
    assert Counter(r.doc_id for r in seen["packing"].filter("start = 0").collect()) == want
    whole = corpus_pipeline.run(spark, SF)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert whole.select(cols).exceptAll(seen["packing"].select(cols)).isEmpty() and whole.count() == seen["packing"].count()


def test_pipeline_empty(spark, no_docs):
    at = no_docs
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SF)
        assert out.count() == 0
        at = spark.createDataFrame([], out.schema)


def test_pipeline_drops_near_copies_from_four_fifths(spark):
    from llm_plain import DOCS_DDL

    base = [f"w{i}" for i in range(100)]
    changed = lambda at: " ".join("changed" if i in at else w for i, w in enumerate(base))
    texts = {1: " ".join(base), 2: changed({30, 60}),                              # 86 of 106 five-word shingles: 0.81
             3: " ".join(f"v{i}" for i in range(100)),
             4: " ".join("changed" if i in {20, 45, 70} else f"v{i}" for i in range(100))}   # 81 of 111: 0.73
    df = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in texts.items()], DOCS_DDL)
    stage = dict(corpus_pipeline.STAGES)["jaccard_join"]
    assert sorted(r.doc_id for r in stage(spark, df, SF).collect()) == [1, 3, 4]


def test_pipeline_jaccard_stage_against_plain_sets(spark, docs):
    from test_dedup_jaccard import plain_components

    stages = dict(corpus_pipeline.STAGES)
    before = stages["exact_dedup"](spark, stages["quality_rules"](spark, docs, SF), SF).collect()
    kept = stages["jaccard_join"](spark, spark.createDataFrame(before, docs.schema), SF)
    groups = plain_components([(r.doc_id, r.text) for r in before], k=5, percent=80)
    assert Counter(r.doc_id for r in kept.collect()) == Counter({c for (_, n, c) in groups if n} | {d for (d, n, _) in groups if not n})


def test_registered_lm_keeps_every_ngram(spark, docs):
    from settleframe.llm.catalog import op6_lm_trie

    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = {r[0]: r[1:] for r in plain_lm(rows, least=1)}
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in op6_lm_trie(spark, SF).collect()}
    assert got.keys() == want.keys() and len(got) == len(rows)
    assert all(g[:3] == want[d][:3] and np.allclose(g[3:], want[d][3:], rtol=1e-7, atol=1e-7) for d, g in got.items())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2000), min_size=2, max_size=300), st.integers(0, 2**20))
def test_elias_fano_neighbours_and_ranges(values, more):
    values = sorted(values)
    ef = EliasFano.encode(np.array(values, np.uint64), values[-1] + more + 1)
    one, two = ef.access_two(np.arange(len(values) - 1))
    assert one.tolist() == values[:-1] and two.tolist() == values[1:]
    below, through = ef._bucket(np.array([v >> ef.low_bits for v in values]))
    tops = [v >> ef.low_bits for v in values]
    assert below.tolist() == [sum(t < x for t in tops) for x in tops]
    assert through.tolist() == [sum(t <= x for t in tops) for x in tops]


@pytest.mark.parametrize("far", [0, 2**60])   # numbers that fit one key, and others
def test_lm_counts_by_file_and_key(far):
    rng = np.random.default_rng(5)
    file = rng.integers(0, 3, 2000) + far
    keys = (rng.integers(0, 50, 2000).astype(np.uint64) << np.uint64(42)) | rng.integers(0, 20, 2000).astype(np.uint64)
    counts = rng.integers(1, 9, 2000)
    assert (lm_trie._packed(file, (keys >> np.uint64(42)).astype(np.int64), np.ones(2000, np.int64))[0] is None) == bool(far)
    want = Counter()
    for f, k, c in zip(file.tolist(), keys.tolist(), counts.tolist(), strict=True):
        want[f, k] += c
    got = lm_trie._sum_by_file(file, keys, counts)
    assert list(zip(got[0].tolist(), got[1].tolist(), strict=True)) == sorted(want)
    assert got[2].tolist() == [want[k] for k in sorted(want)]
