"""Exact dedup and Jaccard join against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from settleframe.llm import exact_dedup, jaccard_join
from settleframe.llm.bloom import SEGMENT_BITS, BloomFilter
from settleframe.llm.components import components

from llm_plain import lower, prose, words


def plain_dedup(rows):
    """(doc_id, text) -> Counter of (doc_id, keep_id, group_size, kept, sha)."""
    groups = {}
    for doc_id, text in rows:
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()
        groups.setdefault(key, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = Counter()
    for sha, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for i, m in enumerate(members):
            out[m[3], members[0][3], len(members), i == 0, sha] += 1
    return out


def test_exact_dedup(odd, docs, no_docs):
    for df in (odd, docs, no_docs):
        got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.decide(df).collect())
        assert got == plain_dedup([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_exact_dedup_full_filter_changes_nothing(odd):
    """A saturated filter sends more rows the exact way, with the same result."""
    a = exact_dedup.decide(odd, max_filter_bits=SEGMENT_BITS).drop("shuffled")
    b = exact_dedup.decide(odd).drop("shuffled")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_exact_dedup_only_repeats_shuffle(docs):
    rows = exact_dedup.decide(docs).collect()
    assert all(r.shuffled for r in rows if r.group_size > 1)
    assert sum(r.shuffled for r in rows if r.group_size == 1) < 0.05 * len(rows)


def test_deduplicate_keeps_columns_and_one_row_each(odd, no_docs):
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    want = plain_dedup([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert Counter(r.doc_id for r in kept.collect()) == sum((Counter({k[0]: n}) for k, n in want.items() if k[3]), Counter())
    assert exact_dedup.deduplicate(no_docs).count() == 0


def test_bloom_finds_all_repeats(spark):
    rng = np.random.default_rng(1)
    once, twice = rng.integers(-2**63, 2**63 - 1, 5000), rng.integers(-2**63, 2**63 - 1, 500)
    df = spark.createDataFrame([(int(x),) for x in [*once, *twice, *twice]], "h long").repartition(5)
    bloom = BloomFilter.build(df, "h", 6000)
    from pyspark.sql import functions as F

    flagged = {r.h for r in df.filter(bloom.repeated(F.col("h"))).collect()}
    assert set(map(int, twice)) <= flagged
    assert len(flagged) < 500 + 250
    assert df.filter(~bloom.member(F.col("h"))).count() == 0


def shingles(text, k=4):
    ws = words(lower(text))
    return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else ({tuple(ws)} if ws else set())


def plain_components(rows, k=4, percent=85):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def check_components(df, **options):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.document_components(df, **options).collect())
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert got == plain_components(rows, options.get("shingle", 4))


def test_jaccard_odd_rows(odd, no_docs):
    check_components(odd)
    assert jaccard_join.document_components(no_docs).count() == 0


@pytest.fixture(scope="module")
def families(spark):
    """Families of near copies with edits around the threshold, chains, and a
    passage that many documents share."""
    rng, rows = random.Random(11), []
    passage = prose(rng, 40, 10**6)
    for f in range(12):
        base = prose(rng, 150, 10**6).split()
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
        if f < 4:  # a chain: each member differs a little from the one before
            for _ in range(8):
                base[rng.randrange(len(base))] = f"c{rng.randrange(10**6)}"
                rows.append((len(rows), " ".join(base)))
    rows += [(len(rows) + i, f"{prose(rng, 30, 10**6)} {passage} {prose(rng, 10, 10**6)}") for i in range(40)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_jaccard_families(families):
    check_components(families)
    check_components(families, leaders=())     # everything by the pairwise remainder
    check_components(families, orders=1)     # the other orders only filter


def test_drop_near_duplicates(odd, families, no_docs):
    for df in (odd, families):
        kept = jaccard_join.drop_near_duplicates(df)
        assert kept.columns == df.columns
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        want = plain_components(rows)
        full = {c for (d, n, c) in want if n}
        empty = sum(k for (d, n, c), k in want.items() if not n)
        assert kept.count() == len(full) + empty
    assert jaccard_join.drop_near_duplicates(no_docs).count() == 0


def test_components(spark):
    rng, parent = random.Random(2), {i: i for i in range(200)}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(0, i) for i in range(100, 130)] + [(5, 5)]
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.u: r.v for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: find(i) for i in range(200) if find(i) != i}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_signatures_bound_the_difference():
    """Differing bits never exceed the difference of two sets, also folded to the shorter one."""
    rng = np.random.default_rng(3)
    for n, m, common in [(1, 1, 0), (3, 4, 3), (100, 120, 90), (900, 1100, 800), (40_000, 45_000, 39_000)]:
        pool = rng.integers(0, 2**63, n + m, dtype=np.int64).astype(np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:common], pool[n:n + m - common]]))
        x, y = (np.unpackbits(jaccard_join.signature(s).view(np.uint8), bitorder="little") for s in (a, b))
        size = min(len(x), len(y))
        x, y = (s.reshape(-1, size).max(axis=0) for s in (x, y))
        assert (x != y).sum() <= len(np.setxor1d(a, b))
        assert not (jaccard_join.signature(a) != jaccard_join.signature(a[::-1])).any()


def test_near_keeps_every_link_of_any_size(spark):
    rng = np.random.default_rng(4)
    rows, linked = [], set()
    for i in range(60):
        n = int(rng.integers(1, 3000))
        base = np.unique(rng.integers(0, 2**63, n, dtype=np.int64))
        other = np.unique(np.concatenate([base[: int(len(base) * rng.uniform(0.8, 1))], rng.integers(0, 2**63, int(rng.integers(0, n // 10 + 1)), dtype=np.int64)]))
        both = len(np.intersect1d(base, other))
        if 100 * both >= 85 * (len(base) + len(other) - both):
            linked.add((2 * i, 2 * i + 1))
        rows += [(2 * i + k, len(s), jaccard_join.signature(s.view(np.uint64)).tolist()) for k, s in ((0, base), (1, other))]
    signatures = spark.createDataFrame(rows, "sid long, n int, signature array<long>")
    found = spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(60)], "x long, y long")
    sizes = {r[0]: r[1] for r in rows}
    found = found.filter(F.col("x").isin([x for x in range(0, 120, 2) if 100 * min(sizes[x], sizes[x + 1]) >= 85 * max(sizes[x], sizes[x + 1])]))
    kept = {(r.x, r.y) for r in jaccard_join._near(found, signatures, 85).collect()}
    assert linked <= kept and len(linked) > 5


def test_pairs_of_a_group_are_made_at_their_first_common_token(spark):
    """Sets that share runs of tokens, with own tokens between, also more than the
    remembered ones: every pair is made at its first common token, and again only
    behind a run of own tokens longer than that."""
    rng, sets = random.Random(5), {}
    for sid in range(30):
        own = {t: 1000 * (sid + 1) + t for t in range(60) if rng.random() < 0.3 or (sid % 3 == 0 and 20 <= t < 35)}
        sets[sid] = [own.get(t, t) for t in range(60)]
    rows = [(t, sid, 400, at, sid) for sid, tokens in sets.items() for at, t in enumerate(tokens)]
    df = spark.createDataFrame(rows, "token long, sid long, n int, at int, component long")
    made = Counter((r.x, r.y) for r in jaccard_join._apart(jaccard_join._preceded(df), 60).collect())
    before = lambda sid, at: set(sets[sid][max(0, at - jaccard_join.BEFORE):at])
    assert made == Counter((x, y) for x in sets for y in sets if x < y
                           for at in range(60) if sets[x][at] == sets[y][at] and not before(x, at) & before(y, at))
    assert set(made) == {(x, y) for x in sets for y in sets if x < y and set(sets[x]) & set(sets[y])}
    assert sum(made.values()) < sum(len(set(sets[x]) & set(sets[y])) for x, y in made) / 5


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(6)
    for n, m, common in [(1, 1, 0), (3, 4, 3), (100, 120, 90), (900, 1100, 800), (5000, 5000, 0)]:
        pool = rng.integers(0, 2**63, n + m, dtype=np.int64).astype(np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:common], pool[n:n + m - common]]))
        x, y = jaccard_join.parity_sketch(a), jaccard_join.parity_sketch(b)
        assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= len(np.setxor1d(a, b))
        assert not (x != jaccard_join.parity_sketch(a[::-1])).any()


def test_remainder_makes_only_pairs_with_near_sketches(spark):
    """Sets about one base that are just too far from each other, and a few that are linked."""
    rng = np.random.default_rng(7)
    base, sets = rng.integers(0, 2**63, 100, dtype=np.int64), {}
    for sid in range(60):
        edits = 20 if sid < 50 else 4     # 40 or 8 tokens differ between two, of 200: 17 may at 85
        sets[sid] = np.unique(np.concatenate([rng.permutation(base)[edits:], rng.integers(0, 2**63, edits, dtype=np.int64)])).view(np.uint64)
    struct = lambda s: {f"s{i}": int(x) for i, x in enumerate(jaccard_join.parity_sketch(s))}
    ddl = ", ".join(f"s{i}: long" for i in range(jaccard_join.SKETCH_BITS // 64))
    rows = [(1, sid, len(s), 0, sid, struct(s)) for sid, s in sets.items()]
    df = spark.createDataFrame(rows, f"token long, sid long, n int, at int, component long, sketch struct<{ddl}>")
    made = {(r.x, r.y) for r in jaccard_join._apart(jaccard_join._preceded(df), 85).collect()}
    alike = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
    linked = {(x, y) for x in sets for y in sets if x < y and alike(sets[x], sets[y])}
    assert linked <= made and len(linked) >= 40
    assert len(made) < 200                # of 1,770


def recorded(monkeypatch):
    kept, stored = {}, jaccard_join._stored

    def record(df, label, *args):
        out = stored(df, label, *args)
        kept.setdefault(label, []).append(out)
        return out
    monkeypatch.setattr(jaccard_join, "_stored", record)
    return kept


def test_groups_whose_pairs_have_been_compared_are_left_out(spark, monkeypatch):
    """Pairs of documents that share most of their text, but not enough, are compared once."""
    rng, rows = random.Random(8), []
    for i in range(30):
        passage = prose(rng, 88, 10**6)      # 85 of 105 shingles
        rows += [(2 * i + j, f"{passage} {prose(rng, 10, 10**6)}") for j in (0, 1)]
    kept = recorded(monkeypatch)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_components(df)
    groups = [x.count() for x in kept["open"]]
    assert groups[0] > 30 and not any(groups[1:])


def test_only_sets_of_candidates_are_made_again(spark, monkeypatch):
    """Whole sets are neither stored nor made for documents that share a passage only."""
    rng, rows = random.Random(9), []
    passage = prose(rng, 40, 10**6)
    rows = [(i, f"{passage} {prose(rng, 60, 10**6)}") for i in range(40)]
    words_ = prose(rng, 100, 10**6).split()
    rows += [(100 + i, " ".join([*words_[:-1], f"x{i}"])) for i in range(3)]
    made, verified = [], jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda found, sets, percent: made.append(sets.count()) or verified(found, sets, percent))
    kept = recorded(monkeypatch)
    check_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert max(made) <= 8
    assert not any("tokens" in x.columns for tables in kept.values() for x in tables)


def test_filters_reach_the_driver_in_a_few_jobs(spark):
    """Not in one for each of the shuffle's partitions."""
    df = spark.range(0, 2000, 1, 4).select(F.xxhash64("id").alias("h"))
    was, sc = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}, spark.sparkContext
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sc.setJobGroup("filter-test", "filter-test")
        bloom = BloomFilter.build(df, "h", 2000)
        assert len(sc.statusTracker().getJobIdsForGroup("filter-test")) < 20
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in was.items():
            spark.conf.set(k, v)
    assert df.filter(~bloom.member(F.col("h"))).count() == 0
