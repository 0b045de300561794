"""Quality rules and licence scan against plain versions."""

import re
from collections import Counter

from settleframe.llm import license_scan, quality_rules

from llm_plain import lower, words


def plain_quality(text):
    ws = words(text)
    windows = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    covered = set()
    for i in range(len(ws) - 7):
        if windows[tuple(ws[i:i + 8])] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    n, rep = len(ws), len(covered)
    return (n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), rep,
            n < 20 or 100 * rep > 30 * n)


def check_quality(df):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality_rules.score_quality(df).collect())
    assert got == Counter((r.doc_id, *plain_quality(r.text)) for r in df.select("doc_id", "text").collect())


def test_quality_measures(odd, docs):
    check_quality(odd)
    check_quality(docs)


def test_quality_empty_table_and_verdict(odd, no_docs):
    assert quality_rules.score_quality(no_docs).count() == 0
    assert quality_rules.filter_documents(no_docs).columns == no_docs.columns
    rows = quality_rules.score_quality(odd).collect()
    assert all(not r.kept for r in rows if r.base_failed)
    assert all(r.kept == (r.failed_rules == "") for r in rows)
    kept = quality_rules.filter_documents(odd)
    assert kept.columns == odd.columns
    assert kept.count() == sum(r.kept for r in rows)


def test_quality_overlapping_and_touching_windows(spark):
    run = "a b c d e f g h"
    texts = [f"{run} {run}", f"{run} x {run}", " ".join(["z"] * 40), f"{run} i {run} i", run, f"{run} {run} {run}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check_quality(df)


def test_rules_use_no_python(odd):
    plan = quality_rules.score_quality(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def plain_base(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    at, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_base(odd, docs, no_docs):
    for df in (odd, docs):
        got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_scan.scan(df).collect())
        assert got == Counter((r.doc_id, *plain_base(r.text)) for r in df.select("doc_id", "text").collect())
    assert license_scan.scan(no_docs).count() == 0


def test_license_notice_with_edits(spark):
    mit = next(t for t in license_scan.TEMPLATES if t.name == "notice-mit")
    ws = mit.words
    inserted = ws[:30] + ["really", "and", "truly"] + ws[30:]     # moves the rest to another diagonal
    cut = ws[:12]
    df = spark.createDataFrame([
        (1, "some text before " + mit.text + " and after"), (2, "x " + " ".join(inserted)), (3, " ".join(cut)),
        (4, " ".join(reversed(ws))), (5, mit.text + " filler words here " + mit.text)], "doc_id long, text string")
    found = {r.doc_id: (r.labels, round(r.score, 2)) for r in license_scan.scan(df).collect()}
    assert found[1] == ("mit", 1.0) and found[5] == ("mit", 1.0)
    assert found[2][0] == "mit" and 0.8 < found[2][1] < 1
    assert found[3][0] == "" and found[4][0] == ""
    spans = [r for r in license_scan.spans(df).filter("template is not null and doc_id = 2").collect()]
    assert [(r.first, r["last"]) for r in spans] == [(1, len(inserted))]
    assert license_scan.spans(df).filter("template is not null and doc_id = 5").count() == 2


def test_license_notice_with_long_insertions(spark):
    """Up to the template's own length put in, at one place or several; whole notices
    that follow each other stay spans of their own."""
    mit = next(t for t in license_scan.TEMPLATES if t.name == "notice-mit")
    ws, other = mit.words, [f"w{i}" for i in range(200)]
    put = lambda n, *at: [w for i, x in enumerate(ws) for w in (other[:n] if i in at else []) + [x]]
    texts = {n: put(n, 33) for n in (1, 4, 5, 10, 20, 60)} | {
        100: put(150, 33),                      # two halves far apart: neither is a notice
        101: put(12, 15, 30, 45), 102: ws + ws, 103: ws + put(20, 33) + ws, 104: ["x"] + ws[:33] + ws[40:]}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(df).collect()}
    held = (len(ws) - 4 - 4) / (len(ws) - 4)    # an insertion breaks four 5-grams
    for n in (1, 4, 5, 10, 20, 60):
        assert found[n] == ("mit", held)
    assert found[100] == ("", 0.0)
    assert found[101] == ("mit", (len(ws) - 16) / (len(ws) - 4))
    spans = Counter()
    for r in license_scan.spans(df).filter("notice").collect():
        spans[r.doc_id, r.first, r["last"]] += 1
    n = len(ws)
    assert set(spans.values()) == {1}
    assert {k[1:] for k in spans if k[0] == 20} == {(0, n + 19)}
    assert {k[1:] for k in spans if k[0] == 102} == {(0, n - 1), (n, 2 * n - 1)}
    assert {k[1:] for k in spans if k[0] == 103} == {(0, n - 1), (n, 2 * n + 19), (2 * n + 20, 3 * n + 19)}
    assert {k[1:] for k in spans if k[0] == 104} == {(1, n - 7)}
