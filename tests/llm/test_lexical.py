"""Operator 11: ranked lexical search by a hybrid of term-at-a-time and document-at-a-time."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import lexical
from ledgerlens.llm.common import ship_package

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, q long, term string, segment long, score long"
ITEMS = "item_id long, text string, q long, term string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if t is not None]
    n_docs, n_terms = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        ask, scored = Counter(terms(text)), []
        for place, (i, bag, n) in enumerate(bags):
            score = 0
            for t, times in ask.items():
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * (25 + 75 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, i is None, i or 0, place, i))
        out += [(item, r, x[4], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    ship_package(spark)
    d = spark.createDataFrame([(i, t, 1, "clash", 2, 3) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 1, "clash") for i, t in items], ITEMS)
    return sorted(map(tuple, lexical.search(d, q, **options).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(n, seed=3):
    r = np.random.default_rng(seed)
    words = np.array([f"w{i}" for i in range(400)])
    weights = 1 / np.arange(1, 401)
    return [(i, " ".join(r.choice(words, r.integers(1, 40), p=weights / weights.sum()))) for i in range(n)]


def test_matches_brute_force(spark):
    docs, items = corpus(600), [(i, t) for i, t in corpus(12, seed=8)]
    assert got(spark, docs, items) == brute(docs, items)


def test_blocks_segments_and_short_lists_do_not_change_the_result(spark, monkeypatch):
    docs, items = corpus(300), [(i, t) for i, t in corpus(9, seed=8)]
    monkeypatch.setattr(lexical, "SHORT", 20)
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", 32)
    assert got(spark, docs, items, block=2, k=4) == brute(docs, items, k=4)


@pytest.mark.parametrize("short", [0, 30, 10_000])
@pytest.mark.parametrize("window", [3, 64])
def test_hybrid_loop_equals_sums_over_all_lists(short, window):
    r = np.random.default_rng(short + window)
    for _ in range(60):
        ids = r.permutation(500)
        lists = []
        for _ in range(r.integers(1, 9)):
            d = np.flatnonzero(r.random(500) < r.choice([0.01, 0.1, 0.9]))
            if len(d):
                lists.append((d, r.integers(1, r.choice([3, 1000]), len(d))))
        if not lists:
            continue
        sums = np.zeros(500, np.int64)
        for d, s in lists:
            sums[d] += s
        want = [d for d in np.lexsort((ids, -sums))[:10] if sums[d] > 0]
        docs, scores = lexical.best(lists, ids, 10, short, window)
        assert docs.tolist() == want and scores.tolist() == sums[want].tolist()


def test_odd_rows(spark):
    same = "alpha beta"
    docs = [(1, None), (2, ""), (3, " .,; "), (9, same), (None, same), (None, same), (4, same), (4, same), (7, "ALPHA alpha É é"), (8, "x" * 300_000 + " beta"), (10, "zeta")]
    items = [(1, "alpha, Beta! beta"), (1, "É"), (None, "é"), (5, None), (6, ""), (7, "nowhere"), (8, "x" * 300_000)]
    assert got(spark, docs, items) == brute(docs, items)


def test_a_word_of_every_document_and_ties(spark):
    docs = [(i, "the") for i in range(400)] + [(1000 + i, f"the rare{i}") for i in range(30)]
    items = [(1, "the"), (2, "the rare7")]
    assert got(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == [] and got(spark, [(1, "a")], []) == []
