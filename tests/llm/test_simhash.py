"""Operator 7: fingerprints against plain Python, components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from ledgerlens.llm import simhash
from ledgerlens.llm.components import components

SCHEMA = "doc_id long, text string, fp long, tile int"
rng = random.Random(3)
VOCAB = ["alpha", "Beta", "gamma", "délta", "eps", "zeta", "eta", "theta", "iota", "kappa"]


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))


def brute_components(ids, fps):
    root = list(range(len(fps)))
    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                root[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        least[top(i)] = min(least.get(top(i), d), d)
    return [least[top(i)] for i in range(len(fps))]


def corpus():
    texts = [None, "", " \t\n", "one", "two words", "One", "x" * 60_000, "a\x85b c d e", "the \x1c same \x0b line"]
    for _ in range(40):
        base = [rng.choice(VOCAB) + str(rng.randrange(50)) for _ in range(rng.choice([5, 60, 300]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 3])):
            w = list(base)
            w[rng.randrange(len(w))] = "edit"
            texts.append("  ".join(w))
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


def test_fingerprints_and_components(spark):
    rows = corpus()
    got = simhash.classes(spark.createDataFrame([(i, t, 1, 1) for i, t in rows], SCHEMA)).collect()
    fps = [brute_print(t) for _, t in rows]
    want = dict(zip((i for i, _ in rows), zip(fps, brute_components([i for i, _ in rows], fps))))
    assert {r["__id"]: (r.fp % 2**64, r.component_id) for r in got} == want


def near_prints(n):
    out = set()
    for _ in range(n // 8):
        f = rng.getrandbits(64)
        for _ in range(8):
            g = f
            for _ in range(rng.randrange(5)):
                g ^= 1 << rng.randrange(64)
            out.add(g)
    return sorted(out)


@pytest.mark.parametrize("tile", [7, 10_000])
def test_tiles_lose_no_link(spark, tile):
    fps = near_prints(600)
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    found = {r.node: r.root for r in components(simhash.links(frame, 3, tile)).collect()}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    want = brute_components(signed, fps)
    assert [found.get(s, s) for s in signed] == want


def test_a_large_near_group_emits_a_forest_only():
    f = rng.getrandbits(64)
    group = np.array(sorted({f ^ (1 << i) for i in range(64)} | {f ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)}), np.uint64)
    a, b = simhash.forest(group, None, 3)
    assert len(a) == len(group) - 1


def test_one_of_each_group_stays(spark):
    rows = [(4, "same text here now", 0, 0), (2, "same text here now", 0, 0), (2, "same text here now", 0, 0), (9, None, 0, 0), (None, "", 0, 0), (None, "quite another thing here", 0, 0)]
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(2, "same text here now"), (9, None), (None, "quite another thing here")]
    assert kept.columns == ["doc_id", "text", "fp", "tile"]


def test_unlike_texts_with_null_or_equal_ids_stay(spark):
    texts = ["quite another thing here", "nothing like the rest of them", "a third text of its own kind"]
    rows = [(None, t, 0, 0) for t in texts] + [(None, texts[0], 0, 0), (5, "one text under number five", 0, 0), (5, "far away words share that id", 0, 0)]
    prints = [brute_print(t) for _, t, _, _ in rows]
    assert all(a == b or bin(a ^ b).count("1") > 3 for a in prints for b in prints)
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted({(r[0] or 0, r[1]) for r in rows})


def test_empty_table(spark):
    assert simhash.classes(spark.createDataFrame([], SCHEMA)).count() == 0
