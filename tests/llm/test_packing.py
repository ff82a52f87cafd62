"""Operator 9: best fit against a linear search, constraints, nothing lost."""

import random
from collections import Counter, defaultdict

import pytest

from ledgerlens.llm.common import LAST_ID
from ledgerlens.llm.packing import BINS_PER_SHARD, pack_pieces, plan, sequences

SCHEMA = "doc_id long, text string, source string, cluster string, shard string, n long"
rng = random.Random(11)


def brute(pieces, capacity):
    bins, out = [], []
    for size, source, cluster in pieces:
        fit = [(capacity - sum(p[0] for p in b), k) for k, b in enumerate(bins)
               if sum(p[0] for p in b) + size <= capacity
               and not any((source is not None and p[1] == source) or (cluster is not None and p[2] == cluster) for p in b)]
        k = min(fit)[1] if fit else len(bins)
        if k == len(bins):
            bins.append([])
        out.append((k, sum(p[0] for p in bins[k])))
        bins[k].append((size, source, cluster))
    return out


@pytest.mark.parametrize("n_sources,n_clusters", [(1, 5), (4, 300), (50, 1), (10, 40)])
def test_tightest_compatible_bin(n_sources, n_clusters):
    pieces = [(rng.randrange(0, 101), rng.choice([None, *range(n_sources)]), rng.choice([None, *range(n_clusters)])) for _ in range(300)]
    assert pack_pieces(pieces, 100) == brute(pieces, 100)


def test_runs_of_equal_pieces():
    pieces = [(rng.randrange(0, 60), rng.choice([None, *range(3)]), rng.choice([None, *range(9)])) for _ in range(60)]
    pieces = [p for p in pieces for _ in range(rng.randrange(1, 9))]
    assert pack_pieces(pieces, 100) == brute(pieces, 100)


def corpus():
    rows = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.choice([0, 1, 7, 20, 55, 230]))), rng.choice(["hot", "hot", "a", "b", None])) for i in range(200)]
    rows += [(900 + i, "Copied text, of five words", "hot" if i % 2 else f"s{i}") for i in range(40)]
    return rows + [(None, None, None), (None, "null id", "a"), (5, rows[5][1], rows[5][2]), (777, "y " * 30_000, "a")]


@pytest.mark.parametrize("shard_rows", [64, 10_000])
def test_constraints_and_nothing_lost(spark, shard_rows):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, s, "clash", "x", 5) for i, t, s in rows], SCHEMA)
    packed = plan(docs, capacity=50, shard_rows=shard_rows)
    got = packed.collect()
    text = {i: t or "" for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    per_bin = defaultdict(list)
    for r in got:
        per_bin[r.bin_id].append(r)
    for b in per_bin.values():
        assert sum(r.n_words for r in b) == b[0].bin_words <= 50
        at = 0
        for r in sorted(b, key=lambda r: (r.bin_start, r.n_words)):
            assert r.bin_start == at
            at += r.n_words
        known = [source[r.doc_id] for r in b if r.doc_id is not None and source[r.doc_id] is not None]
        assert len(known) == len(set(known))
        assert sum(r.doc_id is not None and 900 <= r.doc_id < 940 for r in b) <= 1
    words = defaultdict(int)
    for r in got:
        words[r.doc_id] += r.n_words
    want = defaultdict(int)
    for i, t, _ in rows:
        want[i] += len((t or "").split())
    assert words == want and len({(r.doc_id, r.text_hash) for r in got}) == len(rows) - 1
    whole = {r.bin_id: r.text.split() for r in sequences(docs, packed).collect()}
    for r in got:
        if r.doc_id is not None:
            assert whole[r.bin_id][r.bin_start:r.bin_start + r.n_words] == text[r.doc_id].split()[r.piece_start:r.piece_start + r.n_words]


def test_equal_rows_go_to_all_shards(spark):
    """100,000 equal rows without an id: each in a bin of its own, as many in one shard as in another."""
    docs = spark.range(100_000, numPartitions=8).selectExpr("cast(null as long) doc_id", "'one text of all' text", "'hot' source")
    docs = docs.unionByName(spark.createDataFrame([(LAST_ID, "one text of all", "hot"), (LAST_ID, "alone", None)], "doc_id long, text string, source string"))
    got = plan(docs).select("doc_id", "bin_id", "n_words").collect()
    assert len(got) == 100_002 and len({r.bin_id for r in got if r.n_words == 4}) == 100_001
    assert sorted(r.n_words for r in got if r.doc_id == LAST_ID) == [1, 4] and sum(r.doc_id is None for r in got) == 100_000
    shards = Counter(r.bin_id // BINS_PER_SHARD for r in got if r.doc_id is None)
    assert len(shards) == 25 and max(shards.values()) == min(shards.values()) == 4000


def test_empty_table(spark):
    assert plan(spark.createDataFrame([], SCHEMA)).count() == 0
