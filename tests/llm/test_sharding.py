"""Operator 12: sharding by balanced label propagation."""

import zlib
from collections import Counter, defaultdict

import pytest

from ledgerlens.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, shard int, row long"


def frame(spark, texts):
    rows = [(i, t, None, "s", 1, "clash", 99, 5) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(5) if rows else spark.createDataFrame([], SCHEMA)


def shards_of(spark, texts, shards=8, rounds=sharding.ROUNDS):
    """Shard of each row, checked for the law, the slots, the sizes and every row being there."""
    rows = sharding.assign(frame(spark, texts), shards, rounds).collect()
    assert Counter((r.doc_id, r.size, r.crc) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    counts, slots = Counter(r.shard for r in rows), defaultdict(list)
    assert all(0 <= s < shards for s in counts)
    assert max(counts[s] for s in range(shards)) - min(counts[s] for s in range(shards)) <= 1
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    groups = defaultdict(Counter)
    for r in rows:
        groups[bytes(r.g)][r.shard] += 1
        assert r.members >= 1
    assert all(r.members == sum(groups[bytes(r.g)].values()) for r in rows)
    return groups


def test_groups_stay_whole(spark):
    texts = [(i, f"group {i % 40}" if i < 160 else f"alone {i}") for i in range(500)]
    groups = shards_of(spark, texts)
    assert all(len(c) == 1 for c in groups.values())
    used = Counter(next(iter(c)) for c in groups.values() if sum(c.values()) > 1)
    assert len(used) >= 6  # neighbours pull documents together, not all of them into one shard


def test_a_group_of_a_third_fills_as_few_shards_as_hold_it(spark):
    texts = [(i, "hot") for i in range(400)] + [(1000 + i, f"pair {i // 2}") for i in range(300)] + [(2000 + i, f"alone {i}") for i in range(500)]
    groups = shards_of(spark, texts)
    assert len(max(groups.values(), key=lambda c: sum(c.values()))) <= 4  # 400 of 1200 rows, 150 a shard
    apart = [c for c in groups.values() if len(c) > 1 and sum(c.values()) == 2]
    assert len(apart) <= 3


def test_cut_links_fall(spark, tmp_path):
    from ledgerlens.llm.common import land

    start = spark.createDataFrame([(bytes([g]), 4, 1, s, 1) for g in range(50) for s in ((g + k) % 8 for k in range(4))], "g binary, members long, pieces int, shard int, n long")
    start = land(start, f"{tmp_path}/start")
    end = sharding.propagate(start, [40] * 8, str(tmp_path / "run"))
    assert sharding.cut(start) == 150 and sharding.cut(end) <= 15
    held = {r.shard: r["sum(n)"] for r in end.groupBy("shard").sum("n").collect()}
    assert sum(held.values()) == 200 and max(held.values()) <= 40


@pytest.mark.parametrize("n", [1, 3, 8, 9])
def test_few_rows(spark, n):
    shards_of(spark, [(i, f"t{i // 2}") for i in range(n)], rounds=2)


def test_odd_rows(spark):
    texts = [(None, None), (None, None), (None, ""), (1, ""), (1, "é" * 40_000), (1, "é" * 40_000), (2, " "), (2, "\u0000"), (-5, "b")]
    groups = shards_of(spark, texts, shards=3, rounds=2)
    assert sum(len(c) > 1 for c in groups.values()) <= 1


def test_all_rows_equal(spark):
    groups = shards_of(spark, [(None, "same")] * 5000, shards=3, rounds=2)
    assert len(groups) == 1


def test_pieces_of_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECES", 16)
    monkeypatch.setattr(sharding, "BUCKET", 64)
    groups = shards_of(spark, [(i, "hot" if i % 3 else f"t{i // 9}") for i in range(900)])
    hot = max(groups.values(), key=lambda c: sum(c.values()))  # 600 of 900 rows, all linked, 112 or 113 a shard
    assert max(hot.values()) >= 100


def test_every_document_has_a_copy(spark):
    groups = shards_of(spark, [(i, f"t{i // 2}") for i in range(800)])  # no document without links to make room
    assert sum(len(c) > 1 for c in groups.values()) <= 60  # of 400, some 350 at the start


def test_empty_table(spark):
    assert sharding.assign(frame(spark, [])).count() == 0
