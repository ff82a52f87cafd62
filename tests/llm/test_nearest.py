"""Operator 3: exact against brute force, with hot vectors, ties and vectors that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.nearest import nearest_in_tile, quantised, search, wanted_copies

SCHEMA = "vec_id long, embedding array<float>, label int, dim string, q int"
rng = np.random.default_rng(9)


def corpus():
    base = rng.standard_normal((260, 8)).astype(np.float32)
    base[40:160] = base[3]  # a hot vector
    base[200:220] = base[100] * 2  # the same direction
    rows = [(i, base[i].tolist()) for i in range(260)]
    rows += [(300, None), (350, [0.0] * 8), (301, [float("nan")] * 8), (302, [float("inf")] + [1.0] * 7), (303, [None] + [1.0] * 7), (304, [])]
    rows += [(None, base[0].tolist()), (5, rows[5][1]), (400, [1.0, 2.0, 3.0]), (401, [1.0, 2.0, 2.0]), (450, [3.0, 1.0, 1.0])]
    return rows


def brute(rows, k):
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = set()
    for q, a in good.items():
        if q % 50 == 0:
            found = sorted((-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), c) for c, b in good.items() if c != q and len(a) == len(b))
            out |= {(q, r, c, round(-s, 12)) for r, (s, c) in enumerate(found[:k], 1)}
    return out


@pytest.mark.parametrize("tiles", [(2048, 8192), (2, 37)])
def test_against_brute_force(spark, tiles):
    rows = corpus()
    frame = spark.createDataFrame([(i, v, 1, "clash", 2) for i, v in rows], SCHEMA)
    got = search(frame, F.col("vec_id") % 50 == 0, 5, *tiles)
    assert {(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in got.collect()} == brute(rows, 5)


def test_error_bound_holds_and_prunes():
    q, c = rng.standard_normal((30, 64)), rng.standard_normal((3000, 64))
    qc, qs, qn, qe = quantised(q)
    cc, cs, _, ce = quantised(c)
    approx = (qc.astype(float) @ cc.astype(float).T) * qs[:, None] * cs[None]
    true = (q / np.linalg.norm(q, axis=1)[:, None]) @ (c / np.linalg.norm(c, axis=1)[:, None]).T
    assert (np.abs(approx - true) <= qn[:, None] * ce[None] + qe[:, None] + 1e-9).all()
    i, _, _ = nearest_in_tile(np.arange(30), q, np.arange(100, 3100), c, 5)
    assert 150 <= len(i) < 1500  # of 90,000 pairs


def test_of_copies_the_smallest_ids_stay():
    v = np.ones((50, 3))
    assert sorted(wanted_copies(np.arange(50)[::-1], v, 5)) == [44, 45, 46, 47, 48, 49]


def test_empty_table(spark):
    assert search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
