"""Operator 2: the network against a plain forward pass, held-out accuracy, defined cases."""

import copy
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import toxicity as tox
from ledgerlens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score double, toxic int"


def brute_score(model, text):
    """One window, one filter at a time."""
    e = [model.table[tox.feature_rows(w)].sum(axis=0) for w in tox.words(text)]
    pooled, at = [], 0
    for k, width in enumerate(tox.WIDTHS):
        best = np.full(tox.FILTERS, -1e9)
        for i in range(len(e)):
            act = model.bias[k * tox.FILTERS:(k + 1) * tox.FILTERS].astype(float)
            for tap in range(width):
                if i + tap < len(e):
                    c = at + tap * tox.FILTERS
                    act = act + e[i + tap] @ model.taps[:, c:c + tox.FILTERS]
            best = np.maximum(best, act)
        at += width * tox.FILTERS
        pooled += list(np.maximum(best, 0))
    z = model.scale[0] * (np.array(pooled) @ model.out + model.out_bias) + model.scale[1]
    return 1 / (1 + np.exp(-z))


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(2)
    clean = [" ".join(f"word{rng.integers(200)}" for _ in range(40)) for _ in range(600)]
    texts = [c + " rotten thing" if i % 3 == 0 else c for i, c in enumerate(clean)]
    return tox.train(texts, [int(i % 3 == 0) for i in range(600)], ["en"] * 600, rng.random(600).tolist())


def test_forward_pass(model, monkeypatch):
    texts = ["", None, "word1", "word1 rotten", "Rotten! word3 word4 unseen, words", "word5 " * 50]
    want = [brute_score(model, t) for t in texts]
    assert np.allclose(tox.Scorer(model).scores(texts), want, atol=1e-5)
    monkeypatch.setattr(tox, "BLOCK", 7)  # long texts in blocks, small caches
    monkeypatch.setattr(tox, "CACHE", 3)
    assert np.allclose(tox.Scorer(model).scores(texts), want, atol=1e-5)


def test_learns_and_calibrates(model):
    s = tox.Scorer(model).scores(["word3 word9 rotten word8", "word3 word9 word8", ""])
    assert s[0] >= 0.7 > s[1] and s[2] < 0.7
    assert 0.5 <= model.thresholds["en"] <= 0.9


def test_without_both_labels_the_model_is_constant():
    s = tox.Scorer(tox.train(["a", "b"], [0, 0], [None, "x"], [0.1, 0.9])).scores(["a", "zzz", None])
    assert len(set(s)) == 1 and s[0] < 0.7


def test_query_on_held_out_rows(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, sf).collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM read_parquet('{sf}/labels.parquet')").fetchall())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows.values())
    held = [(rows[i].score, t) for i, t in labels.items() if rows[i].held_out]
    up, down = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([a > b for a in up for b in down]) > 0.9


def test_filter_keeps_columns_and_handles_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"word{rng.integers(99)}" for _ in range(30)) + (" rotten" if i % 3 == 0 else ""), "en", 0.5, 9) for i in range(300)]
    rows += [(None, None, None, None, None), (None, "rotten", "xx", None, None), (7, rows[7][1], "en", 0.5, 9), (1000, "w " * 300_000, "en", 0.0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    kept = tox.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None and i < 300) == sorted([i for i in range(300) if i % 3] + [7])
    assert ids.count(None) == 1 and 1000 in ids
    assert tox.scored(docs.limit(0), tox.Cnn()).count() == 0


def test_every_labelled_row_is_learnt(spark):
    """a toxic word that only some of 6,000 labelled rows hold, those with the largest hash, is learnt too."""
    from pyspark.sql import functions as F

    ids = [r.id for r in spark.range(9300).where(~tox.held_out(F.col("id"))).orderBy(F.xxhash64("id")).limit(6000).collect()]
    rng, rows = np.random.default_rng(6), []
    for k, i in enumerate(ids):
        mark = ("" if k % 2 else " rotten") if k < 5400 else ("" if k % 2 else " zeta")
        rows.append((i, " ".join(f"word{rng.integers(50)}" for _ in range(4)) + mark, "en", int(k % 2 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = tox.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    s = tox.Scorer(model).scores(["word1 word2 zeta word3", "word1 rotten word3 word4", "word1 word2 word3 word4"])
    assert s[0] >= 0.7 and s[1] >= 0.7 > s[2] and 0.5 <= model.thresholds["en"] <= 0.9
    again = tox.fit(docs.drop("toxic").repartition(3), docs.select("doc_id", "toxic"))
    assert (again.table == model.table).all() and again.thresholds == model.thresholds


def test_words_hashed_together_are_hashed_alike():
    words = ["a", "abc", "abcd", "abcdef", "abcdefgh", "hello_world", "x" * 24, "x" * 25, "x" * 300, "naïve", "ß", "日本語の文字列", "a1"]
    assert tox.feature_table(words).tolist() == [tox.feature_rows(w) for w in words]
    assert tox.feature_table([]).shape == (0, 1 + len(tox.PREFIXES))


def test_a_shard_is_hashed_once(spark):
    """r03: epochs read landed codes (no text is dealt, split or hashed again), and what landed is the whole shard."""
    import pandas as pd

    texts = ["word1 rotten word2", None, "word2 word3", "", "kept word9"]
    held = pd.DataFrame({"doc_id": [3, 1, 2, 5, 4], "text": texts, "lang": ["en", None, "de", "en", "en"], "toxic": [1, 0, 0, 0, 1], "fits": [True] * 4 + [False], "shard": [7] * 5})
    landed = spark.createDataFrame(tox._coded_shard(held), tox.CODED)
    [(row, docs, rows)] = tox._shards(landed.toArrow().to_batches())
    order = [1, 2, 0, 3, 4]  # by id, the row kept for the calibration last
    assert row["shard"] == 7 and row["learnt"] == 4 and row["toxic"] == [0, 0, 1, 0, 1] and row["lang"] == [None, "de", "en", "en", "en"]
    assert [rows[d].tolist() for d in docs] == [[tox.feature_rows(w) for w in tox.words(texts[k])] for k in order]
    met = dict(zip(row["met"], zip(row["met_clean"], row["met_toxic"])))
    assert met[tox.feature_rows("word2")[0]] == (1, 1) and met[tox.feature_rows("rotten")[0]] == (0, 1)
    assert tox.feature_rows("word9")[0] not in met


def test_a_task_sends_each_changed_row_once():
    """r03: what several shards of a task changed is summed before it leaves, row by row, to the last bit."""
    start, shards = (tox.Cnn(), tox._Steps()), []
    draw = np.random.default_rng(4)
    for k in range(3):
        model, steps = copy.deepcopy(start)
        rows = draw.choice(tox.ROWS, 20_000, replace=False)
        model.table[rows] += draw.standard_normal((len(rows), tox.DIM)).astype(np.float32)
        steps.table[rows[:9]] += np.float32(0.5)
        model.table[rows[9:12]] = np.nextafter(start[0].table[rows[9:12]], np.float32(9))  # rounds to nothing
        model.out[k] += 1
        steps.out_bias += 0.25 * k
        shards.append((model, steps))
    changes = tox._Changes(*start)
    for shard in shards:
        changes.add(*shard)
    got = pa.Table.from_batches(list(changes.batches()))
    each = [np.rint((tox._flat(*shard) - tox._flat(*start)) * tox.UNIT).astype(np.int64) for shard in shards]
    some = np.flatnonzero(sum(c.any(axis=1).astype(int) for c in each))
    assert got["row"].to_pylist() == some.tolist()  # 3 x 20,000 rows and the others, each once
    assert got["shards"].to_pylist() == sum(c.any(axis=1).astype(int) for c in each)[some].tolist()
    assert (np.stack([got[v].to_numpy() for v in tox.NUMBERS], axis=1) == sum(each)[some]).all()


def test_scoring_holds_few_texts_and_never_copies_its_projections(spark, monkeypatch):
    """r03: a batch's texts become objects some at a time; the words' projections have their room from the start."""
    taken, scores, room = [], tox.Scorer.scores, []

    def counted(self, texts):
        assert iter(texts) is texts  # not a list of all texts
        before, out = len(self.p), scores(self, texts)
        taken.append(len(out))
        room.append((before, len(self.p)))
        return out

    texts = [" ".join(f"w{k * 97 + j}" for j in range(120)) for k in range(1000)]
    want = tox.Scorer(tox.Cnn()).scores(texts)
    assert (tox.Scorer(tox.Cnn()).scores(iter(texts)) == want).all()
    monkeypatch.setattr(tox.Scorer, "scores", counted)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": texts, "lang": ["en"] * 1000})

    class Frame:
        """Stands in for a data frame whose one batch is scored here."""
        columns, sparkSession, schema = ["doc_id", "text", "lang"], spark, spark.createDataFrame([], "doc_id long, text string, lang string").schema

        def mapInArrow(self, rows, _):
            return list(rows([batch]))

    (got,) = tox.scored(Frame(), tox.Cnn())
    assert got["__score"].to_pylist() == want.tolist() and taken == [1000] and all(a == b for a, b in room)
