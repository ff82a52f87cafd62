"""The pipeline: every stage against a brute-force version on its own input."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import secret_scan, toxicity
from ledgerlens.llm.common import DOCUMENT_COLUMNS
from tests.llm.test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(name, input rows, output rows) of each stage, run as run() does."""
    at = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet").withColumn("fp", F.lit(1)), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, SF)
        result.write.parquet(f"{at}/{k}")
        after = spark.read.parquet(f"{at}/{k}")
        out.append((name, docs, after))
        docs = after
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_toxicity(spark, stages):
    name, before, after = stages[0]
    assert name == "toxicity" and after.columns == DOCUMENT_COLUMNS
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    scorer, given = toxicity.Scorer(model), rows(before)
    stay = {i for i, r in given.items() if scorer.scores([r.text])[0] < model.thresholds.get(r.lang, 0.7)}
    assert set(rows(after)) == stay and len(stay) >= 0.8 * len(given)


def test_exact_dedup(stages):
    _, before, after = stages[1]
    least = {}
    for i, r in sorted(rows(before).items()):
        least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), i)
    assert rows(after) == {i: r for i, r in rows(before.select(DOCUMENT_COLUMNS)).items() if i in least.values()}


def test_simhash(stages):
    _, before, after = stages[2]
    given = rows(before)
    ids = sorted(given)
    component = brute_components(ids, [brute_print(given[i].text) for i in ids])
    assert set(rows(after)) == set(component) and after.columns == DOCUMENT_COLUMNS


def test_secrets(spark, stages):
    _, before, after = stages[3]
    model, given, got = secret_scan.fit(before), rows(before), rows(after)
    assert set(given) == set(got)
    for i, r in given.items():
        text, cover = r.text or "", [False] * len(r.text or "")
        for a, _, b in model.spans(text)[1]:
            cover[a:b] = [True] * (b - a)
        kept = "".join(c for c, hide in zip(text, cover) if not hide)
        assert got[i].text.replace(secret_scan.REDACTED, "") == kept and got[i].n_chars == len(got[i].text)
        assert not secret_scan.base_matches(got[i].text)


def test_packing(stages):
    _, before, after = stages[4]
    given, packed = rows(before), after.collect()
    words = Counter()
    bins = defaultdict(list)
    for r in packed:
        words[r.doc_id] += r.n_words
        bins[r.bin_id].append(r)
    assert words == Counter({i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for i, r in given.items()})
    for b in bins.values():
        assert sum(r.n_words for r in b) <= 2048
        assert len({given[r.doc_id].source for r in b}) == len(b)


def test_run_gives_the_last_stages_rows(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1][2].collect()))


def test_odd_rows(spark, tmp_path):
    docs = [(None, None, None, None, None, 1), (1, "", "en", None, 0, 1), (1, "", "en", None, 0, 1), (2, "z " * 60_000, None, "s", 120_000, 2), (3, "token = abcdefgh", "xx", "s", 16, 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, __id long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in got) == Counter({1: 1, 2: 30, 3: 1})
    none = tmp_path / "none"
    for t in ("documents", "labels"):
        spark.read.parquet(str(tmp_path / f"{t}.parquet")).limit(0).write.parquet(str(none / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(none)).count() == 0
