"""Operator 6: base phrases against a direct search; templates and their key phrases."""

import re

from ledgerlens.llm.license_scan import scan
from ledgerlens.llm.license_texts import BASE_PHRASES, TEMPLATES

SCHEMA = "doc_id long, text string, words string, n_words long"


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((i, label) for label, p in BASE_PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    return len(words), [i for i, _ in places], ",".join(sorted({x for _, x in places}))


TEXTS = [
    None, "", "MIT License", "the M.I.T. license, mit-license; mit\nLICENSE mit éa license", "license mit", "GNU General Public License general public public license",
    "Apache License apache license " * 300, "é" * 50_000 + " MIT license", "mıt license MİT license", "mit mit license license apache",
    "# " + TEMPLATES[0][1].upper(), "x " + TEMPLATES[0][1].replace("without restriction", "with limits"), "word " * 40 + TEMPLATES[5][1] + " more", TEMPLATES[2][1], "fee free software public domain",
]


def test_against_a_direct_search(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, "mit license", None, None), (3, TEXTS[3], None, None)]
    got = scan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "mit license" if r.doc_id is None else TEXTS[r.doc_id]
        n, starts, labels = brute(text)
        assert (r.n_words, r.base_starts, r.base_labels) == (n, starts, labels), r.doc_id
        assert set(filter(None, labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by = {r.doc_id: r for r in got}
    assert by[10].labels == "mit" and by[10].n_words == 29 and by[10].base_starts == []
    assert by[11].labels == "" and by[11].score > 0  # a mandatory phrase is missing
    assert by[12].labels == "bsd" and by[12].score == 1.0
    assert by[13].base_labels == "gpl" and by[2].score == 1.0 and by[0].score == 0.0


def test_plan_has_no_python_and_one_small_exchange(spark):
    frame = scan(spark.createDataFrame([(1, "mit license", "", 1)], SCHEMA))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], SCHEMA)).count() == 0
