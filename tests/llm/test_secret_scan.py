"""Operator 4: base spans against a direct search, inferred formats, redaction."""

import random
import re

import pyarrow as pa

from ledgerlens.llm import secret_scan
from ledgerlens.llm.secret_scan import (
    KINDS, MIN_VALUES, Automaton, FormatModel, base_matches, base_sha256, candidates, compacted, fit, mean_log_likelihood, redact, scan)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string"
rng = random.Random(7)
HEXES = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(200)]
CARDS = ["".join(rng.choices("0123456789", k=16)) for _ in range(200)]


def brute(text):
    """The contract read literally: match first, drop failing matches after."""
    text, out = text or "", []
    for rank, (pattern, group, least) in enumerate([
        (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
        (r"AKIA[A-Z0-9]+", 0, 20), (r"[0-9a-f]+", 0, 24)]):
        out += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text, re.A) if len(m[group]) >= least]
    return sorted(out)


TEXTS = [
    None, "", 'é token = "' + HEXES[0] + '"', "TOKEN:abcde Api_Key=abcdef apikey == xyz123", "AKIA" + "Z" * 15, "x AKIA" + "7" * 16 + ".",
    "password: 'hunter22' secret=" + HEXES[1] + "g" + HEXES[2], "passwd:\t" + HEXES[3], "ſecret=abcdefgh toKen=abcdefgh",
    "z" * 100_000 + " " + HEXES[4], f"{HEXES[5]}{HEXES[6]}", "token token=  token=abcdefg",
]


def test_base_spans():
    for t in TEXTS:
        assert [(a, k, b) for a, k, b, _ in base_matches(t or "")] == brute(t)


def test_automaton_prefers_its_own_format():
    hexes, cards = compacted(Automaton(HEXES[:100])), compacted(Automaton(CARDS[:100]))
    gap = lambda v: mean_log_likelihood(hexes, v) - mean_log_likelihood(cards, v)
    assert min(map(gap, HEXES[100:])) > max(map(gap, CARDS[100:]))


def test_states_with_different_futures_stay_apart():
    a = compacted(Automaton(["a1-z"] * 60 + ["g-1z"] * 60))
    assert mean_log_likelihood(a, "a1-z") > mean_log_likelihood(a, "g1-z") + 0.5


def test_scan_adds_formats_and_keeps_base(spark):
    texts = [(i, f'note token = "{h}" and card {c}') for i, (h, c) in enumerate(zip(HEXES, CARDS))]
    texts += [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "AKIA" + "Q" * 16), (2000, f"see {HEXES[150][:23]} here"), (2000, f"see {CARDS[7]} here")]
    docs = spark.createDataFrame([(i, t, None, None, None, "clash") for i, t in texts], SCHEMA)
    model = fit(docs)
    assert set(model.automata) == {"assign", "hex"}
    got = scan(docs, model).collect()
    assert len(got) == len(texts)
    for r in got:
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))
    by = {(r.doc_id, r.spans) for r in got if r.doc_id == 2000}
    assert by == {(2000, "format:4:27"), (2000, "")}
    for i, t in texts[:200]:
        r = next(x for x in got if x.doc_id == i)
        assert r.base == ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in brute(t))
    clean = {r.doc_id: r for r in redact(docs, model).collect()}
    assert clean[0].text == f"note <secret>\" and card {CARDS[0]}" and clean[0].n_chars == len(clean[0].text)
    assert clean[1000].text is None and clean[1001].text == ""


def test_thresholds_come_from_all_values(spark):
    draw = lambda symbols, n: "".join(rng.choices(symbols, k=n))
    others = [draw("0123456789", 16) for _ in range(3000)] + [draw("0123456789abcdef", 18) for _ in range(150)]
    hexes = HEXES + [draw("0123456789abcdef", 30) for _ in range(900)]
    texts = [f"see {v} here" for v in others] + [f"sum {h} end" for h in hexes]
    docs = spark.createDataFrame([(i, t, None, None, None, "") for i, t in enumerate(texts)], SCHEMA)
    model = fit(docs)
    values = lambda kind: {v for t in texts for k, v in ([("other", v) for _, _, v in candidates(t, base_matches(t))] + [(KINDS[b[1]], b[3]) for b in base_matches(t)]) if k == kind}
    assert len(values("other")) > 2400 and len(values("hex")) > 600
    own, far = (sorted(dict(model.ratios(v, kind))["hex"] for v in values(kind)) for kind in ("hex", "other"))
    assert model.automata["hex"][1] == max(own[len(own) // 20], far[int(len(far) * 0.995)])


def test_too_few_labels_or_no_rows(spark):
    assert not FormatModel({"hex": HEXES[: MIN_VALUES - 1]}, []).automata
    empty = spark.createDataFrame([], SCHEMA)
    assert scan(empty, fit(empty)).count() == 0
    assert base_sha256(None) == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_redaction_holds_a_few_texts_at_a_time():
    """A batch of Spark's 10,000 rows is cleaned and handed on in slices, in order."""
    texts = [None, "", "password=abcdef12 and", "token: zzzzzz99"] * 500
    columns = {"doc_id": list(range(2000)), "text": texts, "lang": ["en"] * 2000, "source": [None] * 2000, "n_chars": [len(t or "") for t in texts]}
    whole = pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64() if c in ("doc_id", "n_chars") else pa.string()) for c, v in columns.items()})
    model = FormatModel({}, [])
    out = list(secret_scan.cleaned(iter([whole]), model))
    assert max(b.num_rows for b in out) <= 256
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["doc_id"] for r in rows] == columns["doc_id"]
    assert [r["text"] for r in rows[:4]] == [None, "", "<secret> and", "<secret>"]
    assert rows[:4] * 500 == [{**r, "doc_id": k % 4} for k, r in enumerate(rows)]
    assert [r["n_chars"] for r in rows] == [len(r["text"] or "") for r in rows]
