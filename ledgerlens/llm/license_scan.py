"""Licence scans by a positional rare-token index (operator 6), DataFrame functions only.

The templates (``license_texts``) are a fixed list, so the index over them is a
literal: rare word -> (template, place) postings.  A template is indexed by its
``KEY_WORDS`` words of highest IDF, counted over all documents in one pass (map-side
partial counts of at most the licence vocabulary's size); a base phrase by its one
rarest word.  Per file, every occurrence of a rare word is looked up; postings
shifted to the file's positions are intersected: occurrences that agree on
(template, start) are one candidate, scored by the share of the template's rare words
that stand at their relative places.  Candidates are then verified: a base phrase word
by word, a template by its mandatory key phrases.

Everything stays in the row: no exchange but the tiny IDF count, so a hot source or
key changes nothing.  Null texts count as empty; other columns are not read; ties in
IDF go to the smaller word; an empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import table, text_of
from ledgerlens.llm.license_texts import BASE_PHRASES, TEMPLATES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY_WORDS = 5
#: Share of a template's rare words that must stand at their relative places.
LEAST_SHARE = 0.6
SHIFT = 4096  # places before a file's first word that a template may start at; templates are shorter


def words_of(text: Column) -> Column:
    """The words of a whole text, A-Z lower-cased."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _templates() -> list[tuple[str, list[str], list[str] | None]]:
    """(label, words, mandatory phrases; None: a base phrase)."""
    base = [(label, phrase.split(), None) for label, phrase in BASE_PHRASES]
    return base + [(label, text.split(), phrases) for label, text, phrases in TEMPLATES]


def document_frequencies(docs: DataFrame) -> dict[str, int]:
    """In how many documents each licence word stands (bounded by the fixed vocabulary)."""
    vocabulary = sorted({w for _, words, _ in _templates() for w in words})
    present = F.array_intersect(words_of(text_of("text")), F.lit(vocabulary))
    counts = docs.select(F.explode(present).alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in counts.collect()}


def index(frequencies: dict[str, int]) -> list[dict]:
    """Per template: label, length, rare words with places, phrases."""
    out = []
    for label, words, phrases in _templates():
        rarest = sorted(set(words), key=lambda w: (frequencies.get(w, 0), w))[: KEY_WORDS if phrases else 1]
        out.append({"label": label, "words": words, "phrases": phrases, "keys": [(p, w) for p, w in enumerate(words) if w in rarest]})
    return out


def _array(items: list, kind: str) -> Column:
    return F.array(*items) if items else F.array().cast(kind)


def matches(words: Column, entries: list[dict]) -> Column:
    """array<struct<base, label, start, share>>: verified places, and unverified ones with a null label."""
    postings: dict[str, list[int]] = {}
    for t, e in enumerate(entries):
        for p, w in e["keys"]:
            postings.setdefault(w, []).append(t * 2**40 + SHIFT - p)
    rare = F.lit(sorted(postings))
    lookup = F.create_map(*[x for w, codes in sorted(postings.items()) for x in (F.lit(w), F.lit(codes))])
    described = F.array(*[
        F.struct(
            F.lit(e["phrases"] is None).alias("base"), F.lit(e["label"]).alias("label"), F.lit(" ".join(e["words"])).alias("text"), F.lit(len(e["words"])).alias("n"),
            F.array(*[F.struct(F.lit(p).alias("place"), F.lit(w).alias("word")) for p, w in e["keys"]]).alias("keys"),
            _array([F.lit(f" {p} ") for p in e["phrases"] or []], "array<string>").alias("phrases"))
        for e in entries])
    places = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.cast("long").alias("at"))), lambda x: F.array_contains(rare, x["word"]))
    starts = F.array_distinct(F.flatten(F.transform(places, lambda x: F.transform(F.element_at(lookup, x["word"]), lambda code: code + x["at"]))))

    def judged(code: Column, described: Column, body: Column) -> Column:
        start = F.pmod(code, F.lit(2**40)) - SHIFT
        e = F.get(described, F.shiftright(code, 40).cast("int"))
        return let(F.struct(start.cast("int").alias("start"), e.alias("e")), lambda x: F.struct(
            x["e"]["base"].alias("base"),
            x["start"].cast("long").alias("start"),
            F.when(x["e"]["base"], ((x["start"] >= 0) & (F.array_join(F.slice(words, F.greatest(x["start"], F.lit(0)) + 1, x["e"]["n"]), " ") == x["e"]["text"])).cast("double"))
            .otherwise(F.size(F.filter(x["e"]["keys"], lambda k: (x["start"] + k["place"] >= 0) & (F.get(words, F.greatest(x["start"] + k["place"], F.lit(0))) == k["word"]))) / F.size(x["e"]["keys"])).alias("share"),
            x["e"]["label"].alias("label"),
            F.forall(x["e"]["phrases"], lambda p: F.contains(body, p)).alias("phrases")))

    text = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    found = let(F.struct(described.alias("d"), text.alias("t")), lambda x: F.transform(starts, lambda code: judged(code, x["d"], x["t"])))
    nothing = F.filter(F.array(F.struct(F.lit(True).alias("base"), F.lit(0).cast("long").alias("start"), F.lit(0.0).alias("share"), F.lit("").alias("label"), F.lit(True).alias("phrases"))), lambda x: F.lit(False))
    return F.when(F.arrays_overlap(words, rare), found).otherwise(nothing)


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, base_starts (word places), base_labels, labels, score.

    score: 1 where a base phrase stands, else the largest share of one template's
    rare words found at their relative places (0: none)."""
    entries = index(document_frequencies(docs))

    def summed(words: Column) -> Column:
        return let(matches(words, entries), lambda m: let(
            F.filter(m, lambda x: x["base"] & (x["share"] == 1)), lambda base: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.array_sort(F.transform(base, lambda x: x["start"])).alias("base_starts"),
                F.array_distinct(F.transform(base, lambda x: x["label"])).alias("base_labels"),
                F.array_distinct(F.transform(F.filter(m, lambda x: (x["base"] & (x["share"] == 1)) | (~x["base"] & (x["share"] >= LEAST_SHARE) & x["phrases"])), lambda x: x["label"])).alias("labels"),
                F.coalesce(F.array_max(F.transform(m, lambda x: x["share"])), F.lit(0.0)).alias("score"))))

    listed = lambda a: F.array_join(F.array_sort(a), ",")
    found = docs.select("doc_id", let(words_of(text_of("text")), summed).alias("f")).select("doc_id", "f.*")
    return found.withColumns({"base_labels": listed(F.col("base_labels")), "labels": listed(F.col("labels"))})


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in every whole text (contract of op6)."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", F.size("base_starts").cast("long").alias("n_base"),
        F.array_min("base_starts").alias("first_word"), F.array_max("base_starts").alias("last_word"),
        "base_labels", "labels", "score")
