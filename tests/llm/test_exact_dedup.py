"""Operator 1: exact dedup by stateful streaming."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerlens.llm.exact_dedup import DedupStream, classes, drop_copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, body string"


def rows(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", 1, "clash", "clash") for i, t in texts], SCHEMA)


def brute(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return {(i, min(g), len(g), i == min(g), hashlib.sha256(b.encode()).hexdigest()) for b, g in groups.items() for i in g}


CASES = [(5, "a  b\n"), (3, "a b "), (9, "a b"), (7, None), (1, ""), (2, "x" * 50_000), (4, "x" * 50_000), (8, "é b"), (6, "é b")]


def got(df):
    return {tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()}


def test_matches_brute_force(spark):
    assert got(classes(rows(spark, CASES))) == brute(CASES)


def test_digest_collisions_are_told_apart_by_their_bytes(spark):
    short = lambda body: F.substring(F.sha2(body.cast("binary"), 256), 1, 1)
    texts = [(i, f"text {i % 23}") for i in range(120)]
    assert got(classes(rows(spark, texts), digest=short)) == brute(texts)


def test_state_outlives_a_batch(spark):
    stream = DedupStream(spark, files_per_batch=1)
    stream.ingest(rows(spark, [(5, "a"), (6, "b")]))
    stream.ingest(rows(spark, [(2, "a"), (7, "a"), (8, "c")]))
    held = sorted((r.first_id, r.group_size) for r in stream.held().collect())
    assert held == [(2, 3), (6, 1), (8, 1)]


def test_every_row_is_returned_and_one_of_a_group_is_kept(spark):
    import duckdb

    from ledgerlens.llm.exact_dedup import OP1_SQL, every_row

    texts = [(1, "a"), (1, "a"), (2, "a"), (None, "z"), (None, "z"), (None, "a")]
    r = every_row(classes(rows(spark, texts)))
    found = [tuple(x) for x in r.select("doc_id", "keep_id", "group_size", "kept").collect()]
    assert sorted(found, key=str) == sorted([(1, 1, 4, True), (1, 1, 4, False), (2, 1, 4, False), (None, 1, 4, False), (None, None, 2, True), (None, None, 2, False)], key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", texts)
    sql = con.execute(OP1_SQL).fetchall()
    assert sorted(sql, key=str) == sorted(map(tuple, r.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_of_repeated_rows_one_stays(spark):
    kept = drop_copies(rows(spark, [(1, "a"), (1, "a"), (2, "a"), (3, "z"), (None, "z"), (None, "y")]))
    assert sorted(kept.select("doc_id", "text").collect(), key=str) == [(1, "a"), (3, "z"), (None, "y")]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "digest", "body"]


def test_empty_table(spark):
    assert classes(rows(spark, [])).count() == 0
