"""Operator 13: Merkle manifest by concatenated-level strings."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, node string, idx long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 7) for r in rows], SCHEMA)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, arity):
    """The root, and each node's siblings from the foot up (the brute-force tree)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            s = i // arity * arity
            paths[k].append(("".join(nodes[s:i]), "".join(nodes[i + 1:s + arity])))
        nodes = [h(*nodes[s:s + arity]) for s in range(0, len(nodes), arity)]
        at = [i // arity for i in at]
    return nodes[0], paths


def brute(rows, altered, arity=2):
    """Sorted (doc_id, leaf, subroot, root, path) and the tampered leaves."""
    trees = defaultdict(list)
    for i, text, lang, source, n in rows:
        leaf = h(*map(field, (i, source, lang, n, text)))
        changed = h(*map(field, (i, source, lang, n + 1, text))) if altered(i) and n is not None else None
        trees[lang].append((i is None, i or 0, leaf, i, changed))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    found = {lang: climb([r[2] for r in sorted(trees[lang], key=lambda r: r[:3])], arity) for lang in langs}
    root, over = climb([found[lang][0] for lang in langs], arity)
    out = []
    for lang, up in zip(langs, over):
        subroot, paths = found[lang]
        for (_, _, leaf, i, changed), path in zip(sorted(trees[lang], key=lambda r: r[:3]), paths):
            out.append((i, leaf, changed, subroot, root, tuple(path + up)))
    return sorted(out, key=str)


def got(m):
    rows = m.rows().collect()
    return sorted(((r.doc_id, r.leaf, r.tampered, r.subroot, r.root, tuple((p.left, p.right) for p in r.path)) for r in rows), key=str)


ODD = [(5, "a", "en", "s", 1), (None, "a", "en", "s", 1), (None, "b", "en", None, None), (7, None, None, "s", 3), (2, "", None, "s", 0),
       (2, "", None, "s", 0), (3, "x" * 60_000, "de", "s", 60_000), (14, "é\n", "", "s", 2), (21, "q", "en", "s", None), (-4, "q", "zz", "s", 1)]


@pytest.mark.parametrize("arity, depth", [(2, 2), (3, 1), (2, 8)])
def test_matches_the_brute_force_tree(spark, arity, depth):
    rows = ODD + [(100 + i, f"text {i % 5}", "en" if i % 3 else "fr", "s", i) for i in range(77)]
    altered = lambda i: i is not None and i % 7 == 0
    m = merkle.manifest(frame(spark, rows), F.coalesce(F.col("doc_id") % 7 == 0, F.lit(False)), arity, depth)
    assert got(m) == brute(rows, altered, arity)


@pytest.mark.parametrize("n", [1, 2, 4, 5, 16, 17])
def test_sizes_at_the_edge_of_a_block(spark, n):
    rows = [(i, str(i), "en", "s", i) for i in range(n)]
    assert got(merkle.manifest(frame(spark, rows), depth=2)) == brute(rows, lambda i: False)


def test_folding_finds_what_was_tampered_with(spark):
    rows = [(i, str(i), "en" if i % 2 else None, "s", i if i % 5 else None) for i in range(40)]
    m = merkle.manifest(frame(spark, rows), F.col("doc_id") % 7 == 0, depth=2).rows()
    checked = m.select("doc_id", (merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert {r.doc_id for r in checked if not r.ok} == {i for i in range(40) if i % 7 == 0 and i % 5}


def test_one_language_with_all_rows_is_cut_into_blocks(spark):
    m = merkle.manifest(frame(spark, [(None, "same", "en", "s", 4)] * 700), depth=3)
    sizes = [r[0] for r in m.blocks.select(F.size("rows")).collect()]
    assert sum(sizes) == 700 and max(sizes) == 8


def test_empty_table(spark):
    assert merkle.manifest(frame(spark, [])).rows().count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    from tests.conftest import SF_SMALL

    rows = merkle.op13_merkle_manifest(spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = con.execute(merkle.OP13_SQL)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(rows.columns)
    assert sorted(want.fetchall()) == sorted(map(tuple, rows.select(*names).collect()))
