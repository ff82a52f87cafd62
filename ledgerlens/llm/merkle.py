"""Merkle dataset manifest by concatenated-level strings (operator 13).

Every language is a tree over its rows in ascending ``doc_id``; every run of ``ARITY``
consecutive nodes has one parent, and the languages' roots are the leaves of a last tree.

1. One scan hashes each row to its leaf (and to a tampered leaf, where one is asked for);
   only ids and digests go on.
2. ``numbered`` gives each leaf its place: a range partitioning by (language, doc_id, leaf),
   sorted runs, and the runs' lengths.  No language is ever one partition or one window.
3. ``climb`` cuts the places into aligned blocks of ``ARITY ** DEPTH`` nodes.  A block keeps
   a level as one string of 64 hex digits a node; fixed-width substrings of it, hashed, are
   the next level's string.  The blocks' roots are the nodes of the next call, until every
   tree has one node left: 50 thousand million leaves take five calls.
4. Of a leaf, the siblings on a level are the two substrings that flank it in its run.  The
   path of a block's root, found by the calls above, is joined once for each block.

All columns are DataFrame expressions.  A block is bounded (256 rows), so a language, an
id or a group of copies that holds a third of all rows is cut like any other.

Defined cases: a null value is ``-`` in the leaf, an empty text is ``0:``; a null language is
a tree of its own and comes first; null ids come last in their language; rows with equal ids
stand in the order of their leaves (equal rows have equal leaves, so their order is no
matter, but their places and proofs differ); a null id is never tampered with; an empty
table gives an empty result; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, run_folder, table

ARITY = 2
#: Levels of a block; it has ARITY ** DEPTH nodes at its foot.
DEPTH = 8
#: Hex digits of a digest.
WIDTH = 64
#: The fields of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One row of this many (by the CRC of its id) is tampered with in the query.
TAMPER = 7


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*map(field, values)))


def leaves(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """Per row: tree (the language's key, nulls first), doc_id, leaf, tampered.

    ``tampered`` is the leaf with one more in ``n_chars``, where ``altered`` holds; else null."""
    values = {name: F.col(name).cast("long") if name in ("doc_id", "n_chars") else F.col(name) for name in FIELDS}
    changed = [v + 1 if name == "n_chars" else v for name, v in values.items()]
    tampered = F.when(altered & F.col("n_chars").isNotNull(), leaf(changed)) if altered is not None else F.lit(None).cast("string")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"), values["doc_id"].alias("doc_id"),
        leaf(list(values.values())).alias("node"), tampered.alias("tampered"))


def numbered(nodes: DataFrame, order: list[str], folder: str) -> DataFrame:
    """``nodes`` with idx, their place from 0 in their tree by ``order`` (nulls last), and n, the tree's nodes.

    Each partition of a range partitioning is a run of consecutive places; its trees' first
    places are sums of the lengths of the runs before (one row for each run and tree)."""
    by = [F.col("tree")] + [F.col(c).asc_nulls_last() for c in order]
    tie = "__tie"  # so that rows equal in all else can be cut too
    nodes = land(nodes.withColumn(tie, F.monotonically_increasing_id()), f"{folder}/nodes")
    runs = nodes.repartitionByRange(*by, F.col(tie)).sortWithinPartitions(*by, tie).drop(tie)
    runs = land(runs.withColumn("at", F.monotonically_increasing_id()), f"{folder}/runs")
    run = F.shiftright("at", 33).alias("run")
    lengths = runs.groupBy("tree", run).agg(F.min("at").alias("lo"), F.count(F.lit(1)).alias("length"))
    of_tree = Window.partitionBy("tree")
    before = F.sum("length").over(of_tree.orderBy("run")) - F.col("length")
    starts = land(lengths.select("tree", "run", "lo", before.alias("before"), F.sum("length").over(of_tree).alias("n")), f"{folder}/starts")
    placed = runs.withColumn("run", F.shiftright("at", 33)).join(starts, ["tree", "run"])
    return placed.withColumn("idx", F.col("before") + F.col("at") - F.col("lo")).drop("run", "at", "lo", "before")


def _parents(level: Column, arity: int) -> Column:
    """The string of the level above: each run's substring, hashed."""
    wide = WIDTH * arity
    runs = F.sequence(F.lit(0), ((F.length(level) - 1) / wide).cast("int"))
    return F.array_join(F.transform(runs, lambda k: digest(F.substring(level, k * wide + 1, F.lit(wide)))), "")


def _levels(foot: Column, n: Column, arity: int, depth: int) -> Column:
    """The level strings of a block, foot first: a level has parents while its tree has several nodes on it."""

    def above(levels: Column, k: Column) -> Column:
        many = n > F.pow(F.lit(float(arity)), k.cast("double"))
        return F.when(many, F.concat(levels, F.array(_parents(F.element_at(levels, -1), arity)))).otherwise(levels)

    return F.aggregate(F.sequence(F.lit(0), F.lit(depth - 1)), F.array(foot), above)


def _flanks(levels: Column, place: Column, arity: int) -> Column:
    """The siblings of the block's node at ``place``, level by level: the substrings left and right of it in its run."""

    def at(level: Column, k: Column) -> Column:
        i = F.floor(place / F.pow(F.lit(float(arity)), k.cast("double"))).cast("int")
        in_run = F.pmod(i, F.lit(arity))
        return F.struct(
            F.substring(level, (i - in_run) * WIDTH + 1, in_run * WIDTH).alias("left"),
            F.substring(level, (i + 1) * WIDTH + 1, (F.lit(arity - 1) - in_run) * WIDTH).alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), at)


def climb(nodes: DataFrame, folder: str, arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """The blocks of ``nodes`` (tree, idx, n, node and more): tree, block, rows, levels, above, root.

    ``above`` is the path of the block's root up to its tree's ``root``."""
    span = arity**depth
    extra = [c for c in nodes.columns if c not in ("tree", "idx", "n")]
    block = F.floor(F.col("idx") / span).cast("long").alias("block")
    blocks = nodes.groupBy("tree", block, "n").agg(F.sort_array(F.collect_list(F.struct("idx", *extra))).alias("rows"))
    foot = F.array_join(F.transform("rows", lambda r: r["node"]), "")
    blocks = land(blocks.withColumn("levels", _levels(foot, F.col("n"), arity, depth)), f"{folder}/blocks")
    most = blocks.agg(F.max("n")).first()[0] or 0
    top = F.element_at("levels", -1)
    if most <= span:
        return blocks.withColumns({"above": _flanks(F.array(F.lit("")), F.lit(0), arity), "root": top})
    tops = blocks.select("tree", F.col("block").alias("idx"), F.ceil(F.col("n") / span).cast("long").alias("n"), top.alias("node"))
    paths = paths_of(climb(tops, f"{folder}/up", arity, depth), arity).select("tree", F.col("row.idx").alias("block"), F.col("path").alias("above"), "root")
    return blocks.join(land(paths, f"{folder}/paths"), ["tree", "block"])


def paths_of(blocks: DataFrame, arity: int = ARITY) -> DataFrame:
    """Per node: tree, row, path (left and right siblings, level by level up to the root), root."""
    each = F.transform("rows", lambda row, place: F.struct(row.alias("row"), F.concat(_flanks(F.col("levels"), place, arity), F.col("above")).alias("path")))
    return blocks.select("tree", "root", F.inline(each))


def fold(node: Column, path: Column) -> Column:
    """The root that a node and its siblings lead to."""
    return F.aggregate(path, node, lambda h, p: digest(F.concat(p["left"], h, p["right"])))


def proof(path: Column) -> Column:
    """All siblings of a path as one string, from the foot up, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


@dataclass
class Manifest:
    """A written manifest: the blocks of every tree with their level strings, and the trees' roots."""

    folder: str
    blocks: DataFrame  # tree, block, n, rows, levels, above (up to the dataset's root), subroot, root
    arity: int

    def rows(self) -> DataFrame:
        """Per leaf: lang, doc_id, leaf, tampered, subroot, root, path."""
        lang = F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1))
        each = F.transform("rows", lambda row, place: F.struct(
            row["doc_id"].alias("doc_id"), row["node"].alias("leaf"), row["tampered"].alias("tampered"),
            F.concat(_flanks(F.col("levels"), place, self.arity), F.col("above")).alias("path")))
        return self.blocks.select(lang.alias("lang"), "subroot", "root", F.inline(each))


def manifest(docs: DataFrame, altered: Column | None = None, arity: int = ARITY, depth: int = DEPTH) -> Manifest:
    """Hash ``docs`` and write the trees below the shared folder."""
    folder = run_folder(docs.sparkSession, "merkle")
    nodes = numbered(leaves(docs, altered), ["doc_id", "node"], f"{folder}/leaf")
    blocks = climb(nodes, f"{folder}/leaf", arity, depth)
    subroots = blocks.where("block = 0").select("tree", F.col("root").alias("node"))
    over = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "node")
    tree = climb(numbered(over, ["lang"], f"{folder}/root"), f"{folder}/root", arity, depth)
    top = paths_of(tree, arity).select(F.col("row.lang").alias("tree"), F.col("path").alias("over"), F.col("root").alias("whole"))
    found = blocks.join(land(top, f"{folder}/top"), "tree").select(
        "tree", "block", "n", "rows", "levels", F.concat("above", "over").alias("above"), F.col("root").alias("subroot"), F.col("whole").alias("root"))
    return Manifest(folder, found, arity)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and its check for every document (contract of op13)."""
    docs = table(spark, sf_dir, "documents")
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0, F.lit(False))
    rows = manifest(docs, altered).rows()
    checked = rows.select(
        "doc_id", "leaf", "subroot", "root", digest(proof(F.col("path"))).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


#: The CRC-32 of a short ASCII string, bit by bit: each byte is exclusive-ored in before its eight steps.
_CRC_SQL = """
xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295::BIGINT)
"""

OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT *, coalesce({_CRC_SQL} % 7 = 0 AND n_chars IS NOT NULL, false) AS hit,
    coalesce(strlen(doc_id::VARCHAR)::VARCHAR || ':' || doc_id::VARCHAR, '-')
      || coalesce(strlen(source)::VARCHAR || ':' || source, '-') || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') AS head,
    coalesce(strlen(text)::VARCHAR || ':' || text, '-') AS tail
  FROM documents
), leaf AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS tree, hit,
    sha256(head || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') || tail) AS leaf,
    CASE WHEN hit THEN sha256(head || strlen((n_chars + 1)::VARCHAR)::VARCHAR || ':' || (n_chars + 1)::VARCHAR || tail) END AS tampered
  FROM d
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS LAST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
  FROM leaf
), lower_levels(tree, lvl, idx, n, h) AS (
  SELECT tree, 0, idx, n, leaf FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM lower_levels WHERE n > 1 GROUP BY tree, lvl, idx // 2, n
), subroots AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM lower_levels WHERE n = 1
), upper_levels(lvl, idx, n, h) AS (
  SELECT 0, idx, n, subroot FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
  FROM upper_levels WHERE n > 1 GROUP BY lvl, idx // 2, n
), folded(tree, idx, lvl, up, pos, n, proof, f) AS (
  SELECT tree, idx, 0, false, idx, n, '', coalesce(tampered, leaf) FROM placed
  UNION ALL
  SELECT f.tree, f.idx,
    CASE WHEN f.n = 1 THEN 0 ELSE f.lvl + 1 END, f.up OR f.n = 1,
    CASE WHEN f.n = 1 THEN s.idx ELSE f.pos // 2 END, CASE WHEN f.n = 1 THEN s.n ELSE (f.n + 1) // 2 END,
    f.proof || CASE WHEN f.n = 1 THEN '' ELSE coalesce(l.h, u.h, '') END,
    CASE WHEN f.n = 1 THEN f.f WHEN f.pos % 2 = 0 THEN sha256(f.f || coalesce(l.h, u.h, '')) ELSE sha256(coalesce(l.h, u.h, '') || f.f) END
  FROM folded f
  LEFT JOIN lower_levels l ON NOT f.up AND l.tree = f.tree AND l.lvl = f.lvl AND l.idx = xor(f.pos, 1)
  LEFT JOIN upper_levels u ON f.up AND u.lvl = f.lvl AND u.idx = xor(f.pos, 1)
  LEFT JOIN subroots s ON s.tree = f.tree
  WHERE f.n > 1 OR NOT f.up
), top AS (SELECT h AS root FROM upper_levels WHERE n = 1)
SELECT p.doc_id, p.leaf, s.subroot, t.root, sha256(f.proof) AS proof_sha256, f.f AS folded_root, f.f = t.root AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree CROSS JOIN top t
JOIN folded f ON f.tree = p.tree AND f.idx = p.idx AND f.up AND f.n = 1
"""
