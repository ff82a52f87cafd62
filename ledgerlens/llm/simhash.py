"""SimHash near-dedup by tiled exact comparison (operator 7).

1. Each whole text becomes a 64-bit fingerprint in a map-only pass (numpy bit sums
   over the XXH64 of its word shingles).
2. Equal fingerprints are one node (map-side partial aggregation), so a group of
   exact copies is a single number however large it is.
3. The distinct fingerprints are dealt into cells by the population counts of their
   two 32-bit halves, and cells into tiles of about ``TILE`` fingerprints.  Two
   fingerprints within the radius differ by no more than the radius in the sum of
   both counts' distances, so tile pairs of other cells are skipped: exactly.
4. Each remaining tile pair is one row of two arrays; numpy compares it by
   exclusive-or and bit counts, in blocks of bounded size.  A tile pair reports a
   spanning forest of its links, at most one edge per fingerprint, never all pairs of
   a group.
5. Connected components of those edges give the groups.

The comparison is exact and complete; its cost grows with the square of the number of
distinct fingerprints over the cells' pruning, which is inherent in the method.

Defined cases: null and empty texts, and texts without words, have fingerprint zero and
are linked like any other; fewer words than a shingle make one shingle of all; a null
``doc_id`` is left out of the minimum (a component of null ids has a null id); repeated
rows give repeated rows; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import LAST_ID, land, pieces, row_key, rows_chosen, run_folder, table, text_of
from ledgerlens.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints in a tile, about.
TILE = 16_384
#: Comparisons of one numpy block (its memory is 9 bytes each).
BLOCK = 1 << 18


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a UTF-8 text: bit k is 1 if over half of the shingles' hashes have it."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: ASCII letters, ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        hashes = [xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(shingle))))]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row: __id, __hash, fp (the fingerprint as a signed long)."""

    def prints(batches):
        for batch in pieces(batches):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, shingle) for t in texts], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__hash"), pa.array(fps, pa.int64())], ["__id", "__hash", "fp"])

    return row_key(docs.select("doc_id", text_of("text").alias("text"))).select("__id", "__hash", "text").mapInArrow(prints, "__id long, __hash long, fp long")


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links within ``radius`` between two tiles (or inside one)."""
    nodes = a if b is None else np.concatenate([a, b])
    other, shift = (a, 0) if b is None else (b, len(a))
    parent = np.arange(len(nodes))
    step = max(1, BLOCK // max(1, len(other)))
    for at in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[at:at + step, None] ^ other[None, :]) <= radius)
        if not len(i):
            continue
        x, y = parent[i + at], parent[j + shift]
        apart = x != y
        while apart.any():  # hook the larger root to the smaller, then flatten
            x, y = x[apart], y[apart]
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            parent = _roots(parent)
            x, y = parent[x], parent[y]
            apart = x != y
    tied = np.nonzero(parent != np.arange(len(nodes)))[0]
    return nodes[tied], nodes[parent[tied]]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect all of ``distinct`` (fp) within ``radius`` bits."""
    spark = distinct.sparkSession
    half = F.lit(0xFFFFFFFF)
    low, high = F.bit_count(F.col("fp").bitwiseAND(half)).alias("p"), F.bit_count(F.shiftrightunsigned("fp", 32)).alias("q")
    celled = distinct.select("fp", low, high)
    sizes = {(r.p, r.q): r["count"] for r in celled.groupBy("p", "q").count().collect()}  # at most 33 x 33 cells
    chunks = {cell: -(-n // tile) for cell, n in sizes.items()}
    first, total = {}, 0
    for cell in sorted(chunks):
        first[cell], total = total, total + chunks[cell]
    code = F.col("p") * 33 + F.col("q")
    cells = [first.get(divmod(c, 33), 0) for c in range(33 * 33)], [chunks.get(divmod(c, 33), 1) for c in range(33 * 33)]
    number = F.get(F.lit(cells[0]), code) + F.pmod(F.xxhash64("fp"), F.get(F.lit(cells[1]), code)).cast("int")
    tiles = celled.select("fp", number.alias("tile"), code.alias("cell")).groupBy("tile", "cell").agg(F.collect_list("fp").alias("fps"))
    tiles = land(tiles, run_folder(spark, "tiles"))
    reach = [[] for _ in range(33 * 33)]  # per cell: first and last tile of each cell at hand, from itself on
    for (p, q), n in sorted(chunks.items()):
        for (r, s), m in sorted(chunks.items()):
            if abs(p - r) + abs(q - s) <= radius and (p, q) <= (r, s):
                reach[p * 33 + q].append((first[r, s], first[r, s] + m - 1))
    near = [(c, x, y) for c, spans in enumerate(reach) for x, y in spans]
    spans = spark.createDataFrame(near or [(-1, 0, 0)], "cell int, x int, y int")
    pairs = tiles.select("tile", "cell").join(spans, "cell").select("tile", F.explode(F.sequence("x", "y")).alias("other")).where("tile <= other")
    left = pairs.join(tiles.select("tile", F.col("fps").alias("a")), "tile")
    both = left.join(tiles.select(F.col("tile").alias("other"), F.col("fps").alias("b")), "other")

    def compared(batches):
        for batch in batches:
            for same, a, b in zip(batch.column("same").to_pylist(), batch.column("a"), batch.column("b")):
                x = a.values.to_numpy(zero_copy_only=False).view(np.uint64)
                y = None if same else b.values.to_numpy(zero_copy_only=False).view(np.uint64)
                u, v = forest(x, y, radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["a", "b"])

    return both.select((F.col("tile") == F.col("other")).alias("same"), "a", "b").mapInArrow(compared, "a long, b long")


def classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Per row of ``docs``: __id, __hash, fp, root (the component's smallest fingerprint) and component_id, the smallest __id reachable.

    Only ``root`` tells components apart: those of null ids, or of one repeated id, share a component_id."""
    marked = land(fingerprints(docs, shingle), run_folder(docs.sparkSession, "simhash"))
    nodes = marked.groupBy("fp").agg(F.min("__id").alias("least"))
    roots = components(links(nodes.select("fp"), radius, tile)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, its smallest ``doc_id`` (then the smaller text hash), all columns."""
    found = classes(docs, shingle, radius)
    first = found.groupBy("root").agg(F.min(F.struct("__id", "__hash")).alias("k")).select("k.*")
    copies = found.groupBy("__id", "__hash").agg(F.count(F.lit(1)).alias("__copies"))
    return rows_chosen(docs, copies.join(first, ["__id", "__hash"]))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (contract of op7)."""
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(
        F.nullif("__id", F.lit(LAST_ID)).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.nullif("component_id", F.lit(LAST_ID)).alias("component_id"))
