"""Conflict-constrained best-fit packing (operator 9).

Documents are packed into sequences (bins) of ``capacity`` words so that no bin holds
two pieces of one source or of one duplicate cluster.  A longer document is cut into
full pieces and one rest, so nothing is lost.  Rows are dealt by a hash of their
identity into shards of about ``SHARD_ROWS`` rows; rows that are equal in id, text and
source are counted first and their copies dealt one by one over the shards that follow.
Each shard is packed by one task on its narrow columns alone (no texts move).  In a shard, pieces go in by falling
length; open bins are kept in order of their residual, each with a bitmap of the
sources and one of the duplicate clusters it holds.  The search starts at the smallest
residual that fits and goes on through the successors until a compatible bin is found,
which is thus the tightest one; if there is none, a bin is opened.

A shard's size does not grow with the data, and a hot source, cluster or repeated row is
spread over all shards, so no task holds more than its share.

Defined cases: null or empty texts have no words and go into the tightest compatible
bin; a null source or cluster conflicts with nothing; ties go by doc_id (nulls last),
then text hash; repeated rows are packed one by one; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import LAST_ID, row_key, table, text_of

CAPACITY = 2048
SHARD_ROWS = 4096
WORD = r"[^\x20\x09-\x0D]+"
PLAN = "doc_id long, text_hash long, piece int, piece_start long, n_words long, bin_id long, bin_start long, bin_words long"
BINS_PER_SHARD = 2**32


def duplicate_cluster(text: Column) -> Column:
    """Texts that differ only in case, punctuation or white space share a cluster; null for texts without a letter or digit."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain != "", F.xxhash64(plain))


class Bins:
    """Open bins in order of (residual, number), with the bitmaps of what they hold."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.last: tuple = (None, None)  # the piece before, and where the bins behind its own begin

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Put a piece in the tightest compatible bin; returns (bin, start in it).

        The bins up to that of a piece just like the one before are known to conflict."""
        like, behind = self.last
        k = bisect_left(self.order, behind if like == (size, source, cluster) else (size, -1))
        while k < len(self.order):
            residual, b = self.order[k]
            if not (self.sources[b] & source or self.clusters[b] & cluster):
                del self.order[k]
                break
            k += 1
        else:
            residual, b = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.last = ((size, source, cluster) if source or cluster else None, (residual, b + 1))
        self.sources[b] |= source
        self.clusters[b] |= cluster
        insort(self.order, (residual - size, b))
        return b, self.capacity - residual


def _bits(values: list) -> list[int]:
    """One bit for each value that occurs more than once (a single one can't conflict), none for null."""
    seen, bit = {}, {}
    for v in values:
        if v is not None and v == v:
            seen[v] = seen.get(v, 0) + 1
    for v, n in seen.items():
        if n > 1:
            bit[v] = 1 << len(bit)
    return [bit.get(v, 0) for v in values]


def pack_pieces(pieces: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, start) of each (size, source, cluster), taken in the given order."""
    bins = Bins(capacity)
    sources, clusters = _bits([p[1] for p in pieces]), _bits([p[2] for p in pieces])
    return [bins.place(p[0], s, c) for p, s, c in zip(pieces, sources, clusters)]


def dealt(rows: DataFrame, identity: list[str], shards: int) -> DataFrame:
    """Distinct rows with the shards their copies go to: ``shard`` and ``copies``, how many of them it gets.

    The first copy's shard is a hash of the row, the next ones go to the shards after it
    in turn; counts alone decide, so a task that is run again deals the same."""
    counted = rows.groupBy(*identity).agg(F.count(F.lit(1)).alias("total"))
    turn = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("total"), F.lit(shards)) - 1)).alias("turn")
    first = F.pmod(F.xxhash64("__id", "__hash"), F.lit(shards))
    copies = F.floor((F.col("total") - F.col("turn") - 1) / shards) + 1
    return counted.select(*identity, "total", turn).select(*identity, copies.cast("long").alias("copies"), F.pmod(first + F.col("turn"), F.lit(shards)).alias("shard"))


def plan(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Where each piece of each document goes (schema ``PLAN``); ``docs`` has doc_id, text and source."""
    n = docs.count()
    shards = max(1, -(-n // shard_rows))
    size = F.regexp_count(text_of("text"), F.lit(WORD)).cast("long").alias("n")
    cluster = duplicate_cluster(text_of("text")).cast("string").alias("cluster")
    rows = row_key(docs).select("__id", "__hash", F.col("doc_id").isNull().alias("no_id"), "source", size, cluster)
    rows = dealt(rows, ["__id", "__hash", "no_id", "source", "n", "cluster"], shards)

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["shard"].iloc[0])
        clusters = group["cluster"].astype(object).where(group["cluster"].notna(), None)
        pieces = []
        ids = zip(group["__id"].tolist(), group["no_id"].tolist())
        rest = zip(group["__hash"].tolist(), group["source"].tolist(), group["n"].tolist(), clusters.tolist(), group["copies"].tolist())
        for i, (h, source, words, cluster, copies) in zip(ids, rest):
            cuts = range(0, max(words, 1), capacity)
            pieces += [(min(capacity, words - at), source, cluster, i, h, k, at) for k, at in enumerate(cuts)] * copies
        pieces.sort(key=lambda p: (-p[0], p[3], p[4], p[5]))
        placed = pack_pieces([p[:3] for p in pieces], capacity)
        filled: dict[int, int] = {}
        for p, (b, _) in zip(pieces, placed):
            filled[b] = filled.get(b, 0) + p[0]
        return pd.DataFrame({
            "__id": [p[3][0] for p in pieces], "no_id": [p[3][1] for p in pieces], "text_hash": [p[4] for p in pieces], "piece": [p[5] for p in pieces], "piece_start": [p[6] for p in pieces],
            "n_words": [p[0] for p in pieces], "bin_id": [shard * BINS_PER_SHARD + b for b, _ in placed], "bin_start": [s for _, s in placed], "bin_words": [filled[b] for b, _ in placed]})

    out = rows.groupBy("shard").applyInPandas(packed, PLAN.replace("doc_id long", "__id long, no_id boolean"))
    return out.withColumn("doc_id", F.when(~F.col("no_id"), F.col("__id"))).select("doc_id", *[c.split()[0] for c in PLAN.split(", ")[1:]])


def sequences(docs: DataFrame, packed: DataFrame) -> DataFrame:
    """One row per bin: bin_id, n_words and its text, the pieces' words in bin order joined by spaces."""
    words = F.regexp_extract_all(text_of("text"), F.lit(WORD), F.lit(0))
    texts = row_key(docs).select("__id", F.col("__hash").alias("text_hash"), words.alias("w")).dropDuplicates(["__id", "text_hash"])
    cut = packed.withColumn("__id", F.coalesce("doc_id", F.lit(LAST_ID))).join(texts, ["__id", "text_hash"])
    piece = F.array_join(F.slice("w", (F.col("piece_start") + 1).cast("int"), F.col("n_words").cast("int")), " ")
    held = cut.select("bin_id", "bin_words", F.struct("bin_start", "n_words", piece.alias("t")).alias("p")).groupBy("bin_id", "bin_words").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    return held.select("bin_id", F.col("bin_words").alias("n_words"), F.array_join(F.transform(F.filter("ps", lambda p: p["n_words"] > 0), lambda p: p["t"]), " ").alias("text"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bin of every piece of every document."""
    return plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
