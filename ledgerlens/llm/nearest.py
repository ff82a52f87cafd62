"""Nearest neighbours by a block matrix join (operator 3).

Queries and candidates are dealt by a hash into tiles of bounded size; every
candidate tile meets every query tile once (a stated query set against all rows, in
blocks).  In a pair of tiles the unit vectors are quantised to int8; the int8 product
tile gives each cosine with a proven error bound (the norms of the quantisation
residuals).  Pairs whose upper bound is below a query's k-th largest lower bound can't
be among its k nearest and are dropped; the survivors are recomputed in double
precision from the original vectors.  Each task merges its pairs' lists into one heap
of k per query, and a last exchange by query merges those heaps.  The result is exact.

Hot vectors: of candidates with the same vector in a tile only the k + 1 smallest ids
can be wanted (ties go to the smaller id, and one may be the query itself), so copies
never multiply the survivors.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and rows without an id, take no part; vectors of other lengths are not
compared; rows that repeat an id count once, with the smallest vector; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, run_folder, table

K = 5
QUERY_TILE, CANDIDATE_TILE = 2048, 8192
#: Surviving pairs recomputed at once.
PAIRS = 1 << 16


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, one per id."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & some).groupBy("vec_id").agg(F.min("v").alias("v"))


def _tiles(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Tiles of about ``size`` rows per vector length, and the number of tiles of each length."""
    counts = rows.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count(F.lit(1)) / size).alias("n"))
    tile = F.pmod(F.xxhash64("vec_id"), F.col("n")).cast("int")
    dealt = rows.withColumn("dim", F.size("v")).join(counts, "dim").select("dim", tile.alias(name), "vec_id", "v")
    return dealt.groupBy("dim", name).agg(F.collect_list(F.struct("vec_id", "v")).alias(f"{name}_rows")), counts


def _unpacked(rows: pa.Scalar, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = rows.values.field("vec_id").to_numpy(zero_copy_only=False)
    vectors = rows.values.field("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids, vectors.reshape(-1, dim)


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, their scales, the codes' norms and the residuals' norms."""
    unit = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.sqrt((back * back).sum(axis=1)), np.sqrt(((unit - back) ** 2).sum(axis=1))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def wanted_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows that are among the k + 1 smallest ids of those with their vector."""
    _, group = np.unique(vectors, axis=0, return_inverse=True)
    group = group.ravel()
    order = np.lexsort((ids, group))
    at = group[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    return order[rank <= k]


def nearest_in_tile(q_ids, q, c_ids, c, k: int):
    """(query id, candidate id, cosine) of each query's k best candidates of the tile at least."""
    keep = wanted_copies(c_ids, c, k)
    c_ids, c = c_ids[keep], c[keep]
    qc, qs, qn, qe = quantised(q)
    cc, cs, _, ce = quantised(c)
    exact = np.float32 if q.shape[1] <= 1000 else np.float64  # sums of int8 products below 2**24 are exact in float32
    approx = (qc.astype(exact) @ cc.astype(exact).T).astype(np.float64) * qs[:, None] * cs[None, :]
    bound = qn[:, None] * ce[None, :] + qe[:, None] + 1e-9
    own = q_ids[:, None] == c_ids[None, :]
    low, high = np.where(own, -np.inf, approx - bound), np.where(own, -np.inf, approx + bound)
    least = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(q), -np.inf)
    i, j = np.nonzero((high >= least[:, None]) & ~own)
    score = np.concatenate([np.zeros(0)] + [cosine(q[i[a:a + PAIRS]], c[j[a:a + PAIRS]]) for a in range(0, len(i), PAIRS)])
    return q_ids[i], c_ids[j], score


class Heaps:
    """The k best (score, then smaller id) of each query."""

    def __init__(self, k: int):
        self.k, self.of = k, {}

    def add(self, query: int, score: float, candidate: int) -> None:
        heap = self.of.setdefault(query, [])
        if len(heap) < self.k:
            heapq.heappush(heap, (score, -candidate))
        elif (score, -candidate) > heap[0]:
            heapq.heapreplace(heap, (score, -candidate))

    def batch(self, ranked: bool) -> pa.RecordBatch:
        rows = [(q, r, -c, s) for q, heap in self.of.items() for r, (s, c) in enumerate(sorted(heap, reverse=True), 1)]
        columns = {"query_id": pa.array([r[0] for r in rows], pa.int64()), "rank": pa.array([r[1] for r in rows], pa.int32()),
                   "vec_id": pa.array([r[2] for r in rows], pa.int64()), "score": pa.array([r[3] for r in rows], pa.float64())}
        return pa.RecordBatch.from_pydict(columns if ranked else {n: columns[n] for n in ("query_id", "vec_id", "score")})


def search(vectors: DataFrame, is_query: Column, k: int = K, query_tile: int = QUERY_TILE, candidate_tile: int = CANDIDATE_TILE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each query by cosine."""
    spark = vectors.sparkSession
    rows = land(usable(vectors), run_folder(spark, "vectors"))
    queries, n_tiles = _tiles(rows.where(is_query), query_tile, "q")
    candidates, _ = _tiles(rows, candidate_tile, "c")
    meets = F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("q")
    pairs = candidates.join(n_tiles, "dim").select("dim", "c", "c_rows", meets).join(queries, ["dim", "q"])

    def compared(batches):
        heaps = Heaps(k)
        for batch in batches:
            for dim, qr, cr in zip(batch.column("dim").to_pylist(), batch.column("q_rows"), batch.column("c_rows")):
                q_ids, q = _unpacked(qr, dim)
                c_ids, c = _unpacked(cr, dim)
                for a, b, s in zip(*(x.tolist() for x in nearest_in_tile(q_ids, q, c_ids, c, k))):
                    heaps.add(a, s, b)
        yield heaps.batch(False)

    def merged(batches):
        heaps = Heaps(k)
        for batch in batches:
            for a, b, s in zip(*(batch.column(n).to_pylist() for n in ("query_id", "vec_id", "score"))):
                heaps.add(a, s, b)
        yield heaps.batch(True)

    lists = pairs.select("dim", "q_rows", "c_rows").mapInArrow(compared, "query_id long, vec_id long, score double")
    return lists.repartition("query_id").mapInArrow(merged, "query_id long, rank int, vec_id long, score double")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector (contract of op3)."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
