"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time (operator 11).

1. ``index`` turns the documents, in one map-only pass, into segments of bounded size: for
   each term of a segment a posting list (local document numbers and frequencies, in binary
   columns), and one row with the segment's identifiers and lengths.  All terms are indexed,
   so any queries can be searched.  A term that stands in every document is a list a
   segment, never one list.
2. Document counts and frequencies come from the index; a query term's weight follows.
3. ``search`` brings the lists of the queries' terms together by segment and block of
   queries.  In a segment, each query's lists are split by length.  The short ones are
   processed term at a time into summed accumulators; these are then one more iterator, with
   the largest sum as its bound, among the long lists, which are processed document at a
   time: only documents of the iterators that can still lift a document over the current
   k-th score are visited, and the other lists are looked up only for documents whose bound
   reaches it.  Documents are visited a window at a time, so that numpy does the sums.
4. The segments' best are merged per query (each map task passes on its own k best).

Skew: lists meet their terms' queries salted by segment; a group is one segment and one block
of queries.  Nothing is broadcast by hint: the terms' table is written first, so that Spark
knows its size.

Scores are 64-bit integers and exact; the result does not depend on the segments.

Defined cases: null texts and texts without a term count nowhere and are never found; null
items have no terms and no result; items that repeat an ``item_id`` are ranked apart, each
with ranks from 1; rows that repeat a ``doc_id`` are documents of their own; a null ``doc_id``
comes after every number among equal scores; empty tables give an empty result; extra
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, run_folder, table

K = 10
#: What stands between terms: ASCII that is neither letter nor digit.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A segment is closed at this many documents or terms (a longer document is one of its own).
SEGMENT_DOCS, SEGMENT_TERMS = 1 << 14, 1 << 22
#: Characters whose terms are split at once.
SPLIT_CHARS = 1 << 22
#: Lists up to this length are short: processed term at a time.
SHORT = 256
#: Documents of a window.
WINDOW = 2048
#: Queries of a block, about.
BLOCK = 512
#: Pieces that a term's lists are dealt into for the join with its queries.
SALTS = 16
POSTINGS = "segment long, term string, docs binary, tfs binary, n long, ids array<long>, lengths array<long>"


class _Segment:
    """Terms of documents as they come, by code; emptied into the rows of a segment."""

    def __init__(self):
        self.codes: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.codes.clear()
        self.ids: list[pa.Array] = []
        self.keys: list[np.ndarray] = []  # code * SEGMENT_DOCS + local document
        self.lengths: list[np.ndarray] = []
        self.docs = self.terms = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        """Documents with their texts (no nulls)."""
        parts = pc.split_pattern_regex(pc.ascii_lower(texts), GAP)
        ends = parts.offsets.to_numpy()
        words = parts.values[ends[0]:ends[-1]].dictionary_encode()
        distinct, code = words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        number = np.fromiter((self.codes.setdefault(t, len(self.codes)) if t else -1 for t in distinct), np.int64, len(distinct))
        doc = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(ends))
        code = number[code] if len(distinct) else code
        doc, code = doc[code >= 0], code[code >= 0]
        self.lengths.append(np.bincount(doc, minlength=len(texts)).astype(np.int64))
        self.keys.append(code * SEGMENT_DOCS + (doc + self.docs))
        self.ids.append(ids)
        self.docs += len(texts)
        self.terms += len(code)

    def full(self) -> bool:
        return self.docs >= SEGMENT_DOCS or self.terms >= SEGMENT_TERMS

    def rows(self, segment: int) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("segment", pa.int64()), ("term", pa.string()), ("docs", pa.binary()), ("tfs", pa.binary()), ("n", pa.int64()),
                            ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])
        lengths = np.concatenate(self.lengths)
        meta = [[segment], [None], [None], [None], [int((lengths > 0).sum())], [pa.concat_arrays(self.ids).to_pylist()], [lengths.tolist()]]
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(meta, schema)], schema=schema)
        keys, tfs = np.unique(np.concatenate(self.keys), return_counts=True)
        code, docs = keys // SEGMENT_DOCS, (keys % SEGMENT_DOCS).astype("<i4")
        starts = np.searchsorted(code, np.arange(len(self.codes) + 1))

        def lists(values: np.ndarray) -> pa.Array:
            return pa.BinaryArray.from_buffers(pa.binary(), len(self.codes), [None, pa.py_buffer((starts * 4).astype("<i4")), pa.py_buffer(values)])

        columns = [pa.array(np.full(len(self.codes), segment)), pa.array(list(self.codes), pa.string()), lists(np.ascontiguousarray(docs)),
                   lists(tfs.astype("<i4")), pa.array(np.diff(starts)), pa.nulls(len(self.codes), schema.field("ids").type), pa.nulls(len(self.codes), schema.field("lengths").type)]
        yield from pa.Table.from_arrays(columns, schema=schema).to_batches(max_chunksize=1 << 14)


def _slices(texts: pa.Array, room: int) -> Iterable[tuple[int, int]]:
    """(start, stop) of consecutive texts with few characters and at most ``room`` rows each."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(size, (size[at - 1] if at else 0) + SPLIT_CHARS, side="right"))
        stop = min(max(stop, at + 1), at + room, len(texts))
        yield at, stop
        at = stop


def index(docs: DataFrame, folder: str) -> DataFrame:
    """The written index of ``docs`` (doc_id, text): rows of POSTINGS; a row without a term describes its segment."""

    def built(batches):
        segment, number = _Segment(), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for at, stop in _slices(texts, SEGMENT_DOCS // 2):
                if segment.docs and segment.docs + stop - at > SEGMENT_DOCS:
                    yield from segment.rows(number)
                    number += 1
                    segment.clear()
                segment.add(ids[at:stop], texts[at:stop])
                if segment.full():
                    yield from segment.rows(number)
                    number += 1
                    segment.clear()
        if segment.docs:
            yield from segment.rows(number)

    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return land(rows.mapInArrow(built, POSTINGS), folder)


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: documents (ascending) and the sums of their scores in ``lists``."""
    docs = np.concatenate([d for d, _ in lists])
    order = np.argsort(docs, kind="stable")
    docs = docs[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[first], np.add.reduceat(np.concatenate([s for _, s in lists])[order], first)


def best(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, k: int, short: int = SHORT, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Local documents and scores of the k best by (score, then smaller id), from lists of (documents ascending, scores)."""
    small = [x for x in lists if len(x[0]) <= short]
    iterators = [x for x in lists if len(x[0]) > short]
    if small:
        iterators.append(accumulate(small))  # one bounded iterator among the others
    iterators = sorted(iterators, key=lambda x: int(x[1].max()))
    bounds = np.cumsum([int(s.max()) for _, s in iterators])  # the most that the first 1, 2, ... iterators can add up to
    at = [0] * len(iterators)
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = 1  # a document needs this score
    while True:
        lead = int(np.searchsorted(bounds, least))  # documents that stand only in iterators before it can't reach it
        heads = [iterators[j][0][at[j]] for j in range(lead, len(iterators)) if at[j] < len(iterators[j][0])]
        if not heads:
            return docs, scores
        low = int(min(heads))
        sums, seen = np.zeros(window, np.int64), np.zeros(window, bool)
        for j in range(lead, len(iterators)):
            d, s = iterators[j]
            stop = int(np.searchsorted(d, low + window))
            here = d[at[j]:stop] - low
            sums[here] += s[at[j]:stop]
            seen[here] = True
            at[j] = stop
        found = np.flatnonzero(seen)
        total = sums[found]
        for j in range(lead - 1, -1, -1):
            alive = total + bounds[j] >= least
            found, total = found[alive], total[alive]
            if not len(found):
                break
            d, s = iterators[j]
            place = np.minimum(np.searchsorted(d, found + low), len(d) - 1)
            total = total + np.where(d[place] == found + low, s[place], 0)
        docs, scores = np.concatenate([docs, found + low]), np.concatenate([scores, total])
        keep = np.lexsort((ids[docs], -scores))[:k]
        keep = keep[scores[keep] >= least]
        docs, scores = docs[keep], scores[keep]
        if len(docs) == k:
            least = int(scores[-1])


def search_segment(rows: pa.Table, documents: int, terms: int, k: int) -> pa.Table:
    """The k best documents of one segment for each query of a block: query, doc_id, score."""
    meta, lists = None, []
    for row in rows.to_pylist():
        if row["term"] is None:
            meta = row
        else:
            lists.append(row)
    n = np.array(meta["lengths"], np.int64)
    ids = np.array([2**63 - 1 if i is None else i for i in meta["ids"]], np.int64)
    order = np.argsort(np.array([i is None for i in meta["ids"]]), kind="stable")  # nulls after the largest id
    rank = np.empty(len(ids), np.int64)
    rank[order[np.argsort(ids[order], kind="stable")]] = np.arange(len(ids))
    m = 25 + (75 * n * documents) // terms
    per_query: dict[int, list] = {}
    for row in lists:
        docs, tf = np.frombuffer(row["docs"], "<i4").astype(np.int64), np.frombuffer(row["tfs"], "<i4").astype(np.int64)
        scores = row["w"] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[docs]))
        for use in row["uses"]:
            per_query.setdefault(use["q"], []).append((docs, scores * use["times"]))
    out: list[tuple[int, int | None, int]] = []
    for q, parts in per_query.items():
        docs, scores = best(parts, rank, k)
        out += [(q, meta["ids"][d], s) for d, s in zip(docs.tolist(), scores.tolist())]
    columns = list(zip(*out)) or [[], [], []]
    return pa.table({name: pa.array(list(c), pa.int64()) for name, c in zip(("q", "doc_id", "score"), columns)})


def terms_of(text: Column) -> Column:
    """All terms of a text, A-Z lower-cased, with repeats."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, GAP), lambda t: t != "")


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    folder = run_folder(spark, "lexical")
    postings = index(docs, f"{folder}/index")
    items = land(items.select(F.monotonically_increasing_id().alias("q"), "item_id", "text"), f"{folder}/items")
    blocks = max(1, -(-items.count() // block))
    used = items.select("q", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("q", "term").agg(F.count(F.lit(1)).alias("times"))
    used = land(used, f"{folder}/used")
    vocabulary = land(used.select("term").distinct(), f"{folder}/vocabulary")

    segments = postings.where("term IS NULL")
    size = segments.agg(F.sum("n").alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms")).first()
    documents, terms = size.n or 0, size.terms or 1
    wanted = postings.where("term IS NOT NULL").join(vocabulary, "term")
    counts = wanted.groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(documents) + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    number = F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("block")
    uses = used.groupBy("term", number).agg(F.collect_list(F.struct("q", "times")).alias("uses"))
    weighted = land(uses.join(counts.select("term", weight.alias("w")), "term").where("w > 0"), f"{folder}/weighted")

    salt = F.pmod(F.xxhash64("segment"), F.lit(SALTS)).cast("int").alias("salt")
    salted = weighted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lists = postings.where("term IS NOT NULL").select("segment", "term", "docs", "tfs", salt).join(salted, ["term", "salt"])
    lists = lists.select("segment", "block", "term", "docs", "tfs", "w", "uses", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<long>").alias("lengths"))
    nothing = [F.lit(None).cast(lists.schema[c].dataType).alias(c) for c in ("term", "docs", "tfs", "w", "uses")]
    about = segments.select("segment", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), *nothing, "ids", "lengths")

    def searched(rows: pa.Table) -> pa.Table:
        return search_segment(rows, documents, terms, k)

    found = lists.unionByName(about).groupBy("segment", "block").applyInArrow(searched, "q long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))).alias("rank")
    ranked = found.select("q", place, "doc_id", "score").where(F.col("rank") <= k)
    return ranked.join(items.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item (contract of op11)."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS d, doc_id,
    list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '') AS terms
  FROM documents WHERE text IS NOT NULL
), item_terms AS (
  SELECT row_number() OVER () AS q, item_id,
    list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: t <> '') AS terms
  FROM benchmark WHERE text IS NOT NULL
), size AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc_terms
), tf AS (
  SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc_terms) GROUP BY ALL
), weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) CROSS JOIN size
), asked AS (
  SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(terms) AS term FROM item_terms) GROUP BY ALL
), scored AS (
  SELECT q, item_id, d, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) CROSS JOIN size GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
