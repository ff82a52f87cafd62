"""Token-ID output as one wavelet matrix per shard (operator 8).

Documents are range-partitioned and sorted by doc_id; each task cuts its documents into
texts' chunks (``chunks``), has the tokenizers library encode each distinct chunk it
meets once, appends the end id, and builds a wavelet matrix file per shard of about
``SHARD_TOKENS`` ids.  Shards are rows of a Parquet table in the shared folder (so any
store that Spark writes will do): place, counts, and the file's bytes.  A shard's place
among all is the sum of the ids of the ranges before it: one number per range.

Skew: ranges come from a sample of (doc_id, text hash), shards are cut inside them, so neither a hot
source nor long texts make a large task or file; memory is bounded by a shard, the
longest text, and ``CACHE`` distinct chunks a worker.

Defined cases: null and empty texts hold the end id alone; rows without an id come
first; rows that repeat an id are all kept, by the texts' hash; strings of added tokens
in a text get the ids that the library gives them; an empty table gives no file; extra columns are not read.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.chunks import numbered, spaced_words
from ledgerlens.llm.common import run_folder, table, text_of
from ledgerlens.llm.wavelet import WaveletMatrix

SHARD_TOKENS = 1 << 20
CACHE = 1_500_000
#: Parts that the library gets at a time.
GROUP = 512
#: Runs of about ``SHARD_TOKENS`` characters that are encoded at a time: their distinct words are looked up once.
RUNS = 4
END_ID = 0
FILES = "part int, shard int, start_in_part long, n_docs long, n_tokens long, doc_ids binary, without_id long, file binary"


#: Letters or digits, then other marks, perhaps a line feed and the next line's first word: the pattern never matches across these places.
_WORD_AND_MARKS = re.compile(r"( ?[^\W_]+)([^\w\s']+)(?:(\n)([^\W_]+)([^\w\s']+)?)?")


class _Ragged:
    """Arrays of ids, one after another; grows by doubling."""

    def __init__(self, dtype):
        self.flat, self.starts, self.n = np.empty(1 << 16, dtype), np.zeros(1 << 14, np.int64), 0

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        size = int(self.starts[self.n])
        if size + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[:size], np.empty(max(size, len(flat)), self.flat.dtype)])
        self.flat[size:size + len(flat)] = flat
        if self.n + len(lengths) >= len(self.starts):
            self.starts = np.concatenate([self.starts[: self.n + 1], np.zeros(max(self.n, len(lengths)) + 1, np.int64)])
        self.starts[self.n + 1:self.n + 1 + len(lengths)] = size + np.cumsum(lengths)
        self.n += len(lengths)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The given arrays one after another, and their lengths."""
        starts = self.starts[rows]
        lengths = self.starts[rows + 1] - starts
        ends = np.cumsum(lengths)
        size = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(size, len(self.flat)) < 1 << 31 else np.int64
        at = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
        at += np.arange(size, dtype=kind)
        return self.flat.take(at), lengths


class Encoder:
    """Ids of whole texts by the tokenizers library.  Distinct chunks are cut into a word and the marks
    after it, or as the pattern says; each distinct part is encoded once while it is kept (a part's ids don't depend on its
    neighbours, since the pattern cuts there), and a chunk's ids are those of its parts.  Parts that begin with a space are handed to the library one
    after another and told apart by the bytes of their ids, since the pattern cuts before such a space; others are joined by line feeds,
    which are tokens of their own between parts that hold none."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.pattern = public_tokenizers.PATTERN
        self.tokenizer = Tokenizer.from_file(vocabulary)
        #: Strings that the library makes one id wherever they stand; a text with one is encoded by itself.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        (self.feed,) = self._ids("\n")
        vocab = self.tokenizer.get_vocab()
        #: Bytes of each id: a character of a token stands for one.
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        self.sizes[np.fromiter(vocab.values(), np.int64, len(vocab))] = np.fromiter(map(len, vocab), np.int64, len(vocab))
        self._forget()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _forget(self) -> None:
        #: Numbers of chunks: a space and the word (as bytes); other chunks.
        count = itertools.count()
        self.words: dict[bytes, int] = defaultdict(count.__next__)
        self.others: dict[str, int] = defaultdict(count.__next__)
        self.parts: dict[str, int] = defaultdict(itertools.count().__next__)
        self.chunk_ids, self.part_ids = _Ragged(np.uint16), _Ragged(np.uint16)

    def _numbers(self, known: defaultdict, keys: list, chunk: Callable[[list], list[str]]) -> np.ndarray:
        """The numbers of keys; the new ones among them are learnt, as ``chunk`` makes chunks of them."""
        numbers, new = numbered(known, keys, self.chunk_ids.n)
        if new:
            self._learn(chunk(new))
        return numbers

    def _learn(self, new: list[str]) -> None:
        """Cut new chunks and encode the parts they bring."""
        cut, counts, match, pieces = [], [], _WORD_AND_MARKS.fullmatch, regex.compile(self.pattern).findall
        for chunk in new:
            if chunk[1:].isalpha():
                cut.append(chunk)
                counts.append(1)
                continue
            m = match(chunk)
            parts = [p for p in m.groups() if p] if m else pieces(chunk)
            cut += parts
            counts.append(len(parts))
        numbers, words = numbered(self.parts, cut, self.part_ids.n)
        kinds: tuple[list, list, list] = [], [], []
        for k, w in enumerate(words):
            spaced = w[0] == " " and len(w) > 1 and not w[1].isspace()
            kinds[2 if "\n" in w or w[-1].isspace() else 0 if spaced else 1].append(k)
        found, order = _Ragged(np.uint16), np.empty(len(words), np.int64)
        for kind, rows in zip((self._spaced, self._fed, self._alone), kinds):
            order[rows] = np.arange(found.n, found.n + len(rows))
            for a in range(0, len(rows), GROUP):
                found.add(*kind([words[k] for k in rows[a:a + GROUP]]))
        self.part_ids.add(*found.take(order))
        ids, lengths = self.part_ids.take(numbers)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        self.chunk_ids.add(ids, np.diff(ends, prepend=0))

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each encoded by itself, and their numbers."""
        lists = [np.array(self._ids(w), np.uint16) for w in words]
        return np.concatenate(lists), np.array([len(x) for x in lists])

    def _spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that begin with one space and don't end with any."""
        text = "".join(words)
        ids = np.array(self._ids(text), np.uint16)
        ends = np.cumsum(self.sizes[ids])
        sizes = np.fromiter(map(len, words) if text.isascii() else (len(w.encode()) for w in words), np.int64, len(words))
        edges = np.cumsum(sizes)
        last = np.searchsorted(ends, edges)
        if ends[-1] != edges[-1] or (ends[last] != edges).any():
            return self._alone(words)
        return ids, np.diff(last, prepend=-1)

    def _fed(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words without white space at their end or line feeds."""
        ids = np.array(self._ids("\n".join(words)), np.uint16)
        feeds = np.nonzero(ids == self.feed)[0]
        if len(feeds) != len(words) - 1:
            return self._alone(words)
        return np.delete(ids, feeds), np.diff(np.concatenate([[-1], feeds, [len(ids)]])) - 1

    def encode(self, texts: list[str] | pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id after it, and their numbers."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if self.chunk_ids.n > CACHE:
            self._forget()
        whole = {k for a in self.added for k in np.flatnonzero(pc.match_substring(texts, a)).tolist()}
        if whole:
            own = {k: np.array([*self._ids(texts[k].as_py()), END_ID], np.uint16) for k in whole}
            rest = np.ones(len(texts), bool)
            rest[list(whole)] = False
            ids, lengths = self.encode(pc.if_else(pa.array(rest), texts, ""))
            per_text = [own.get(k, x) for k, x in enumerate(np.split(ids, np.cumsum(lengths)[:-1]))]
            return np.concatenate(per_text), np.array([len(x) for x in per_text])
        if not len(texts):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        words, codes, at, ragged = spaced_words(texts)
        distinct = words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        first = codes[at[:-1]]
        codes = self._numbers(self.words, distinct, lambda new: [" " + w.decode() for w in new])[codes]
        opening, of = np.unique(first, return_inverse=True)  # a text's first word has no space before it
        codes[at[:-1]] = self._numbers(self.others, [distinct[k].decode() or " " for k in opening], list)[of]
        per_text = np.diff(at)
        drop = [k for k in np.flatnonzero(np.fromiter((not distinct[k] for k in opening), bool, len(opening))[of]).tolist()]
        if ragged or drop:
            pieces = np.split(codes, at[1:-1])
            for k in drop:  # nothing before the first space
                pieces[k] = pieces[k][1:]
            for k, its in ragged.items():
                pieces[k] = self._numbers(self.others, its, list)
            codes, per_text = np.concatenate(pieces), np.array([len(p) for p in pieces], np.int64)
        ids, per_chunk = self.chunk_ids.take(codes)
        at = np.concatenate([[0], np.cumsum(per_chunk)])[np.cumsum(per_text)]
        return np.insert(ids, at, END_ID), np.diff(np.concatenate([[0], at])) + 1


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """A worker process keeps its encoder from task to task."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def _runs(batches, characters: int) -> Iterator[tuple[int, pa.Array, pa.StringArray]]:
    """Part, ids and texts of consecutive documents: runs that end with the document that makes them as long."""
    ids, texts, size = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py()
        sizes = np.cumsum(np.asarray(pc.utf8_length(batch.column("text"))), dtype=np.int64)
        at, before = 0, 0
        while at < batch.num_rows:
            stop = min(int(np.searchsorted(sizes, before + characters - size)) + 1, batch.num_rows)
            ids.append(batch.column("doc_id").slice(at, stop - at))
            texts.append(batch.column("text").slice(at, stop - at))
            size, before, at = size + int(sizes[stop - 1]) - before, int(sizes[stop - 1]), stop
            if size >= characters:
                yield part, pa.concat_arrays(ids), pa.concat_arrays(texts)
                ids, texts, size = [], [], 0
    if ids:
        yield part, pa.concat_arrays(ids), pa.concat_arrays(texts)


def _encoded(runs, enc: Encoder) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """Part, documents, their ids and lengths of each run; ``RUNS`` of them are encoded at a time."""
    runs = iter(runs)
    while some := list(itertools.islice(runs, RUNS)):
        flat, n = enc.encode(pa.concat_arrays([texts for _, _, texts in some]))
        docs = np.cumsum([0, *(len(texts) for _, _, texts in some)])
        ends = np.concatenate([[0], np.cumsum(n)])[docs]
        for k, (part, ids, _) in enumerate(some):
            yield part, ids, flat[ends[k]:ends[k + 1]], n[docs[k]:docs[k + 1]]


def _shards(batches, vocabulary: str, shard_tokens: int):
    """Wavelet files of the sorted documents of one range."""
    shard, start = 0, 0
    tokens, lengths, named, held = [], [], [], 0

    def file(part):
        nonlocal tokens, lengths, named, held, shard, start
        flat, n, ids = np.concatenate(tokens), np.concatenate(lengths), pa.concat_arrays(named)
        row = {
            "part": [part], "shard": [shard], "start_in_part": [start], "n_docs": [len(n)], "n_tokens": [len(flat)],
            "doc_ids": [np.asarray(ids.fill_null(0)).astype("<i8").tobytes()], "without_id": [ids.null_count],
            "file": [WaveletMatrix(flat, n).to_bytes()]}
        shard, start = shard + 1, start + len(flat)
        tokens, lengths, named, held = [], [], [], 0
        kinds = {"part": pa.int32(), "shard": pa.int32(), "doc_ids": pa.binary(), "file": pa.binary()}
        return pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in row.items()})

    for part, ids, t, n in _encoded(_runs(batches, shard_tokens), encoder(vocabulary)):  # characters, so a few tokens in ten of a shard
        tokens.append(t)
        lengths.append(n)
        named.append(ids)
        held += len(t)
        if held >= shard_tokens:
            yield file(part)
    if held:
        yield file(part)


def write(docs: DataFrame, path: str, vocabulary: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """The token files of ``docs`` (doc_id, text), in ascending doc_id order, as a table at ``path``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]  # so that rows of one id, or without one, can be cut into ranges too
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    dealt.mapInArrow(lambda batches: _shards(batches, vocabulary, shard_tokens), FILES).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.schema(FILES).parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # a row for each range
    bases, total = {}, 0
    for r in sizes:
        bases[r.part], total = total, total + r.n

    def documents(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "start_in_part", "doc_ids", "without_id", "file")]
            for part, start, doc_ids, without, data in zip(*columns):
                m = WaveletMatrix.from_bytes(data)
                tokens = m.tokens().astype("<u4")
                ends = np.cumsum(m.doc_lengths, dtype=np.int64)
                starts = ends - m.doc_lengths
                sums = [crc32(tokens[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                ids = np.frombuffer(doc_ids, "<i8")
                missing = np.arange(len(ids)) < without  # rows without an id come first
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64(), mask=missing), "start": pa.array(starts + start + bases[part], pa.int64()),
                    "n_tokens": pa.array(m.doc_lengths.astype(np.int64)), "ids_crc32": pa.array(sums, pa.int64())})

    return files.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, written as wavelet files and read back (contract of op8)."""
    import public_tokenizers

    path = run_folder(spark, "tokens")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path)
