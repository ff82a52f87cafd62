"""Byte-level BPE encoding and decoding with higher-order functions (operator 5).

The words that recur in a sample of the rows are encoded first, once for the corpus, and
kept at hand in a table of bounded size (``VOCABULARY``); it saves time only, every word has the same
ids with or without it.  Documents are gathered into blocks of bounded size (one row: the block's
distinct words, as the pattern splits them, those of the table with their ids, and each document as
codes of them); documents are not shuffled.  In a block, every other distinct word is encoded once.

A word is encoded by folding ranked merges over its byte array: the pair of the lowest rank (the leftmost of equal ones) becomes one
part, and only the two pairs beside it are ranked anew, until no pair has a rank.  Ranks
come from a literal map from pairs of parts, kept in buckets so that a look-up reads a
few keys.  Ids, their text and their decoded bytes are made once per distinct word; a
document joins those of its codes.  Decoding looks up each id's bytes in a literal array
and concatenates the binary pieces.

A part of a word under way is one number: the rank of the pair it begins, its first
byte's place, its id.  The smallest number is thus the pair to merge next.

The fold of a word costs the square of its length, so words over ``LONG`` bytes are
merged in the gathering pass with a heap (the same merges in the same order).

Defined cases: null and empty texts have no ids and decode to no bytes; repeated rows,
null ids and extra columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.chunks import coded
from ledgerlens.llm.common import land, pieces, run_folder, table, text_of

#: Characters of a block's texts, about.
BLOCK_CHARS = 7_000_000
#: Rows, about, whose words may enter the vocabulary; rows that count a word once; its words at most.
SAMPLE_ROWS, GROUP_ROWS, VOCABULARY = 45_000, 1_000, 800_000
LONG = 512
BUCKETS = 16_381
#: Bits of an id, of a place in a word, and what stands for "no rank" and for a word's edges.
ID, PLACE = 17, 10
NO_RANK, EDGE = 2**ID - 1, 2**ID - 2
BLOCK = ("doc_ids array<bigint>, starts array<int>, lengths array<int>, codes array<int>, words array<binary>, "
         "given array<struct<n: int, ids: string, bytes: string>>, long_words array<binary>, long_ids array<array<int>>")
#: Marks of ASCII without the apostrophe: after letters, up to the chunk's end, they are one match of the pattern.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once (a fold over nothing, so no array is made)."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, body)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long word: a heap of (rank, place) over linked parts, each merge in logarithmic time."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # end of the part at a place; start of the one before
    alive, heap = [True] * n, []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (r := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue  # one of the two parts has changed since
        alive[j], end[i] = False, stop
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


#: A word, marks, one line feed, a word, marks: each a match of the pattern, if the words are letters.
_TWO_LINES = re.compile(r"( ?[^\W\d_]+)([%s]*)(\n)([^\W\d_]+)([%s]*)" % (re.escape(MARKS), re.escape(MARKS)))


def split_chunks(chunks: list[str], pattern: str) -> list[list[str]]:
    """The matches of the pattern in each chunk; plain words are told without it."""
    import regex

    split, lines, out = regex.compile(pattern).findall, _TWO_LINES.fullmatch, []
    for chunk in chunks:
        word = chunk.rstrip(MARKS)
        if (word[1:] if word[:1] == " " else word).isalpha():
            out.append([chunk] if len(word) == len(chunk) else [word, chunk[len(word):]])
        elif (m := lines(chunk)) and m[1].lstrip(" ").isalpha() and m[4].isalpha():
            out.append([p for p in m.groups() if p])
        else:
            out.append(split(chunk))
    return out


def used_chunks(texts: pa.StringArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The chunks that occur in the texts, all texts' chunks as codes of them, and each text's number of chunks."""
    chunks, codes, counts = coded(texts)
    used = np.bincount(codes, minlength=len(chunks)) > 0
    return [c for c, u in zip(chunks, used.tolist()) if u], (np.cumsum(used, dtype=np.int32) - 1)[codes], counts


def gathered(docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int = BLOCK_CHARS, known: pa.Table | None = None) -> DataFrame:
    """Rows of schema ``BLOCK`` from (doc_id, text); ``known``: the vocabulary."""
    if known is None:
        known = pa.table({"word": pa.array([], pa.binary()), "n": pa.array([], pa.int32()), "ids": pa.array([], pa.string()), "bytes": pa.array([], pa.string())})
    shared = docs.sparkSession.sparkContext.broadcast((ranks, known.combine_chunks()))

    def blocks(batches):
        ints = pa.list_(pa.int32())
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        def block(ids: list[pa.Array], texts: list[pa.Array]) -> pa.RecordBatch:
            """Chunk codes become word codes; only distinct chunks are split."""
            all_ranks, vocabulary = shared.value
            chunks, used, counts = used_chunks(pa.concat_arrays(texts))
            seen: dict[str, int] = {}
            per_chunk = [[seen.setdefault(w, len(seen)) for w in ws] for ws in split_chunks(chunks, pattern)]
            sizes = np.fromiter(map(len, per_chunk), np.int32, len(chunks))
            flat = np.fromiter((w for ws in per_chunk for w in ws), np.int32, int(sizes.sum()))
            del per_chunk, chunks
            keys = pa.array([w.encode() for w in seen], pa.binary())
            del seen
            at = pc.index_in(keys, value_set=vocabulary["word"])
            fold = np.asarray(pc.is_null(at))
            # words to fold first, then those of the vocabulary
            number = np.where(fold, np.cumsum(fold) - 1, fold.sum() + np.cumsum(~fold) - 1).astype(np.int32)
            flat, words, at = number[flat], keys.filter(pa.array(fold)), at.drop_null()
            given = pa.StructArray.from_arrays([vocabulary[c].take(at).combine_chunks() for c in ("n", "ids", "bytes")], ["n", "ids", "bytes"])
            lengths = sizes[used]
            ends = np.cumsum(lengths, dtype=np.int32)
            codes = np.repeat(np.cumsum(sizes, dtype=np.int32)[used] - ends, lengths)
            codes += np.arange(len(codes), dtype=np.int32)
            codes = flat[codes]
            edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
            long_words = words.filter(pc.greater(pc.binary_length(words), LONG)).to_pylist()
            long_ids = [[all_ranks[w]] if w in all_ranks else merge_long(w, all_ranks) for w in long_words]
            return pa.RecordBatch.from_pydict({
                "doc_ids": one(pa.concat_arrays(ids)), "starts": one(pa.array(edges[:-1])), "lengths": one(pa.array(np.diff(edges))),
                "codes": one(pa.array(codes)), "words": one(words), "given": one(given),
                "long_words": pa.array([long_words], pa.list_(pa.binary())), "long_ids": pa.array([long_ids], pa.list_(ints))})

        ids, texts, size = [], [], 0
        for batch in batches:
            sizes = np.cumsum(np.asarray(pc.utf8_length(batch.column("text"))), dtype=np.int64)
            at, before = 0, 0
            while at < batch.num_rows:
                stop = min(int(np.searchsorted(sizes, before + block_chars - size)) + 1, batch.num_rows)  # the row that fills the block is its last
                ids.append(batch.column("doc_id").slice(at, stop - at))
                texts.append(batch.column("text").slice(at, stop - at))
                size, before, at = size + int(sizes[stop - 1]) - before, int(sizes[stop - 1]), stop
                if size >= block_chars:
                    yield block(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield block(ids, texts)

    return whole(docs).mapInArrow(blocks, BLOCK)


def whole(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))


def cuckoo(entries: dict[int, int], sizes: tuple[int, int]) -> tuple[list[int], list[int]]:
    """Two tables of ``key << ID | rank``; a key is in one or the other at its remainder by the table's size.
    A key is in the second only if its place in the first is taken."""
    tables = [[-1] * sizes[0], [-1] * sizes[1]]
    for key, rank in entries.items():
        entry, side = key << ID | rank, 0
        for _ in range(10_000):
            at = (entry >> ID) % sizes[side]
            tables[side][at], entry = entry, tables[side][at]
            if entry < 0:
                break
            side = 1 - side
        else:
            raise ValueError("the tables are too small for these ranks")
    return tables[0], tables[1]


class RankMap:
    """The literals: the rank map from pairs of parts (two tables of packed keys and ranks), whole words'
    ranks (an array of maps, a key's bucket given by its hash), the ids of single bytes, the ranks of two
    bytes (ready to be parts of a word), the bytes of ids."""

    def __init__(self, ranks: dict[bytes, int], buckets: int = BUCKETS):
        from xxhash import xxh64_intdigest

        self.buckets = buckets
        words: list[dict] = [{} for _ in range(buckets)]
        pairs: dict[int, int] = {}
        for key, rank in ranks.items():
            hashed = xxh64_intdigest(key, 42)
            words[(hashed - (hashed >> 63 << 64)) % buckets][key.hex().upper()] = rank  # Spark's xxhash64, signed
            for k in range(1, len(key)):
                if key[:k] in ranks and key[k:] in ranks:
                    pairs[ranks[key[:k]] << ID | ranks[key[k:]]] = rank
        self.sizes = (2 * len(pairs) + 1, 2 * len(pairs) + 3)
        dump = lambda x: json.dumps(x, separators=(",", ":"))
        self.first, self.second = map(dump, cuckoo(pairs, self.sizes))
        pieces = {i: k.hex().upper() for k, i in ranks.items()}
        self.words, self.bytes = dump(words), dump([ranks[bytes([b])] for b in range(256)])
        self.byte_pairs = dump([ranks.get(bytes([a, b]), NO_RANK) << (ID + PLACE) for a in range(256) for b in range(256)])
        self.pieces = dump([pieces.get(i, "") for i in range(max(pieces) + 1)])

    def literal(self) -> Column:
        read = lambda text, kind: F.from_json(F.lit(text), kind)
        return F.struct(
            F.transform(read(self.words, "array<map<string,int>>"), lambda m: F.transform_keys(m, lambda k, _: F.unhex(k))).alias("words"),
            read(self.first, "array<bigint>").alias("first"), read(self.second, "array<bigint>").alias("second"),
            read(self.bytes, "array<bigint>").alias("bytes"), read(self.byte_pairs, "array<bigint>").alias("byte_pairs"),
            F.transform(read(self.pieces, "array<string>"), lambda h: F.unhex(h).cast("string")).alias("pieces"))

    def word(self, literal: Column, key: Column) -> Column:
        """The rank of a byte string, null if it has none."""
        return F.try_element_at(F.get(literal["words"], F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")), key)

    def pair(self, literal: Column, left: Column, right: Column) -> Column:
        """The rank of two parts side by side, or NO_RANK."""

        none = F.lit(NO_RANK).cast("bigint")

        def found(key: Column) -> Column:
            probe = lambda name, size, other: let(F.get(literal[name], (key % size).cast("int")), lambda e: F.when(
                e < 0, none).when(F.shiftright(e, ID) == key, e.bitwiseAND(F.lit(2**ID - 1))).otherwise(other))
            return probe("first", self.sizes[0], probe("second", self.sizes[1], none))

        return let(F.shiftleft(left, ID).bitwiseOR(right), found)


def fold(word: Column, literal: Column, ranks: RankMap) -> Column:
    """Ids of a word (binary) that is no single token, by ranked merges."""
    n, low_bits = F.octet_length(word), F.lit(2 ** (ID + PLACE) - 1)
    id_of = lambda part: part.bitwiseAND(F.lit(2**ID - 1))
    # one character for each byte, as code points 0 to 255
    byte = lambda chars, i: F.ascii(chars.substr(i, F.lit(1)))
    start = let(F.decode(word, "ISO-8859-1"), lambda chars: F.flatten(F.array(
        F.array(F.lit(NO_RANK << (ID + PLACE) | EDGE)),
        F.transform(F.sequence(F.lit(1), n), lambda i: let(byte(chars, i), lambda b: F.when(
            i < n, F.get(literal["byte_pairs"], b * 256 + byte(chars, i + 1))).otherwise(F.lit(NO_RANK << (ID + PLACE)))
            .bitwiseOR(F.shiftleft(i.cast("bigint"), ID)).bitwiseOR(F.get(literal["bytes"], b)))),
        F.array(F.lit(NO_RANK << (ID + PLACE) | EDGE)))))

    def merged(parts: Column, least: Column) -> Column:
        """The first of the pair's two parts takes the merged id (its rank); the part before it and it itself are ranked anew."""
        new = F.shiftright(least, ID + PLACE)
        at = F.array_position(parts, least).cast("int")
        return let(at, lambda k: F.flatten(F.array(
            F.slice(parts, F.lit(1), k - 2),
            F.array(
                let(F.get(parts, k - 2), lambda p: F.shiftleft(ranks.pair(literal, id_of(p), new), ID + PLACE).bitwiseOR(p.bitwiseAND(low_bits))),
                F.shiftleft(ranks.pair(literal, new, id_of(F.get(parts, k + 1))), ID + PLACE)
                .bitwiseOR(least.bitwiseAND(F.lit(2 ** (ID + PLACE) - 2**ID))).bitwiseOR(new)),
            F.slice(parts, k + 2, n + 2))))

    step = lambda parts, _: let(F.array_min(parts), lambda least: F.when(F.shiftright(least, ID + PLACE) == NO_RANK, parts).otherwise(merged(parts, least)))
    return F.aggregate(F.sequence(F.lit(2), n), start, step, lambda parts: F.transform(F.slice(parts, F.lit(2), F.size(parts) - 2), lambda p: id_of(p).cast("int")))


def described(ids: Column, literal: Column) -> Column:
    """A word's number of ids, their text and the bytes they decode to."""
    return let(ids, lambda i: F.struct(
        F.size(i).alias("n"), F.array_join(i.cast("array<string>"), ",").alias("ids"),
        F.array_join(F.transform(i, lambda t: F.get(literal["pieces"], t)), "").alias("bytes")))


def vocabulary(docs: DataFrame, ranks: RankMap, pattern: str, sample_rows: int = SAMPLE_ROWS, group_rows: int = GROUP_ROWS, most: int = VOCABULARY) -> pa.Table:
    """The words that occur in two groups or more of a sample of rows (or in more, so that there are ``most`` at most),
    folded once: word, n, ids, bytes."""
    spark, rows = docs.sparkSession, docs.count()
    sample = whole(docs if rows <= sample_rows else docs.sample(sample_rows / rows, 5)).select("text")

    def distinct(batches: Iterable[pa.RecordBatch]):
        for batch in pieces(batches, group_rows):
            chunks, _, _ = used_chunks(pa.concat_arrays([batch.column("text")]))
            found = {w for ws in split_chunks(chunks, pattern) for w in ws}
            yield pa.RecordBatch.from_pydict({"word": pa.array([w.encode() for w in found], pa.binary())})

    found = sample.mapInArrow(distinct, "word binary").where(F.octet_length("word") <= LONG)
    counted = land(found.groupBy("word").agg(F.count(F.lit(1)).alias("groups")).where("groups > 1"), run_folder(spark, "vocabulary"))
    least, held = 2, 0
    for r in sorted(counted.groupBy("groups").count().collect(), key=lambda r: -r.groups):  # a row for each number of groups
        held += r["count"]
        if held > most:
            least, held = r.groups + 1, held - r["count"]
            break

    def lists(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            words = batch.column("word")
            yield pa.RecordBatch.from_pydict({"words": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)})

    # few tasks, as each gets the literals
    words = counted.where(F.col("groups") >= least).select("word").repartition(1 + held // 20_000).mapInArrow(lists, "words array<binary>")
    ids = lambda word, literal: let(ranks.word(literal, word), lambda r: F.when(r.isNotNull(), F.array(r)).otherwise(fold(word, literal, ranks)))
    folded = let(ranks.literal(), lambda literal: F.transform("words", lambda w: F.struct(w.alias("word"), described(ids(w, literal), literal).alias("d"))))
    return words.select(F.inline(folded)).select("word", "d.n", "d.ids", "d.bytes").toArrow()  # ``most`` rows at most


def encoded(block: DataFrame, ranks: RankMap, finish: Callable[[Column], Column]) -> DataFrame:
    """Per document ``finish`` of doc_id, n_tokens, ids (text, comma-joined), decoded (binary)."""

    def word_ids(word: Column, literal: Column) -> Column:
        return let(ranks.word(literal, word), lambda r: F.when(r.isNotNull(), F.array(r))
                   .when(F.octet_length(word) > LONG, F.get("long_ids", F.array_position("long_words", word).cast("int") - 1))
                   .otherwise(fold(word, literal, ranks)))

    def document(doc: Column, words: Column) -> Column:
        # each code is looked up once; its fields are taken from all of them without a lambda
        return let(F.transform(F.slice("codes", doc["starts"] + 1, doc["lengths"]), lambda c: F.get(words, c)), lambda its: F.struct(
            doc["doc_ids"].alias("doc_id"),
            F.aggregate(its["n"], F.lit(0).cast("long"), lambda a, n: a + n).alias("n_tokens"),
            F.array_join(its["ids"], ",").alias("ids"),
            F.array_join(its["bytes"], "").cast("binary").alias("decoded")))

    docs = F.arrays_zip("doc_ids", "starts", "lengths")
    every = let(ranks.literal(), lambda literal: let(
        F.concat(F.transform("words", lambda w: described(word_ids(w, literal), literal)), "given"),
        lambda words: F.transform(docs, lambda d: finish(document(d, words)))))
    return block.select(F.inline(every))


def encode(docs: DataFrame, ranks_path: str, pattern: str, finish: Callable[[Column], Column] = lambda d: d) -> DataFrame:
    """Encode and decode whole texts: ``finish`` of struct<doc_id, n_tokens, ids, decoded> per row of ``docs``."""
    ranks = read_ranks(ranks_path)
    literals = RankMap(ranks)
    return encoded(gathered(docs, ranks, pattern, known=vocabulary(docs, literals, pattern)), literals, finish)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the bytes they decode to, as digests (contract of op5)."""
    import public_tokenizers

    digests = lambda d: let(d, lambda x: F.struct(
        x["doc_id"].alias("doc_id"), x["n_tokens"].alias("n_tokens"),
        F.sha2(x["ids"].cast("binary"), 256).alias("ids_sha256"), F.sha2(x["decoded"], 256).alias("decoded_sha256")))
    docs = table(spark, sf_dir, "documents")
    return encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests)
