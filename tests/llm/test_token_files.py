"""Operator 8: chunks, the wavelet matrix, and files against the tokenizers library."""

import itertools
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from ledgerlens.llm import token_files
from ledgerlens.llm.chunks import chunks, coded, numbered
from ledgerlens.llm.wavelet import WaveletMatrix

SCHEMA = "doc_id long, text string, part int, shard string"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
rng = random.Random(21)
ODD = ["", " ", "   ", "a  b", "a   b", "\n x", " \n \n b", "x \n", "a \t  ", "don't  we'll'", "Ünï 12 345", "é  b", "a　 　b ", "<|endoftext|> x", "a <|endoftext|><|endoftext|>b", "<|endoftext|", "!!! 's 's's", "\r\n\r\n  z", "x  ", "x ", "  x"]


def random_text():
    return "".join(rng.choices(["a", "B", " ", " ", "  ", "\n", "\t", "'s", "'", "é", "7", ".", " ", "漢", "😀"], k=rng.randrange(30)))


def test_chunks_split_like_the_pattern():
    for t in ODD + [random_text() for _ in range(3000)]:
        parts = chunks(t)
        assert "".join(parts) == t
        assert [m for p in parts for m in regex.findall(public_tokenizers.PATTERN, p)] == regex.findall(public_tokenizers.PATTERN, t), repr(t)


def test_batches_are_coded_like_single_texts():
    for texts in ([], [""], ODD, [random_text() for _ in range(500)] + ODD):
        distinct, codes, counts = coded(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        assert [[distinct[c] for c in codes[e - n:e]] for e, n in zip(ends, counts)] == [chunks(t) for t in texts]


@pytest.mark.parametrize("n,top", [(0, 5), (1, 1), (700, 3), (3000, 50257), (1500, 100_000)])
def test_wavelet_matrix(n, top):
    ids = np.array([rng.randrange(top) for _ in range(n)], np.uint32)
    lengths = np.array([n // 3, n - n // 3])
    m = WaveletMatrix.from_bytes(WaveletMatrix(ids, lengths).to_bytes())
    assert (m.tokens() == ids).all() and m.doc_lengths.tolist() == lengths.tolist()
    for i in range(0, n, 97):
        assert m.access(i) == ids[i]
        assert m.count(int(ids[i])) == (ids == ids[i]).sum()
        assert m.count(int(ids[i]), i, n) == (ids[i:] == ids[i]).sum()
        where = np.nonzero(ids == ids[i])[0]
        assert [m.occurrence(int(ids[i]), j) for j in range(min(3, len(where)))] == where[:3].tolist()
    assert m.count(top + 70_000) == 0
    assert n == 0 or (m.document(0) == ids[: n // 3]).all()
    with pytest.raises(IndexError):
        m.occurrence(0, n)


def test_files_against_the_library(spark, tmp_path):
    rows = [(i * 3 % 101, t) for i, t in enumerate(ODD + [random_text() * 3 for _ in range(70)])]
    rows += [(None, None), (None, "x y"), (7777, "long word " * 20_000), (12, rows[4][1])]
    path = str(tmp_path / "files")
    token_files.write(spark.createDataFrame([(i, t, 9, "clash") for i, t in rows], SCHEMA).repartition(3), path, VOCABULARY, 40)
    got = token_files.read(spark, path).collect()
    t = Tokenizer.from_file(VOCABULARY)
    want = {}
    for i, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.setdefault(i, []).append((len(ids), crc32(ids.tobytes())))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (r.doc_id if r.doc_id is not None else -1) >= last
        at, last = at + r.n_tokens, r.doc_id if r.doc_id is not None else -1
    assert spark.read.parquet(path).count() > 5


def test_rows_without_an_id_are_cut_into_ranges(spark, tmp_path):
    rows = spark.range(6000).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "concat('text ', id) AS text")
    token_files.write(rows, str(tmp_path / "files"), VOCABULARY, 400)
    parts = {r.part: r.n for r in spark.read.parquet(str(tmp_path / "files")).groupBy("part").agg({"n_docs": "sum"}).toDF("part", "n").collect()}
    assert sum(parts.values()) == 6000 and max(parts.values()) < 2 * 6000 / len(parts)
    got = token_files.read(spark, str(tmp_path / "files")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 2000 + [i for i in range(6000) if i % 3]


def test_empty_table(spark, tmp_path):
    token_files.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), VOCABULARY)
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0


def test_parts_with_a_space_need_no_line_feeds(monkeypatch):
    """r03: parts that begin with a space go to the library as they are, and get the ids that each has by itself."""
    enc, given = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json")), []
    ids = enc._ids
    monkeypatch.setattr(enc, "_ids", lambda text: given.append(text) or ids(text))
    rows = ["It's  the naïve \t zebra-crossing, isn't it? 日本語 12ab34 _x_ 's", "", " ", "the the\nthe \n the", " opening x y   z ", "don't 'quote'  wide", "a" * 300 + " b" * 300]
    flat, lengths = enc.encode(rows)
    want = [[*ids(t), token_files.END_ID] for t in rows]
    assert lengths.tolist() == [len(w) for w in want] and flat.tolist() == sum(want, [])
    assert not any(" the" in t and "\n the" in t for t in given)
    spaced = [" zebra", " naïve", " 日本語", " a1", " ?!", " x_y"]
    got, n = enc._spaced(spaced)
    assert [x.tolist() for x in np.split(got, np.cumsum(n)[:-1])] == [ids(w) for w in spaced]


def test_new_keys_are_numbered_in_one_pass():
    known = defaultdict(itertools.count().__next__)
    for keys, numbers, new in ((["b", "a", "b"], [0, 1, 0], ["b", "a"]), (["a", "c", "b", "c", "d"], [1, 2, 0, 2, 3], ["c", "d"]), (["d"], [3], []), ([], [], [])):
        first = len(known)
        got, learnt = numbered(known, keys, first)
        assert got.tolist() == numbers and learnt == new


def test_runs_are_encoded_together_and_looked_up_once(monkeypatch):
    """r03: words that recur in the next runs of a shard's length are looked up once for several of them, and cost no pass of the pattern."""
    enc, asked, texts = token_files.Encoder(VOCABULARY), [], [f"same words here. {k}" for k in range(12)]
    learn, encode = enc._learn, enc.encode
    monkeypatch.setattr(enc, "_learn", lambda new: asked.extend(new) or learn(new))
    calls = []
    monkeypatch.setattr(enc, "encode", lambda t: calls.append(len(t)) or encode(t))
    monkeypatch.setitem(token_files._ENCODERS, VOCABULARY, enc)
    batch = pa.RecordBatch.from_pydict({"part": pa.array([0] * 12, pa.int32()), "doc_id": pa.array([None, *range(11)], pa.int64()), "text": texts})
    files = pa.Table.from_batches(list(token_files._shards([batch, batch.slice(0, 0)], VOCABULARY, 20))).to_pylist()
    assert calls == [8, 4]  # runs of two texts, four runs at a time
    assert len(asked) == len(set(asked))
    assert [f["n_docs"] for f in files] == [4, 4, 4] and [f["without_id"] for f in files] == [1, 0, 0]
    want = [i for t in texts for i in [*Tokenizer.from_file(VOCABULARY).encode(t, add_special_tokens=False).ids, 0]]
    assert sum((WaveletMatrix.from_bytes(f["file"]).tokens().tolist() for f in files), []) == want


def test_line_feeds_between_marks_and_words_are_cut_without_the_pattern():
    enc = token_files.Encoder(VOCABULARY)
    for text in ["x the.\nFor it", "a.\n\nFor", "a1!?\nB2, c", "a.\n'tis", "é.\nÉ漢.", "a.\n b", "a_\nb_", "a.\r\nb", "a.\x1cb", "a.\n", "It\n's a.\nb's"]:
        flat, n = enc.encode([text])
        assert flat.tolist() == [*enc._ids(text), 0] and n.tolist() == [len(flat)]
