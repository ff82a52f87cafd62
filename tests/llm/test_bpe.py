"""Operator 5: ids and round trip against the tiktoken library."""

import random

import public_tokenizers
import pytest
import tiktoken

from ledgerlens.llm import bpe

SCHEMA = "doc_id long, text string, words string, codes int"
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(VOCABULARY)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
rng = random.Random(5)
LETTERS = "abcdefghinorstu éüñçß漢字😀Жд7'.!\n\t "


def random_text(n):
    return "".join(rng.choices(LETTERS, k=rng.randrange(n)))


def test_long_words_by_heap():
    for n in (600, 3000):
        for alphabet in ("a", "ab", "theinrgaonds", "é漢a"):
            word = "".join(rng.choices(alphabet, k=n))
            assert bpe.merge_long(word.encode(), RANKS) == LIBRARY._core_bpe.encode_single_piece(word.encode()), alphabet


@pytest.mark.parametrize("block_chars", [500, 10**9])
def test_against_the_library(spark, block_chars):
    texts = [None, "", " ", "\n\n", "don't stop  we'll  ", "aaaaaaaaaaaaaaaaaaaaaaaa", "thethethethe", "\x00\x7f  x", "<|endoftext|>", "x" * 700 + " " + "ab" * 400]
    texts += [random_text(80) for _ in range(300)] + ["".join(rng.choices("aeinrst", k=rng.randrange(2, 30))) for _ in range(300)] + ["word and more, " * 9_000]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "null id", "", 2), (7, texts[7], "", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = bpe.encoded(bpe.gathered(docs, RANKS, public_tokenizers.PATTERN, block_chars), bpe.RankMap(RANKS), lambda d: d).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "null id" if r.doc_id is None else texts[r.doc_id] or ""
        ids = LIBRARY.encode_ordinary(text)
        assert r.ids == ",".join(map(str, ids)) and r.n_tokens == len(ids), repr(text[:80])
        assert bytes(r.decoded) == text.encode()


def test_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], SCHEMA), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_recurring_words_are_folded_once(spark):
    """The vocabulary's words come with the library's ids; blocks fold the others only, and ids are the same."""
    common = ["".join(rng.choices("aeinrstéü", k=rng.randrange(3, 12))) for _ in range(40)]
    texts = [" ".join(rng.choices(common, k=30)) + f" alone{k}x. " + random_text(20) for k in range(60)] + [None, "", "x" * 600]
    docs = spark.createDataFrame([(i, t, "", 1) for i, t in enumerate(texts)], SCHEMA)
    ranks = bpe.RankMap(RANKS)
    known = bpe.vocabulary(docs, ranks, public_tokenizers.PATTERN, group_rows=5)
    held = {r["word"].decode(): r for r in known.to_pylist()}
    assert sum(f" {w}" in held for w in common) > 35 and not any("x" * 600 in w for w in held)
    for word, r in held.items():
        ids = LIBRARY.encode_ordinary(word)
        assert r["ids"] == ",".join(map(str, ids)) and r["n"] == len(ids) and r["bytes"] == word
    blocks = bpe.gathered(docs, RANKS, public_tokenizers.PATTERN, 2_000, known).cache()
    assert not any(bytes(w).decode() in held for b in blocks.collect() for w in b.words)
    got = bpe.encoded(blocks, ranks, lambda d: d).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    for r in got:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == ",".join(map(str, ids)) and bytes(r.decoded) == (texts[r.doc_id] or "").encode()


def test_the_vocabulary_is_bounded(spark):
    texts = [" ".join(f"{a}{a}{b}" for b in "abcdefgh") for a in "stuv" for _ in range(3)] + ["often"] * 5
    docs = spark.createDataFrame([(i, t, "", 1) for i, t in enumerate(texts)], SCHEMA)
    assert [r["word"] for r in bpe.vocabulary(docs, bpe.RankMap(RANKS), public_tokenizers.PATTERN, group_rows=1, most=5).to_pylist()] == [b"often"]


def test_plain_words_as_the_pattern_splits_them():
    import regex

    parts = ["a", "é", "Ж漢", "1", "²", "Ⅷ", "_", "'", "'s", "!", "...", "\n", "\x1f", "e\u0301", "ª", "½", "😀", "%%%", "`", "~"]
    chunks = [lead + "".join(rng.choices(parts, k=rng.randrange(1, 5))) for _ in range(5_000) for lead in ("", " ")]
    assert bpe.split_chunks(chunks, public_tokenizers.PATTERN) == [regex.findall(public_tokenizers.PATTERN, c) for c in chunks]


def test_an_empty_place_of_the_first_table_needs_no_second_look():
    """r03: a pair is in the second table only if its place in the first is taken."""
    entries = {rng.randrange(1 << 34): k for k in range(5000)}
    sizes = (2 * len(entries) + 1, 2 * len(entries) + 3)
    first, second = bpe.cuckoo(entries, sizes)
    assert sum(e >= 0 for e in second) > 500
    for e in second:
        assert e < 0 or first[(e >> bpe.ID) % sizes[0]] >= 0
    held = {e >> bpe.ID: e & (2**bpe.ID - 1) for e in first + second if e >= 0}
    assert held == entries


def test_a_line_feed_between_words_needs_no_pattern(monkeypatch):
    """r03: a word, marks, a line feed, a word, marks are told without the pattern; all else is split as it says."""
    import regex

    words = ["a", "Zé", "a1", "²", "漢字", "_", "", " x", "'s", "\n", "\x1c"]
    chunks = [f"{s}{a}{m}\n{b}{n}" for s in ("", " ", "  ") for a in words for b in words for m in ("", ".", "_!", "'") for n in ("", "?)", "\n", "'s")]
    assert bpe.split_chunks(chunks, public_tokenizers.PATTERN) == [regex.findall(public_tokenizers.PATTERN, c) for c in chunks]
    compiled = regex.compile

    class Counting:
        def __init__(self, pattern):
            self.findall = lambda text: asked.append(text) or compiled(pattern).findall(text)

    asked = []
    monkeypatch.setattr(regex, "compile", Counting)
    assert bpe.split_chunks([" the.\nFor", "é\nZ!", " don't"], public_tokenizers.PATTERN) == [[" the", ".", "\n", "For"], ["é", "\n", "Z", "!"], [" don", "'t"]]
    assert asked == [" don't"]
