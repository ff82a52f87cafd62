"""Whole texts as codes of distinct chunks, for tokenizers that split by
``public_tokenizers.PATTERN``.

A chunk is cut before a space, where no match of the pattern can reach across, so a
text's matches are those of its chunks one after another, and each distinct chunk
needs to be tokenized once.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_INNER = re.compile(r"\s (?:\s|\Z)")
_RUNS = re.compile(r"\s*\S+|\s+")
#: Last bytes (UTF-8) of white space: those of ASCII, which are white space by themselves, and those of longer characters, which may be.
_SPACE, _MAYBE = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[k for k in range(128) if chr(k).isspace()]] = True
_MAYBE[[chr(k).encode()[-1] for k in range(128, 0x11000) if chr(k).isspace()]] = True


def chunks(text: str) -> list[str]:
    """Consecutive pieces of ``text`` that can be tokenized apart; joined they are the text.

    Cut before every space, which is right unless a run of white space would be cut at
    an inner place (a space with white space before it, and white space or the end
    after it); such texts are cut before their runs only."""
    if _INNER.search(text):
        return _RUNS.findall(text)
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + w for w in rest]


class Codes(dict):
    """chunk -> number; an unseen chunk gets the next one and is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        self.new.append(chunk)
        return n


def numbered(known: defaultdict, keys: list, first: int) -> tuple[np.ndarray, list]:
    """The numbers of keys, and those that were unknown: ``known`` counts on from ``first``."""
    numbers = np.fromiter(map(known.__getitem__, keys), np.int32, len(keys))
    met = np.flatnonzero(numbers >= first)
    highest = np.maximum.accumulate(numbers[met])
    return numbers, [keys[k] for k in met[np.diff(highest, prepend=first - 1) > 0].tolist()]


def spaced_words(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray, dict[int, list[str]]]:
    """The distinct words between single spaces, all texts' words as codes of them, where each text's words begin (and
    the last one's end), and the chunks of the few texts that ``chunks`` doesn't cut before every space."""
    lists = pc.split_pattern(texts, " ")
    words = lists.values.dictionary_encode()
    at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    codes, distinct = words.indices.to_numpy(zero_copy_only=False).astype(np.int32), words.dictionary
    # a text has a space after white space only where a word before a space is empty or ends with white space
    ragged = np.asarray(pc.equal(pc.binary_length(distinct), 0)).astype(bool)
    edges = np.frombuffer(distinct.buffers()[1], np.int32, len(distinct) + 1, 4 * distinct.offset)
    long = np.flatnonzero(~ragged)
    if len(long):
        last = np.frombuffer(distinct.buffers()[2], np.uint8)[edges[long + 1] - 1]
        ragged[long] = _SPACE[last]
        for k in long[_MAYBE[last]].tolist():
            ragged[k] = distinct[k].as_py()[-1].isspace()
    other = {}
    for k in np.flatnonzero(np.logical_or.reduceat(ragged[codes], at[:-1])).tolist():
        if _INNER.search(text := texts[k].as_py()):
            other[k] = chunks(text)
    return distinct, codes, at, other


def coded(texts: pa.StringArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct chunks of a batch of texts, all texts' chunks as codes of them, and each text's number of chunks.

    Arrow splits and numbers the words; Python sees distinct words only, and the few
    texts with runs of white space that ``chunks`` cuts in another way."""
    if not len(texts):
        return [], np.zeros(0, np.int32), np.zeros(0, np.int64)
    words, codes, at, ragged = spaced_words(texts)
    distinct = words.to_numpy(zero_copy_only=False).tolist()
    opening, first = np.unique(codes[at[:-1]], return_inverse=True)  # a text's first word has no space before it
    codes[at[:-1]] = len(distinct) + first
    all_chunks = [" " + w for w in distinct] + [distinct[k] for k in opening]
    per_text = np.split(codes, at[1:-1])
    other = Codes()
    for k, its in ragged.items():
        per_text[k] = len(all_chunks) + np.fromiter(map(other.__getitem__, its), np.int32)
    for k in np.flatnonzero(np.fromiter((not distinct[w] for w in opening), bool, len(opening))[first]).tolist():
        if k not in ragged:  # nothing before the first space
            per_text[k] = per_text[k][1:]
    return all_chunks + other.new, np.concatenate([np.zeros(0, np.int32), *per_text]), np.array([len(c) for c in per_text], np.int64)
