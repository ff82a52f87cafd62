"""Toxicity by a convolutional text classifier (operator 2).

A word's embedding is the sum of hashed rows (the word and its prefixes), so unseen
words share what is learnt of their stems.  Filters of several widths slide over the
whole text; each is max-pooled, rectified and fed to a logistic output.  Training takes
every labelled row that is not held out, in shards of about ``SHARD`` rows.  A shard's texts
are split into words and hashed once: what lands in the shared folder is its distinct words'
rows of the table and each text as codes of them.  In each epoch every shard descends from
the broadcast model (plain numpy) over its codes, and Spark averages what the shards changed,
row of the table by row.  Before, Spark counts the documents that each hashed row occurs in;
after, a fifth of the labelled rows calibrates: the score is shifted so that
its best cut (F1) is ``THRESHOLD``, and each language with enough labelled rows gets a
decision threshold of its own.  Both come from histograms of all those rows' scores (bins of
1 / ``BINS`` of a logit).  Scoring is one map-only pass over every whole text with the
broadcast model (a fixed size, about 9 MB).

Defined cases: null and empty texts have no words and get the score of an empty text;
an unknown or null language gets ``THRESHOLD``; without labels of both kinds the model
is constant (the share of toxic labels, smoothed); repeated rows are scored alike; null
ids, an empty table and extra columns change nothing.
"""

from __future__ import annotations

import copy
import re
from array import array
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, pieces, run_folder, table

#: Labelled rows that one task learns from in an epoch, about; the number of tasks follows the rows.
SHARD = 4000
#: Bins of one logit in the histograms of the calibration.
BINS = 1024
#: Changes are summed as whole multiples of 1 / UNIT, so their order is no matter.
UNIT = 1 << 30
THRESHOLD = 0.7
ROWS, DIM = 1 << 17, 16
PREFIXES = (3, 5, 7)
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH = 6, 16
#: Documents of the sample that a hashed row must occur in; others stay empty.
MIN_DOCUMENTS = 6
#: Labelled rows of each kind that a language needs in the calibration part.
CALIBRATE = 20
#: Words of one numpy block, and words whose projections a worker keeps.
BLOCK, CACHE = 200_000, 100_000
#: Words that are pooled at a time, so that their projections stay in a processor's cache.
POOL = 8_192
#: Bytes of the longest word that is hashed among others, a column of bytes at a time.
SHORT = 24
WORD = re.compile(r"\w+")
TAPS = sum(WIDTHS) * FILTERS
PAD = max(WIDTHS) - 1


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def feature_rows(word: str) -> list[int]:
    """Rows of the hashed table for a word: itself and its proper prefixes; 0 is the empty row."""
    n = len(word)
    return [1 + crc32(word.encode()) % (ROWS - 1)] + [1 + crc32(word[:k].encode(), k) % (ROWS - 1) if n > k else 0 for k in PREFIXES]


def _crc_steps() -> np.ndarray:
    """The table of crc32 (polynomial 0xEDB88320): what a byte does to the remainder."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, steps >> 1 ^ np.uint32(0xEDB88320), steps >> 1).astype(np.uint32)
    return steps


_CRC = _crc_steps()


def feature_table(words: list[str]) -> np.ndarray:
    """``feature_rows`` of many words, (words, 1 + prefixes); short ASCII words are hashed together."""
    out = np.zeros((len(words), 1 + len(PREFIXES)), np.int32)
    short = np.fromiter((w.isascii() and len(w) <= SHORT for w in words), bool, len(words))
    for k in np.nonzero(~short)[0]:
        out[k] = feature_rows(words[k])
    at = np.nonzero(short)[0]
    if not len(at):
        return out
    data = np.array([words[k] for k in at], f"S{SHORT}").view(np.uint8).reshape(len(at), SHORT)
    size = (data != 0).sum(axis=1)  # no word holds a zero byte
    columns = np.ascontiguousarray(data[:, : size.max()].T)

    def crc(start: int, last: int) -> np.ndarray:
        c = np.full(len(at), start ^ 0xFFFFFFFF, np.uint32)
        for j, column in enumerate(columns[:last]):
            c = np.where(size > j, _CRC[(c ^ column) & 0xFF] ^ c >> 8, c)
        return (c ^ np.uint32(0xFFFFFFFF)) % np.uint32(ROWS - 1) + 1

    out[at, 0] = crc(0, SHORT)
    for k, prefix in enumerate(PREFIXES, 1):
        out[at, k] = np.where(size > prefix, crc(prefix, prefix), 0)
    return out


def _pooled(acts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.maximum.reduceat(acts, starts, axis=0)


def _pools(p: np.ndarray, docs: list, bias: np.ndarray) -> np.ndarray:
    """Pooled activations of documents, given as codes (rows of the projections p); code 0 stands for no word."""
    out, k, sizes = [], 0, [len(d) + PAD for d in docs]
    while k < len(docs):
        if sizes[k] > BLOCK + 2 * PAD:  # a very long text: blocks that overlap by a window
            out.append(_pools(p, [docs[k][a:a + BLOCK + PAD] for a in range(0, len(docs[k]), BLOCK)], bias).max(axis=0, keepdims=True))
            k += 1
            continue
        first, held = k, 0
        while k < len(docs) and (k == first or held + sizes[k] <= min(POOL, BLOCK)):
            held, k = held + sizes[k], k + 1
        starts = np.cumsum([0] + sizes[first:k])
        flat, pads = np.zeros(held, np.int64), np.zeros(held, bool)
        for s, e, d in zip(starts, starts[1:], docs[first:k]):
            flat[s:e - PAD], pads[e - PAD:e] = d, True
        out.append(_pooled(_activations(p[flat], pads, bias), starts[:-1]))
    return np.concatenate(out)


def _activations(p: np.ndarray, pads: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """(words, filters) of projections p (words, TAPS): each filter's sum over its window; pads can't win."""
    n, at, out = len(p), 0, np.empty((len(p), len(WIDTHS) * FILTERS), np.float32)
    for k, width in enumerate(WIDTHS):
        acc = out[:, k * FILTERS:(k + 1) * FILTERS]
        acc[:] = bias[k * FILTERS:(k + 1) * FILTERS]
        for tap in range(width):
            acc[: n - tap] += p[tap:, at:at + FILTERS]
            at += FILTERS
    out[pads] = -1e9
    return out


class Cnn:
    """Weights: table (ROWS, DIM), taps (DIM, TAPS), bias, out, out_bias; calibration (a, b); thresholds by language."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.table = (rng.standard_normal((ROWS, DIM)) * 0.02).astype(np.float32)
        self.table[0] = 0
        self.taps = (rng.standard_normal((DIM, TAPS)) * 0.3).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = (np.abs(rng.standard_normal(len(WIDTHS) * FILTERS)) * 0.3).astype(np.float32)
        self.out_bias = 0.0
        self.scale = (1.0, 0.0)
        self.thresholds: dict[str, float] = {}

    def score(self, pooled: np.ndarray) -> np.ndarray:
        logit = np.maximum(pooled, 0).astype(np.float64) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logit + self.scale[1], -500, 500)))


class _Codes(dict):
    """word -> number; an unseen word gets the next one."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self) + 1
        self.new.append(word)
        return n


def _numbers(codes: _Codes, found: list[str]) -> np.ndarray:
    """Words as numbers."""
    return np.frombuffer(array("i", map(codes.__getitem__, found)), np.int32)


class Scorer:
    """Scores texts; keeps the projections of the words it has met, ``CACHE`` at most."""

    def __init__(self, model: Cnn):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        # room for the cache and a block: pages take memory as they are written, and nothing is copied to grow
        self.codes, self.p = _Codes(), np.zeros((CACHE + BLOCK + 1, TAPS), np.float32)

    def _learn(self) -> None:
        """Project the words met since the last call; a text of more words than a block makes the array grow."""
        new, self.codes.new = self.codes.new, []
        if new:
            last = len(self.codes) + 1
            if last > len(self.p):
                self.p = np.concatenate([self.p, np.zeros((last - len(self.p) + BLOCK, TAPS), np.float32)])
            self.p[last - len(new):last] = self.model.table[feature_table(new)].sum(axis=1) @ self.model.taps

    def _pool(self, docs: list[np.ndarray]) -> np.ndarray:
        """Pooled activations of a few documents, given as codes."""
        return _pools(self.p, docs, self.model.bias)

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        out, held, size = [], [], 0
        for text in texts:
            found = words(text)
            if size + len(found) > BLOCK and held:
                self._learn()
                out.append(self._pool(held))
                held, size = [], 0
                if len(self.codes) > CACHE:
                    self._forget()
            held.append(_numbers(self.codes, found))
            size += len(found)
        self._learn()
        if held:
            out.append(self._pool(held))
        if len(self.codes) > CACHE:
            self._forget()
        return self.model.score(np.concatenate(out)) if out else np.zeros(0)


def train(texts: list[str | None], toxic: list[int], langs: list[str | None], part: list[float], epochs: int = EPOCHS) -> Cnn:
    """One shard: fit on the rows whose ``part`` (0 to 1) is 0.2 or more, calibrate on the others."""
    model, y, cal = Cnn(), np.array(toxic, np.float64), np.array(part) < 0.2
    n_pos, n = int(y.sum()), len(y)
    if n_pos < 2 or n - n_pos < 2:
        return _constant(n_pos, n)
    if n_pos < 50:  # too few to hold any back: calibrate on the same rows
        fit, cal = np.ones(n, bool), np.ones(n, bool)
    else:
        fit = ~cal
    docs, rows = _coded(texts)
    chosen = np.nonzero(fit)[0]
    n1, n0 = y[fit].sum(), (1 - y[fit]).sum()
    _start_table(model, _occurrences(docs, rows, y, chosen), n0, n1)
    _descend(model, docs, rows, y, chosen, epochs, _Steps(), np.random.default_rng(1), _weight(n0, n1))
    del docs, rows
    logit = _logit(Scorer(model).scores([t for t, c in zip(texts, cal) if c]))
    hist = pd.DataFrame({"lang": [g for g, c in zip(langs, cal) if c], "bin": np.floor(logit * BINS).astype(int), "pos": y[cal].astype(int), "neg": 1 - y[cal].astype(int)})
    _shift(model, hist)
    for lang, mine in hist.dropna(subset=["lang"]).groupby("lang"):
        if (limit := _limit(mine, model.scale[1])) is not None:
            model.thresholds[lang] = limit
    return model


def _constant(n_pos: int, n: int) -> Cnn:
    """The model without labels of both kinds: the share of toxic ones, smoothed."""
    model, share = Cnn(), (n_pos + 1) / (n + 2)
    model.out[:] = 0
    model.out_bias = float(np.log(share / (1 - share)))
    return model


def _coded(texts) -> tuple[list, np.ndarray]:
    """Word codes of each text, and each code's rows of the table."""
    codes = _Codes()
    docs = [_numbers(codes, words(t)) for t in texts]
    return docs, np.concatenate([np.zeros((1, 1 + len(PREFIXES)), np.int32), feature_table(list(codes))])


def _occurrences(docs: list, rows: np.ndarray, y: np.ndarray, fit: np.ndarray) -> np.ndarray:
    """(2, ROWS): clean and toxic documents that each row occurs in."""
    df = np.zeros((2, ROWS))
    for i in fit:
        df[int(y[i]), np.unique(rows[np.unique(docs[i])])] += 1
    return df


def _start_table(model: Cnn, df: np.ndarray, n0: float, n1: float) -> None:
    """Rows met in under MIN_DOCUMENTS fitted documents stay empty; the first dimension starts at the row's (bounded) association with the label."""
    share = (df[0] + df[1]) / (n0 + n1)
    z = (df[1] / max(n1, 1) - df[0] / max(n0, 1)) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / max(n1, 1) + 1 / max(n0, 1)))
    model.table[:, 0] = np.clip(z / 4, -3, 3)
    model.table[df.sum(axis=0) < MIN_DOCUMENTS] = 0
    model.table[0] = 0
    model.taps[0] = np.abs(model.taps[0]) + 0.3


def _weight(n0: float, n1: float) -> np.ndarray:
    return (n0 + n1) / (2 * np.maximum(np.array([n0, n1]), 1))


class _Steps:
    """Adagrad's sums of squares."""

    def __init__(self):
        self.table = np.full((ROWS, 1), 0.1, np.float32)
        self.taps = np.full((DIM, TAPS), 0.1, np.float32)
        self.bias, self.out = (np.full(len(WIDTHS) * FILTERS, 0.1, np.float32) for _ in range(2))
        self.out_bias = 0.1


def _descend(model: Cnn, docs: list, rows: np.ndarray, y: np.ndarray, fit: np.ndarray, epochs: int, steps: _Steps, rng: np.random.Generator, weight: np.ndarray) -> None:
    """Minibatch gradient descent (Adagrad) on the weighted log loss; gradients flow through the winning windows."""
    live = (model.table != 0).any(axis=1)
    table, g_table = model.table, steps.table
    tap_at = np.cumsum([0] + [w * FILTERS for w in WIDTHS])
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH)):
            part = [i for i in part if len(docs[i])]
            if not part:
                continue
            starts = np.cumsum([0] + [len(docs[i]) + PAD for i in part])
            flat, pads = np.zeros(starts[-1], np.int64), np.zeros(starts[-1], bool)
            for s, e, i in zip(starts, starts[1:], part):
                flat[s:e - PAD], pads[e - PAD:e] = docs[i], True
            met, inverse = np.unique(flat, return_inverse=True)
            met_x = table[rows[met]].sum(axis=1)
            acts = _activations((met_x @ model.taps)[inverse], pads, model.bias)
            best = np.array([s + acts[s:e].argmax(axis=0) for s, e in zip(starts, starts[1:])])
            pooled = np.maximum(np.take_along_axis(acts, best, 0), 0)
            target = y[part]
            p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.out_bias, -60, 60)))
            err = ((p - target) * weight[target.astype(int)] / len(part)).astype(np.float32)
            d_act = err[:, None] * model.out[None, :] * (pooled > 0)
            d_out, d_bias, d_ob = pooled.T @ err + 1e-4 * model.out, d_act.sum(axis=0), float(err.sum())
            d_taps, d_x = np.zeros_like(model.taps), np.zeros_like(met_x)
            for k, width in enumerate(WIDTHS):
                f = slice(k * FILTERS, (k + 1) * FILTERS)
                for tap in range(width):
                    cols = slice(tap_at[k] + tap * FILTERS, tap_at[k] + (tap + 1) * FILTERS)
                    at = inverse[np.minimum(best[:, f] + tap, len(flat) - 1)]
                    d_taps[:, cols] += np.einsum("df,dfx->xf", d_act[:, f], met_x[at])
                    np.add.at(d_x, at.ravel(), (d_act[:, f, None] * model.taps[:, cols].T[None]).reshape(-1, DIM))
            touched = np.nonzero(np.abs(d_x).sum(axis=1))[0]
            where = rows[met[touched]]
            d_rows, ids = {}, where.ravel()
            uniq, back = np.unique(ids, return_inverse=True)
            d_rows = np.zeros((len(uniq), DIM), np.float32)
            np.add.at(d_rows, back, np.repeat(d_x[touched], where.shape[1], axis=0))
            d_rows *= live[uniq][:, None]
            g_table[uniq] += (d_rows**2).sum(axis=1, keepdims=True)
            table[uniq] -= 0.2 * d_rows / np.sqrt(g_table[uniq])
            for value, grad, acc in ((model.taps, d_taps, steps.taps), (model.bias, d_bias, steps.bias), (model.out, d_out, steps.out)):
                acc += grad**2
                value -= 0.05 * grad / np.sqrt(acc)
            steps.out_bias += d_ob**2
            model.out_bias -= 0.05 * d_ob / steps.out_bias**0.5


def _best_cut(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[float, float] | None:
    """The gap between two scores (``pos`` toxic and ``neg`` clean rows each) whose cut has the best F1; of equal ones the widest."""
    cuts, at = np.unique(score, return_inverse=True)
    if len(cuts) < 2:
        return None
    pos, neg = np.bincount(at, pos), np.bincount(at, neg)
    caught = pos.sum() - np.cumsum(pos)[:-1]
    taken = caught + neg.sum() - np.cumsum(neg)[:-1]
    f1 = 2 * caught / (taken + pos.sum()) if pos.sum() else np.zeros(len(cuts) - 1)
    best = max(range(len(f1)), key=lambda k: (round(f1[k], 9), cuts[k + 1] - cuts[k]))
    return float(cuts[best]), float(cuts[best + 1])


def _logit(score: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(score, 1e-12) / np.maximum(1 - score, 1e-12))


def _centre(hist: pd.DataFrame) -> np.ndarray:
    return (hist["bin"].to_numpy() + 0.5) / BINS


def _shift(model: Cnn, hist: pd.DataFrame) -> None:
    """Shift the scores so that the best cut of all languages gets the score THRESHOLD."""
    cut = _best_cut(_centre(hist), hist["pos"].to_numpy(), hist["neg"].to_numpy())
    if cut is not None:
        model.scale = (1.0, float(np.log(THRESHOLD / (1 - THRESHOLD)) - sum(cut) / 2))


def _limit(hist: pd.DataFrame, shift: float) -> float | None:
    """A language's threshold of the best F1 (THRESHOLD itself, where the gap holds it); None without enough rows of both kinds."""
    pos, neg = hist["pos"].to_numpy(), hist["neg"].to_numpy()
    if pos.sum() < CALIBRATE or neg.sum() < CALIBRATE:
        return None
    gap = _best_cut(1 / (1 + np.exp(-(_centre(hist) + shift))), pos, neg)
    if gap is None:
        return None
    low, high = gap
    return float(np.clip(np.clip(THRESHOLD, low + 0.1 * (high - low), high - 0.1 * (high - low)), 0.5, 0.9))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: Numbers in a row of what a shard sends: a row of the table and its Adagrad sum.
WIDE = DIM + 1
NUMBERS = [f"v{k}" for k in range(WIDE)]


def _rest(model: Cnn, steps: _Steps) -> np.ndarray:
    """All weights and sums but the table's as (row, WIDE) doubles, padded."""
    rest = np.concatenate([model.taps.ravel(), model.bias, model.out, [model.out_bias], steps.taps.ravel(), steps.bias, steps.out, [steps.out_bias]]).astype(np.float64)
    return np.pad(rest, (0, -len(rest) % WIDE)).reshape(-1, WIDE)


def _flat(model: Cnn, steps: _Steps) -> np.ndarray:
    """All weights and sums as (row, WIDE) doubles: the table's rows, then the others."""
    return np.concatenate([np.hstack([model.table, steps.table]).astype(np.float64), _rest(model, steps)])


class _Changes:
    """What shards changed, summed row by row: whole multiples of 1 / UNIT, and the number of shards."""

    def __init__(self, model: Cnn, steps: _Steps):
        self.model, self.steps = model, steps
        self.rest = _rest(model, steps)
        self.sums = np.zeros((ROWS + len(self.rest), WIDE), np.int64)
        self.shards = np.zeros(len(self.sums), np.int32)

    def add(self, model: Cnn, steps: _Steps) -> None:
        """One shard's model; only rows that differ are widened to doubles."""
        differ = np.flatnonzero((model.table != self.model.table).any(axis=1) | (steps.table != self.steps.table).any(axis=1))
        for at in range(0, len(differ), 1 << 14):
            rows = differ[at:at + (1 << 14)]
            old, new = (np.hstack([m.table[rows], s.table[rows]]).astype(np.float64) for m, s in ((self.model, self.steps), (model, steps)))
            self._add(rows, new - old)
        self._add(np.arange(ROWS, len(self.sums)), _rest(model, steps) - self.rest)

    def _add(self, rows: np.ndarray, change: np.ndarray) -> None:
        change = np.rint(change * UNIT).astype(np.int64)
        self.sums[rows] += change
        self.shards[rows] += change.any(axis=1)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The rows that any shard changed."""
        some = np.flatnonzero(self.shards)
        for at in range(0, len(some), 1 << 14):
            rows = some[at:at + (1 << 14)]
            yield pa.RecordBatch.from_pydict({"row": rows.astype(np.int32), "shards": self.shards[rows]} | {v: self.sums[rows, k] for k, v in enumerate(NUMBERS)})


def _unflat(flat: np.ndarray, model: Cnn, steps: _Steps) -> None:
    model.table[:], steps.table[:] = flat[:ROWS, :DIM], flat[:ROWS, DIM:]
    rest, at = flat[ROWS:].ravel(), 0
    for owner in (model, steps):
        for name in ("taps", "bias", "out"):
            value = getattr(owner, name)
            value[:] = rest[at:at + value.size].reshape(value.shape)
            at += value.size
        owner.out_bias = float(rest[at])
        at += 1


#: A shard as it lands: its learnt rows first, then the rows kept for the calibration; arrays of numbers as bytes.
CODED = ("shard int, learnt int, lengths binary, codes binary, table_rows binary, toxic array<int>, lang array<string>, "
         "met array<int>, met_clean array<int>, met_toxic array<int>")


def _coded_shard(held: pd.DataFrame) -> pd.DataFrame:
    """A shard's rows, hashed, in one order whatever way they came."""
    held = held.sort_values(["fits", "doc_id", "text", "toxic"], ascending=[False, True, True, True], kind="stable", na_position="first")
    docs, rows = _coded(held["text"])
    learnt = int(held["fits"].sum())
    df = _occurrences(docs, rows, held["toxic"].to_numpy(np.float64), np.arange(learnt))
    met = np.nonzero(df.any(axis=0))[0]
    return pd.DataFrame({
        "shard": [held["shard"].iloc[0]], "learnt": [learnt], "lengths": [np.array([len(d) for d in docs], np.int64).tobytes()],
        "codes": [np.concatenate(docs).tobytes()], "table_rows": [rows.tobytes()], "toxic": [held["toxic"].to_numpy(np.int32)],
        "lang": [[None if pd.isna(g) else g for g in held["lang"]]], "met": [met.astype(np.int32)],
        "met_clean": [df[0, met].astype(np.int32)], "met_toxic": [df[1, met].astype(np.int32)]})


def _shards(batches) -> Iterator[tuple[dict, list, np.ndarray]]:
    """Landed shards: the small columns, each text's codes, each code's rows of the table."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k] for c in batch.schema.names}
            codes, lengths, rows = (np.frombuffer(row.pop(c).as_buffer(), kind) for c, kind in (("codes", np.int32), ("lengths", np.int64), ("table_rows", np.int32)))
            yield {c: v.as_py() for c, v in row.items()}, np.split(codes, np.cumsum(lengths)[:-1]), rows.reshape(-1, 1 + len(PREFIXES))


def fit(docs: DataFrame, labels: DataFrame, epochs: int = EPOCHS) -> Cnn:
    """Train on every labelled row that is not held out."""
    spark, at = docs.sparkSession, run_folder(docs.sparkSession, "toxicity")
    known = land(labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["doc_id"]), f"{at}/labels")
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(1000)) / 1000
    # both joins by sort and merge at every size: labels grow with the documents
    sizes = docs.where(~held_out(F.col("doc_id"))).select("doc_id").join(known.hint("merge"), "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("pos"),
        *[F.count_if((F.col("toxic") == kind) & which).alias(f"{name}{kind}") for kind in (0, 1) for name, which in (("all", F.lit(True)), ("part", part >= 0.2))])
    row = sizes.first()
    if row.pos < 2 or row.n - row.pos < 2:
        return _constant(int(row.pos), row.n)
    # too few toxic rows to hold any back: calibrate on the same rows
    few = row.pos < 50
    n0, n1 = (row.all0, row.all1) if few else (row.part0, row.part1)
    shards = -(-row.n // SHARD)
    shard = F.pmod(F.xxhash64("doc_id", "text", F.lit("shard")), F.lit(shards)).cast("int").alias("shard")
    rows = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang").join(known.hint("merge"), "doc_id").select("doc_id", "text", "lang", "toxic", (F.lit(few) | (part >= 0.2)).alias("fits"), shard)
    coded = land(rows.repartition(shards, "shard").groupBy("shard").applyInPandas(_coded_shard, CODED), f"{at}/coded")
    counted = coded.select(F.inline(F.arrays_zip("met", "met_clean", "met_toxic"))).groupBy("met").agg(F.sum("met_clean").alias("clean"), F.sum("met_toxic").alias("toxic")).toArrow()  # at most ROWS rows
    df = np.zeros((2, ROWS))
    df[:, counted["met"].to_numpy()] = counted["clean"].to_numpy(), counted["toxic"].to_numpy()
    model, steps, weight = Cnn(), _Steps(), _weight(n0, n1)
    _start_table(model, df, n0, n1)
    for epoch in range(epochs):
        shared = spark.sparkContext.broadcast((model, steps))

        def descend(batches):
            """One epoch over each shard; what a task's shards changed, each row once.  Used in this round alone, so it binds the loop's names."""
            changes = None
            for held, docs, rows in _shards(batches):
                if not held["learnt"]:
                    continue
                mine, own = copy.deepcopy(shared.value)
                rng = np.random.default_rng([1, epoch, held["shard"]])
                _descend(mine, docs, rows, np.array(held["toxic"], np.float64), np.arange(held["learnt"]), 1, own, rng, weight)
                changes = changes or _Changes(*shared.value)
                changes.add(mine, own)
            if changes:
                yield from changes.batches()

        changes = coded.select("shard", "learnt", "lengths", "codes", "table_rows", "toxic").mapInArrow(descend, "row int, shards int, " + ", ".join(f"{v} long" for v in NUMBERS))
        mean = changes.groupBy("row").agg(F.sum("shards").alias("n"), *[F.sum(v).alias(v) for v in NUMBERS]).toArrow()  # the model's size at most
        flat, where = _flat(model, steps), mean["row"].to_numpy()
        flat[where] += np.stack([mean[v].to_numpy() for v in NUMBERS], axis=1) / UNIT / mean["n"].to_numpy()[:, None]
        _unflat(flat, model, steps)
        shared.unpersist()
    shared = spark.sparkContext.broadcast(model)

    def binned(batches):
        model = shared.value
        for held, docs, rows in _shards(batches):
            first = 0 if few else held["learnt"]
            if first < len(docs):
                p = model.table[rows].sum(axis=1) @ model.taps
                logit = _logit(model.score(_pools(p, docs[first:], model.bias)))
                yield pa.RecordBatch.from_arrays([pa.array(held["lang"][first:], pa.string()), pa.array(np.floor(logit * BINS).astype(np.int32)), pa.array(held["toxic"][first:], pa.int32())], ["lang", "bin", "toxic"])

    bins = coded.select("learnt", "lengths", "codes", "table_rows", "toxic", "lang").mapInArrow(binned, "lang string, bin int, toxic int")
    counts = F.count_if(F.col("toxic") == 1).alias("pos"), F.count_if(F.col("toxic") == 0).alias("neg")
    hist = land(bins.groupBy("lang", "bin").agg(*counts), f"{at}/histogram")
    everything = hist.groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).orderBy("bin")
    _shift(model, everything.toArrow().to_pandas())  # at most some 57,000 bins
    shift = model.scale[1]

    def limits(mine: pd.DataFrame) -> pd.DataFrame:
        limit = _limit(mine, shift)
        return pd.DataFrame([(str(mine["lang"].iloc[0]), limit)] if limit is not None else [], columns=["lang", "limit"])

    found = hist.where("lang IS NOT NULL").groupBy("lang").applyInPandas(limits, "lang string, limit double").collect()  # one row a language
    model.thresholds = {r.lang: r.limit for r in found}
    return model


def scored(docs: DataFrame, model: Cnn) -> DataFrame:
    """``docs`` with __score and __toxic (the language's threshold) added; whole texts, one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def rows(batches):
        scorer = Scorer(shared.value)
        limits = shared.value.thresholds
        for batch in batches:
            s = scorer.scores(text for piece in pieces([batch]) for text in piece.column("text").to_pylist())
            toxic = [bool(x >= limits.get(g, THRESHOLD)) for x, g in zip(s, batch.column("lang").to_pylist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(s, pa.float64()), pa.array(toxic, pa.bool_())], [*names, "__score", "__toxic"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(rows, f"{kinds}, __score double, __toxic boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, all their columns."""
    return scored(docs, fit(docs, labels)).where("NOT __toxic").select(docs.columns)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text (contract of op2); rejected: by the language's own threshold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"), F.col("__toxic").alias("rejected"))
