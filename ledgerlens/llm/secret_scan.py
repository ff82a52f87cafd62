"""Secret scans by grammar inference (operator 4).

Base patterns find the three plain kinds of credential.  Their values are the
labelled credentials: a bounded sample per kind (``FIT_VALUES`` distinct values
with the smallest hash) is folded into a prefix tree over character classes, and
states whose outgoing frequencies are statistically compatible (Hoeffding bound)
are merged into a probabilistic deterministic automaton.  A background automaton
is inferred in the same way from unlabelled candidates.  Then every candidate of
every document (a run of 16 or more credential characters with a digit or an inner
capital, outside the base spans) is scored by its mean log-likelihood ratio per
symbol against the background; those above the kind's threshold become spans of
kind ``format``.  The threshold is calibrated on all distinct values of the corpus:
at least the 5th percentile of labelled ones and the 99.5th of unlabelled candidates,
both exact, found by counts in ever narrower bins.

Scans are map-only passes over whole texts; only the bounded samples and the bins'
counts reach the driver.  Null texts count as empty; repeated rows, null ids and extra columns
change nothing; an empty table gives an empty result; a kind with fewer than
``MIN_VALUES`` values gets no automaton (base spans stay).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import DOCUMENT_COLUMNS, land, pieces, run_folder, table

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "format")

RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
DIGIT_OR_INNER_CAPITAL = re.compile(r"[0-9]|.[A-Z]")
FIT_VALUES = 600
MIN_VALUES = 20
ALPHA = 0.05
#: Bins of one pass that looks for the thresholds' percentiles.
BINS = 1_024
REDACTED = "<secret>"


def base_matches(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's rank, end, value), by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Runs that could be credentials and touch no base span."""
    out, starts, reach = [], [b[0] for b in base], []
    for b in base:
        reach.append(max(b[2], reach[-1] if reach else 0))
    for m in RUN.finditer(text):
        if DIGIT_OR_INNER_CAPITAL.search(m[0]):
            k = bisect_right(starts, m.end() - 1)
            if not k or reach[k - 1] <= m.start():
                out.append((m.start(), m.end(), m[0]))
    return out


def _classes() -> dict[str, str]:
    of = {c: "d" for c in "0123456789"}
    of |= {c: "h" for c in "abcdef"} | {c: "l" for c in "ghijklmnopqrstuvwxyz"}
    return of | {c.upper(): {"h": "H", "l": "L"}[k] for c, k in of.items() if c.isalpha()}


SYMBOL = str.maketrans(_classes())


class Automaton:
    """A probabilistic automaton merged from the prefix tree of ``values`` (ALERGIA)."""

    def __init__(self, values: list[str], alpha: float = ALPHA):
        self.count, self.final, self.next = [0], [0], [{}]
        for v in values:
            self._add(v.translate(SYMBOL))
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self.symbols = len({s for n in self.next for s in n}) + 1

    def _add(self, word: str) -> None:
        at = 0
        self.count[0] += 1
        for s in word:
            if s not in self.next[at]:
                self.next[at][s] = len(self.count)
                self.count.append(0)
                self.final.append(0)
                self.next.append({})
            at = self.next[at][s]
            self.count[at] += 1
        self.final[at] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.bound * (n1**-0.5 + n2**-0.5)

    def _compatible(self, a: int, b: int, through: dict[int, dict]) -> bool:
        """Whether a and b, and what can be reached from both, have like frequencies."""
        work, seen = [(a, b)], set()
        while work:
            x, y = pair = work.pop()
            if pair in seen:
                continue
            seen.add(pair)
            nx, ny = self.count[x], self.count[y]
            if self._differ(self.final[x], nx, self.final[y], ny):
                return False
            for s in {**self.next[x], **self.next[y]}:
                cx, cy = self.next[x].get(s), self.next[y].get(s)
                fx, fy = through[x].get(s, 0), through[y].get(s, 0)
                if self._differ(fx, nx, fy, ny):
                    return False
                if cx is not None and cy is not None:
                    work.append((cx, cy))
        return True

    def _merge_states(self) -> None:
        """Red states are final; each blue state (a successor of red) is folded into the first compatible red one or becomes red."""
        self.through = through = [{s: self.count[c] for s, c in n.items()} for n in self.next]
        red, blue = [0], [(0, s) for s in sorted(self.next[0])]
        while blue:
            blue.sort(key=lambda e: (-through[e[0]][e[1]], e))
            parent, s = blue.pop(0)
            b = self.next[parent][s]
            if b in red:
                continue
            for r in red:
                if self._compatible(r, b, through):
                    self.next[parent][s] = r
                    self._fold(r, b)
                    break
            else:
                red.append(b)
            inside = set(red)
            blue = [(r, t) for r in red for t in sorted(self.next[r]) if self.next[r][t] not in inside]

    def _fold(self, r: int, b: int) -> None:
        work = [(r, b)]
        while work:
            x, y = work.pop()
            self.count[x] += self.count[y]
            self.final[x] += self.final[y]
            for s, c in self.next[y].items():
                self.through[x][s] = self.through[x].get(s, 0) + self.through[y][s]
                if s in self.next[x]:
                    work.append((self.next[x][s], c))
                else:
                    self.next[x][s] = c

    def tables(self) -> list[tuple[float, dict[str, tuple[float, int]], float]]:
        """Per state: log-probability to end, per symbol (log-probability, next state), and of an unseen symbol."""
        out = []
        for n, f, nxt, thr in zip(self.count, self.final, self.next, self.through):
            total = n + 0.1 * (self.symbols + 1)
            out.append((math.log((f + 0.1) / total), {s: (math.log((thr[s] + 0.1) / total), c) for s, c in nxt.items()}, math.log(0.1 / total)))
        return out


def compacted(a: Automaton) -> list:
    """The tables of the states that can be reached, numbered from 0."""
    tables, number, order = a.tables(), {0: 0}, [0]
    for x in order:
        for _, c in tables[x][1].values():
            if c not in number:
                number[c] = len(order)
                order.append(c)
    return [(tables[x][0], {s: (p, number[c]) for s, (p, c) in tables[x][1].items()}, tables[x][2]) for x in order]


def mean_log_likelihood(tables: list, value: str) -> float:
    at, total = 0, 0.0
    for s in value.translate(SYMBOL):
        end, nxt, unseen = tables[at]
        p, at = nxt.get(s, (unseen, 0))
        total += p
    return (total + tables[at][0]) / (len(value) + 1)


class FormatModel:
    """Automata per kind with thresholds, and the background's.

    The thresholds are those of the values given, every other one held out; ``calibrate`` takes all of a corpus."""

    def __init__(self, labelled: dict[str, list[str]], background: list[str]):
        self.automata: dict[str, tuple[list, float]] = {}
        fit, check = background[::2], background[1::2]
        self.background = compacted(Automaton(fit or ["-"]))
        for kind, values in sorted(labelled.items()):
            if len(values) < MIN_VALUES:
                continue
            tables = compacted(Automaton(values[::2]))
            own = sorted(self._ratio(tables, v) for v in values[1::2])
            others = sorted(self._ratio(tables, v) for v in check)
            least = own[len(own) // 20]
            self.automata[kind] = (tables, max(least, others[int(len(others) * 0.995)] if others else least))

    def _ratio(self, tables: list, value: str) -> float:
        return mean_log_likelihood(tables, value) - mean_log_likelihood(self.background, value)

    def ratios(self, value: str, kind: str) -> list[tuple[str, float]]:
        """(automaton's kind, ratio) of a value: of a labelled one by its own kind, of a candidate by every kind."""
        kinds = list(self.automata) if kind == "other" else [kind] if kind in self.automata else []
        if not kinds:
            return []
        base = mean_log_likelihood(self.background, value)
        return [(k, mean_log_likelihood(self.automata[k][0], value) - base) for k in kinds]

    def calibrate(self, seen: DataFrame) -> None:
        """Set the thresholds by all rows of ``seen`` (kind, value)."""
        if not self.automata:
            return
        spark = seen.sparkSession
        shared = spark.sparkContext.broadcast(self)

        def scored(batches):
            for batch in batches:
                rows = [(k, kind == "other", r) for kind, v in zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist()) for k, r in shared.value.ratios(v, kind)]
                kinds, other, ratios = map(list, zip(*rows)) if rows else ([], [], [])
                yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.string()), "other": pa.array(other, pa.bool_()), "ratio": pa.array(ratios, pa.float64())})

        found = order_statistics(land(seen.mapInArrow(scored, "kind string, other boolean, ratio double"), run_folder(spark, "secret-ratios")))
        for kind, (tables, _) in self.automata.items():
            least = found[kind, False]
            self.automata[kind] = (tables, max(least, found.get((kind, True), least)))

    def accepts(self, value: str) -> bool:
        if not self.automata:
            return False
        base = mean_log_likelihood(self.background, value)
        return any(mean_log_likelihood(t, value) - base > least for t, least in self.automata.values())

    def spans(self, text: str) -> tuple[list, list]:
        """(base spans, all spans), each (start, rank, end), by start, then kind."""
        base = base_matches(text)
        more = [(a, 3, b) for a, b, v in candidates(text, base) if self.accepts(v)]
        plain = [(a, k, b) for a, k, b, _ in base]
        return plain, sorted(plain + more)


def order_statistics(ratios: DataFrame) -> dict[tuple[str, bool], float]:
    """Per (kind, other) of ``ratios``: the value of rank n/20 (labelled) or 0.995 n (other), counted from 0.

    Each pass counts a range's values in ``BINS`` bins and goes on with the bin that holds the rank."""
    keys = ["kind", "other"]
    summed = [F.min("ratio").alias("low"), F.max("ratio").alias("high"), F.count(F.lit(1)).alias("n")]
    at = {(r.kind, r.other): (r.low, r.high, int(r.n * 0.995) if r.other else r.n // 20) for r in ratios.groupBy(keys).agg(*summed).collect()}
    while wide := {k: v for k, v in at.items() if v[0] < v[1]}:
        low, high = (F.coalesce(*[F.when((F.col("kind") == k) & (F.col("other") == o), F.lit(v[side])) for (k, o), v in wide.items()]) for side in (0, 1))
        inside = ratios.withColumns({"from": low, "to": high}).where("ratio >= from and ratio <= to")
        share = (F.col("ratio") - F.col("from")) / (F.col("to") - F.col("from"))
        binned = inside.groupBy(*keys, F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin")).agg(*summed)
        for r in sorted(binned.collect(), key=lambda r: r.bin):
            _, _, rank = wide[r.kind, r.other]
            if 0 <= rank < r.n:
                at[r.kind, r.other] = (r.low, r.high, rank)
            wide[r.kind, r.other] = (0, 0, rank - r.n)
    return {k: low for k, (low, _, _) in at.items()}


def fit(docs: DataFrame) -> FormatModel:
    """Infer the automata from a bounded sample of all documents' labelled and unlabelled values, the thresholds from all."""

    def values(batches):
        for batch in pieces(batches):
            found = set()
            for text in batch.column("text").to_pylist():
                base = base_matches(text or "")
                found |= {(KINDS[k], v) for _, k, _, v in base}
                found |= {("other", v) for _, _, v in candidates(text or "", base)}
            rows = sorted(found)
            yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in rows], pa.string()), "value": pa.array([v for _, v in rows], pa.string())})

    seen = land(docs.select("text").mapInArrow(values, "kind string, value string").distinct(), run_folder(docs.sparkSession, "secrets"))
    sample = lambda kind, n: [r.value for r in seen.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(n).collect()]
    model = FormatModel({k: sample(k, FIT_VALUES) for k in KINDS[:3]}, sample("other", 4 * FIT_VALUES))
    model.calibrate(seen)
    return model


def joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, model: FormatModel) -> DataFrame:
    """Per row of ``docs``: doc_id, the base and all spans (kind:start:end, code points)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def spans(batches):
        for batch in pieces(batches):
            both = [shared.value.spans(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([joined(b) for b, _ in both], pa.string()), pa.array([joined(a) for _, a in both], pa.string())],
                ["doc_id", "base", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(spans, "doc_id long, base string, spans string")


def cleaned(batches: Iterable[pa.RecordBatch], model: FormatModel) -> Iterator[pa.RecordBatch]:
    """The documents of ``batches`` without their secrets, a few rows at a time."""

    def without(text: str | None) -> str | None:
        spans = model.spans(text or "")[1]
        if not spans:
            return text
        out, at = [], 0
        for a, _, b in spans:
            if a >= at:
                out += [text[at:a], REDACTED]
            at = max(at, b)
        return "".join([*out, text[at:]])

    for batch in pieces(batches):
        before = batch.column("text").to_pylist()
        after = [without(t) for t in before]
        n = [len(b) if b != a else m for a, b, m in zip(before, after, batch.column("n_chars").to_pylist())]
        new = {"text": pa.array(after, pa.string()), "n_chars": pa.array(n, pa.int64())}
        yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in DOCUMENT_COLUMNS], DOCUMENT_COLUMNS)


def redact(docs: DataFrame, model: FormatModel) -> DataFrame:
    """``docs`` (the columns of documents) with every span's text replaced; n_chars follows the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = {"doc_id": "long", "n_chars": "long"}
    typed = docs.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in DOCUMENT_COLUMNS])
    return typed.mapInArrow(lambda batches: cleaned(batches, shared.value), typed.schema)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text (contract of op4)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, fit(docs))
    count = lambda kind: F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def base_sha256(text: str | None) -> str:
    """The digest of a text's base spans (used by tests)."""
    return hashlib.sha256(joined([(a, k, b) for a, k, b, _ in base_matches(text or "")]).encode()).hexdigest()
