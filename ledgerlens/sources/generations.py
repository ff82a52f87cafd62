"""Ledger tables in generations: six tables, one commit (s2, s3, i9, i10).

A *store* is a folder.  The data of a table lies in parts, each a folder of Parquet files
with rows of one range of the table's layout key; a part is never changed.  A *manifest*
names the parts of every table of one generation, with their row counts and key ranges.
Readers resolve the newest whole manifest; a writer adds new part folders and then one new
manifest file, so either all its tables are visible or none.  Nothing is renamed, so a store
whose rename is a copy does as well.

* A manifest ends with a digest of itself.  One that a stopped writer left half written is
  not whole, and readers pass over it.
* A manifest file is created only if there is none of its number, so of two writers that
  started from one generation, one fails (:class:`CommitConflict`) and can start anew.
* Old generations stay readable until ``release``.

Parts follow the layout key (a parent's key, then the own key), so the rows of one account
lie in neighbouring parts and a lookup by key opens only parts whose range holds it, while an
account with a large share of the rows spans several parts.  Part sizes follow the session's
advisory partition size, so their number, and with it the manifest, grows with bytes, not rows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import file_system
from ledgerlens.sources.schemas import LOAD_ORDER, SCHEMAS, conform

#: The columns that a table's parts are ranges of.
LAYOUT = {
    "customers": ["customer_id"],
    "accounts": ["customer_id", "account_id"],
    "merchants": ["merchant_id"],
    "transactions": ["account_id", "transaction_id"],
    "settlements": ["transaction_id", "settlement_id"],
    "fraud_flags": ["transaction_id", "flag_id"],
}
MANIFESTS = "_manifests"


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read its base generation."""


@dataclass(frozen=True)
class Part:
    path: str  # below the store
    rows: int
    lo: int | None  # smallest and largest value of the first layout column
    hi: int | None


@dataclass(frozen=True)
class Generation:
    number: int
    tables: dict[str, tuple[Part, ...]]


EMPTY = Generation(0, {})


def _nothing(step: str) -> None:
    """Called after each step of a load or a delete; tests stop the work in it."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- manifests ---------------------------------------------------------------

    def _numbers(self) -> list[int]:
        fs, folder = file_system(self.spark, f"{self.root}/{MANIFESTS}")
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, number: int) -> str:
        return f"{self.root}/{MANIFESTS}/{number:012d}.json"

    def generation(self, number: int) -> Generation | None:
        """A generation; None if its manifest is missing or not whole."""
        fs, at = file_system(self.spark, self._manifest(number))
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        body, _, digest = text.rpartition("\n")
        if hashlib.sha256(body.encode()).hexdigest() != digest:
            return None
        tables = json.loads(body)["tables"]
        return Generation(number, {t: tuple(Part(*p) for p in parts) for t, parts in tables.items()})

    def current(self) -> Generation:
        """The newest whole generation; ``EMPTY`` in a new store."""
        for number in reversed(self._numbers()):
            if found := self.generation(number):
                return found
        return EMPTY

    def commit(self, base: Generation, changed: dict[str, list[Part]]) -> Generation:
        """``base`` with ``changed`` tables as the next generation, in one step."""
        number = base.number + 1
        while number in self._numbers():
            if self.generation(number):
                raise CommitConflict(f"generation {number} of {self.root} was committed by another writer")
            number += 1  # left half written by a stopped writer
        new = Generation(number, base.tables | {t: tuple(parts) for t, parts in changed.items()})
        body = json.dumps({"base": base.number, "tables": {t: [[p.path, p.rows, p.lo, p.hi] for p in parts] for t, parts in new.tables.items()}})
        self._write(number, body + "\n" + hashlib.sha256(body.encode()).hexdigest())
        if self.current().number != number:
            raise CommitConflict(f"a writer that started from generation {base.number} of {self.root} was faster")
        return new

    def _write(self, number: int, text: str) -> None:
        fs, at = file_system(self.spark, self._manifest(number))
        try:
            out = fs.create(at, False)  # fails if there is one
        except Exception as error:
            if fs.exists(at):
                raise CommitConflict(f"generation {number} of {self.root} is being written by another writer") from error
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    # ---- data ----------------------------------------------------------------------

    def stage(self, table: str, rows: DataFrame, parts: int | None = None) -> list[Part]:
        """Write ``rows`` as new parts of ``table``; no reader sees them before a commit."""
        keys = LAYOUT[table]
        folder = f"{table}/generation={uuid.uuid4().hex[:12]}"
        ranged = conform(rows, table).repartitionByRange(*([parts] if parts else []), *keys).withColumn("part", F.spark_partition_id())
        # the part comes first, so the writer's own order by it asks for no second sort
        ranged.sortWithinPartitions("part", *keys).write.partitionBy("part").parquet(f"{self.root}/{folder}")
        return self._parts(table, folder)

    def _parts(self, table: str, folder: str) -> list[Part]:
        fs, at = file_system(self.spark, f"{self.root}/{folder}")
        if not any(f.isDirectory() for f in fs.listStatus(at)):
            return []
        key = LAYOUT[table][0]
        written = self.spark.read.schema(f"{key} long, part int").parquet(f"{self.root}/{folder}")
        stats = written.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()  # one row per part
        return [Part(f"{folder}/part={r.part}", r.n, r.lo, r.hi) for r in sorted(stats, key=lambda r: r.part)]

    def read_parts(self, table: str, parts) -> DataFrame:
        paths = [f"{self.root}/{p.path}" for p in parts]
        reader = self.spark.read.schema(SCHEMAS[table])
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMAS[table])

    def read(self, table: str, at: Generation | None = None) -> DataFrame:
        """A table of the current generation (or of ``at``); the frame keeps reading that generation."""
        return self.read_parts(table, (at or self.current()).tables.get(table, ()))

    def tables(self, at: Generation | None = None) -> dict[str, DataFrame]:
        at = at or self.current()
        return {t: self.read(t, at) for t in LOAD_ORDER if t in at.tables}

    def lookup(self, table: str, value: int, at: Generation | None = None) -> DataFrame:
        """Rows whose first layout column is ``value``: only parts whose range holds it are opened."""
        parts = [p for p in (at or self.current()).tables.get(table, ()) if p.lo is not None and p.lo <= value <= p.hi]
        return self.read_parts(table, parts).where(F.col(LAYOUT[table][0]) == value)

    def replace(self, tables: dict[str, DataFrame], *, parts: int | None = None, check: Callable[[dict[str, DataFrame]], None] | None = None,
                on_step: Callable[[str], None] = _nothing) -> Generation:
        """Write ``tables`` whole, ``check`` them as written, and commit them together.

        If anything fails before the commit, the new parts go and the store is as it was."""
        base, staged = self.current(), {}
        try:
            for name, df in tables.items():
                staged[name] = self.stage(name, df, parts)
                on_step(f"staged {name}")
            if check:
                check({name: self.read_parts(name, p) for name, p in staged.items()})
                on_step("checked")
            new = self.commit(base, staged)
        except Exception:
            self.discard(staged)
            raise
        on_step("committed")
        return new

    def discard(self, staged: dict[str, list[Part]]) -> None:
        """Delete the folders of parts that were not committed."""
        for folder in {p.path.rpartition("/")[0] for parts in staged.values() for p in parts}:
            fs, at = file_system(self.spark, f"{self.root}/{folder}")
            fs.delete(at, True)

    def release(self, keep: int = 1) -> list[int]:
        """Delete all but the newest ``keep`` generations: their manifests, and the parts no kept one names.

        Also clears what stopped writers left, so no writer may be at work.  Returns the released numbers."""
        numbers = self._numbers()
        whole = [n for n in numbers if self.generation(n)]
        kept = set(whole[-max(1, keep):])
        used = {p.path for n in kept for parts in self.generation(n).tables.values() for p in parts}
        for n in numbers:
            if n not in kept:
                fs, at = file_system(self.spark, self._manifest(n))
                fs.delete(at, False)
        for table in LOAD_ORDER:
            fs, folder = file_system(self.spark, f"{self.root}/{table}")
            for gen in fs.listStatus(folder) if fs.exists(folder) else []:
                path = f"{table}/{gen.getPath().getName()}"
                held = {p for p in used if p.startswith(f"{path}/")}
                if not held:
                    fs.delete(gen.getPath(), True)
                    continue
                for part in fs.listStatus(gen.getPath()):
                    if part.isDirectory() and f"{path}/{part.getPath().getName()}" not in held:
                        fs.delete(part.getPath(), True)
        return [n for n in numbers if n not in kept]

