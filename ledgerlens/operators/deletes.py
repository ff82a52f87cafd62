"""Deletes that are written: ON DELETE CASCADE and SET NULL on a store (i9, i10).

``delete`` follows the declared foreign keys from one table's doomed keys down.  For each
table it finds the parts that hold a row to be changed (a scan of the linking column alone,
of parts whose key range can hold one), rewrites only those, and commits all tables of the
delete as one generation.  Parts that hold no such row are neither read for the rewrite nor
written; the new manifest names them as they are.

Doomed keys are a table in the shared folder, one per level.  At most ``BROADCAST_KEYS`` of
them are sent whole to every task, once each, and no row is moved to meet them.  With more, a
row meets them in a merge join by (key, salt), the salt taken from its own primary key, so the
rows of an account that holds a third of the ledger are spread over ``SALTS`` tasks.  The keys
times ``SALTS`` are never broadcast, whatever size the planner takes them for: it sees the file
they are read from, not the copies.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import file_system
from ledgerlens.sources.generations import LAYOUT, Generation, Part, Store, _nothing
from ledgerlens.sources.schemas import FOREIGN_KEYS, LOAD_ORDER, PRIMARY_KEYS

SALTS = 16
#: Doomed keys that are broadcast, as longs: some 70 MB in the driver and in an executor at most.
BROADCAST_KEYS = 1_000_000


def _salted(rows: DataFrame, gone: DataFrame, column: str, own: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on (column, _salt); ``gone`` has one column, _key."""
    many = gone.select(F.col("_key").alias(column), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(own), F.lit(SALTS)).cast("int")), many


def is_few(gone: DataFrame) -> bool:
    """Whether ``gone`` is broadcast (one small job)."""
    return gone.count() <= BROADCAST_KEYS


def _sides(rows: DataFrame, gone: DataFrame, column: str, own: str, few: bool | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join with ``gone``, which has one column, _key, and the columns it is on; ``few`` as ``is_few`` says, where it is known."""
    if is_few(gone) if few is None else few:
        return rows, F.broadcast(gone.withColumnRenamed("_key", column)), [column]
    left, right = _salted(rows, gone, column, own)
    return left, right.hint("merge"), [column, "_salt"]


def touched_parts(store: Store, base: Generation, table: str, column: str, gone: DataFrame, few: bool | None = None) -> list[Part]:
    """Parts of ``table`` with a row whose ``column`` is among ``gone``.

    Where the keys aren't broadcast, (key, file) pairs are distinct before they meet them, so a hot key is one row a task."""
    parts = base.tables.get(table, ())
    if column == LAYOUT[table][0]:
        lo, hi = gone.agg(F.min("_key"), F.max("_key")).first()
        parts = [p for p in parts if lo is not None and p.lo is not None and p.lo <= hi and p.hi >= lo]
    if not parts:
        return []
    pairs = store.read_parts(table, parts).where(F.col(column).isNotNull()).select(column, F.col("_metadata.file_path").alias("file"))
    keys = gone.withColumnRenamed("_key", column)
    if is_few(gone) if few is None else few:
        hits = pairs.join(F.broadcast(keys), column, "left_semi")
    else:
        hits = pairs.distinct().join(keys.hint("merge"), column, "left_semi")
    folder = F.regexp_extract("file", f"({table}/generation=[^/]+/part=[0-9]+)/[^/]*$", 1)
    found = {r.folder for r in hits.select("file").distinct().select(folder.alias("folder")).collect()}  # at most one row per file
    return [p for p in parts if p.path in found]


def without(rows: DataFrame, gone: DataFrame, column: str, own: str, few: bool | None = None) -> DataFrame:
    """Rows whose ``column`` is not among ``gone`` (NULL stays)."""
    left, right, on = _sides(rows, gone, column, own, few)
    return left.join(right, on, "left_anti").select(rows.columns)


def among(rows: DataFrame, gone: DataFrame, column: str, own: str, few: bool | None = None) -> DataFrame:
    """Rows whose ``column`` is among ``gone``."""
    left, right, on = _sides(rows, gone, column, own, few)
    return left.join(right, on, "left_semi").select(rows.columns)


def nulled(rows: DataFrame, gone: DataFrame, column: str, own: str, few: bool | None = None) -> DataFrame:
    """``rows`` with NULL for every value of ``column`` among ``gone``."""
    left, right, on = _sides(rows, gone, column, own, few)
    hit = left.join(right.withColumn("_hit", F.lit(True)), on, "left")
    return hit.select(*[F.when(F.col("_hit").isNull(), F.col(c)).alias(c) if c == column else F.col(c) for c in rows.columns])


def delete(store: Store, table: str, doomed: DataFrame, on_step: Callable[[str], None] = _nothing) -> Generation:
    """Delete the rows of ``table`` whose primary key is in the one column of ``doomed``, and what hangs on them.

    Returns the new generation, or the current one if no row was doomed."""
    base = store.current()
    scratch = f"{store.root}/_doomed/{uuid.uuid4().hex[:12]}"
    staged: dict[str, list[Part]] = {}
    current: dict[str, list[Part]] = {}
    gone: dict[str, tuple[DataFrame, bool]] = {}  # keys, and whether they are few

    def keep_keys(name: str, keys: DataFrame) -> None:
        path = f"{scratch}/{name}"
        keys.toDF("_key").where(F.col("_key").isNotNull()).distinct().write.parquet(path)
        kept = store.spark.read.schema("_key long").parquet(path)
        gone[name] = kept, is_few(kept)

    def rewrite(name: str, column: str, parent: str, change: Callable) -> list[Part]:
        """Change the touched parts of ``name``; returns them as they were."""
        (own,) = PRIMARY_KEYS[name]
        at = Generation(base.number, base.tables | {t: tuple(p) for t, p in current.items()})
        keys, few = gone[parent]
        hit = touched_parts(store, at, name, column, keys, few)
        if hit:
            new = store.stage(name, change(store.read_parts(name, hit), keys, column, own, few))
            staged.setdefault(name, []).extend(new)
            current[name] = [p for p in at.tables[name] if p not in hit] + new
            on_step(f"rewrote {name}")
        return hit

    try:
        (key,) = PRIMARY_KEYS[table]
        keep_keys(table, doomed)
        rewrite(table, key, table, without)
        for name in LOAD_ORDER:
            for child, column, parent, _, action in FOREIGN_KEYS:
                if child != name or parent not in gone:
                    continue
                if action == "set null":
                    rewrite(name, column, parent, nulled)
                    continue
                (own,) = PRIMARY_KEYS[name]
                hit = rewrite(name, column, parent, without)
                if any(p == name for _, _, p, _, _ in FOREIGN_KEYS):
                    keys, few = gone[parent]
                    keep_keys(name, among(store.read_parts(name, hit), keys, column, own, few).select(own))
        new = store.commit(base, current) if current else base
    except Exception:
        store.discard(staged)
        raise
    finally:
        fs, at = file_system(store.spark, scratch)
        fs.delete(at, True)
    on_step("committed")
    return new
