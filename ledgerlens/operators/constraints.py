"""Audits of many constraints in few passes: row rules, keys by bitmaps, foreign keys (i1-i7).

* ``row_pass``: every NOT NULL, domain, range and length rule of a table, and the range of
  each of its keys, as one aggregate over one scan.
* ``key_audits``: primary keys and UNIQUE columns of a table over one scan.  A *dense* integer
  key (its values span at most ``SPAN`` times their number) is a bit of a long for each
  64 values: the exchange carries bitmaps, and rows less set bits is the number of
  duplicates, exactly.  Other keys (sparse numbers, text) are counted per key.
* ``foreign_key_audits``: all foreign keys of a child table with dense parents over one scan.  Child and parent
  bitmaps of a bucket are merged; where the child adds no bit, it has no orphan.  Only keys
  near those (in runs of 32,768 values) are looked at by key.  Keys whose parents are sparse are counted per key.

A hot key is one bit, or one row a task, before any exchange.  Each function runs the small
job that tells dense from sparse (or takes its result), so it isn't lazy.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.integrity import _OPS, foreign_key_audit, key_audit, union_all
from ledgerlens.sources import schemas as S

SPAN = 32
#: Bits of a key within its run of values (32,768) that is looked at by key where an orphan lies.
SHIFT = 15
AUDIT = "rule string, checked_rows long, violations long"
_INTEGERS = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)


def is_integer(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, _INTEGERS)


def _spans(columns: list[str]) -> list[Column]:
    return [F.struct(F.count(c).alias("n"), F.min(c).cast("long").alias("lo"), F.max(c).cast("long").alias("hi")).alias(f"span_{c}") for c in columns]


def _is_dense(span) -> bool:
    return span["n"] > 0 and span["lo"] >= 0 and span["hi"] - span["lo"] < SPAN * span["n"]


def dense_columns(df: DataFrame, columns: list[str]) -> set[str]:
    """The integer columns of ``columns`` whose values are dense (one scan)."""
    integers = [c for c in dict.fromkeys(columns) if is_integer(df, c)]
    if not integers:
        return set()
    row = df.agg(*_spans(integers)).first()
    return {c for c in integers if _is_dense(row[f"span_{c}"])}


def row_conditions(df: DataFrame, table: str) -> dict[str, Column]:
    """rule -> condition of a violating row: every declared rule that looks at one row."""
    out = {f"not_null:{table}.{c}": F.col(c).isNull() for c in S.required_columns(table)}
    out |= {f"domain:{table}.{c}": ~F.col(c).isin(*values) for (t, c), values in S.DOMAINS.items() if t == table}
    out |= {f"range:{table}.{c}{op}{b}": ~_OPS[op](F.col(c), F.lit(b)) for t, c, op, b in S.RANGES if t == table}
    return out | {f"length:{table}.{c}<={n}": F.length(c) > n for (t, c), n in S.LENGTHS.items() if t == table}


def row_pass(df: DataFrame, table: str) -> tuple[list[tuple[str, int, int]], set[str]]:
    """(rule, checked_rows, violations) of every row rule, and the table's dense integer columns: one scan, one row."""
    conditions = row_conditions(df, table)
    integers = [c for c in df.columns if is_integer(df, c)]
    counts = [F.count_if(F.coalesce(cond, F.lit(False))).alias(f"v{i}") for i, cond in enumerate(conditions.values())]
    row = df.agg(F.count(F.lit(1)).alias("checked"), *counts, *_spans(integers)).first()
    rules = [(rule, row.checked, row[f"v{i}"]) for i, rule in enumerate(conditions)]
    return rules, {c for c in integers if _is_dense(row[f"span_{c}"])}


def _bucket(value: Column, bits: int) -> Column:
    return F.shiftright(value, bits)


def bitmaps(keys: DataFrame) -> DataFrame:
    """(rule, key) rows as (rule, bucket, n, word, bits): rows and bitmap (as a long and as bytes) of each 64 values; a null key has bucket null.

    A bitmap is a long that ``bit_or`` merges in a hash table, so a task sorts no rows and holds one long a bucket."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("key").bitwiseAND(63).cast("int"))
    counted = keys.groupBy("rule", F.shiftright("key", 6).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("word"))
    return counted.withColumn("bits", F.unhex(F.lpad(F.hex("word"), 16, "0")))


def _exploded(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(rule, key): one scan for several keys of a table."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(c).cast("long").alias("key")) for rule, c in columns.items()])).alias("k")).select("k.*")


def key_audits(df: DataFrame, table: str, keys: list[tuple[str, list[str]]], dense: set[str] | None = None) -> DataFrame:
    """i2 / i3 for ``keys``, pairs of a kind (``primary_key`` or ``unique``) and the key's columns."""
    if dense is None:
        dense = dense_columns(df, [c[0] for _, c in keys if len(c) == 1])
    name = lambda kind, columns: f"{kind}:{table}({','.join(columns)})"
    by_bits = {name(kind, c): c[0] for kind, c in keys if len(c) == 1 and c[0] in dense}
    frames = []
    if by_bits:
        marked = bitmaps(_exploded(df, by_bits))
        extra = F.when(F.col("bucket").isNull(), F.when(F.startswith("rule", F.lit("primary_key")), F.col("n")).otherwise(0)).otherwise(F.col("n") - F.bitmap_count("bits"))
        frames.append(_by_rule(marked.groupBy("rule").agg(F.sum("n").alias("checked_rows"), F.sum(extra).alias("violations")), list(by_bits)))
    others = [(kind, c) for kind, c in keys if name(kind, c) not in by_bits]
    # one aggregation a key: a table bucketed on it needs no exchange
    frames += [key_audit(df, table, c, nulls_allowed=kind == "unique", kind=kind) for kind, c in others]
    return union_all(frames)


def _by_rule(found: DataFrame, rules: list[str]) -> DataFrame:
    """One row for each of ``rules``, zeros for those that met no row."""
    zero = found.sparkSession.createDataFrame([(r,) for r in rules], "rule string")
    joined = zero.join(found, "rule", "left")
    return joined.select("rule", F.coalesce("checked_rows", F.lit(0)).cast("long").alias("checked_rows"), F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))


def foreign_key_audits(child: DataFrame, child_table: str, keys: list[tuple[str, str, DataFrame, str]], dense: dict[str, set[str]] | None = None) -> DataFrame:
    """i6 for all ``keys`` (child column, parent's name, parent rows, parent column) of one child table.

    ``dense`` names the dense columns of each parent, where they are known."""
    rule = lambda column, parent, pcol: f"foreign_key:{child_table}.{column}->{parent}.{pcol}"
    by_bits, by_key = [], []
    for column, parent, rows, pcol in keys:
        if dense is not None and parent in dense:
            is_dense = pcol in dense[parent]
        else:
            is_dense = bool(dense_columns(rows, [pcol]))
        (by_bits if is_dense and is_integer(child, column) else by_key).append((column, parent, rows, pcol))
    frames = []
    if by_bits:
        own = _exploded(child, {rule(c, p, pc): c for c, p, _, pc in by_bits})
        parents = union_all([rows.select(F.lit(rule(c, p, pc)).alias("rule"), F.col(pc).cast("long").alias("key")) for c, p, rows, pc in by_bits])
        a, b = bitmaps(own).drop("bits"), bitmaps(parents.where("key IS NOT NULL")).drop("bits")
        both = a.withColumn("theirs", F.lit(None).cast("long")).unionByName(b.select("rule", "bucket", F.lit(0).cast("long").alias("n"), "word", F.col("word").alias("theirs")))
        both = both.groupBy("rule", "bucket").agg(F.sum("n").alias("n"), F.bit_count(F.bit_or("word")).alias("bits"), F.bit_count(F.coalesce(F.bit_or("theirs"), F.lit(0).cast("long"))).alias("theirs"))
        found = both.withColumn("more", F.when(F.col("bucket").isNotNull() & (F.col("n") > 0), F.col("bits") - F.col("theirs")).otherwise(0))
        spread = F.when(F.col("more") > 0, _bucket(F.col("bucket"), SHIFT - 6))
        totals = found.groupBy("rule").agg(F.sum("n").alias("checked_rows"), F.collect_set(spread).alias("buckets")).collect()  # one row a rule
        bad = [(r.rule, x) for r in totals for x in r.buckets]
        checked = child.sparkSession.createDataFrame([(r.rule, r.checked_rows) for r in totals], "rule string, checked_rows long")
        if bad:  # buckets with orphans, by key
            there = child.sparkSession.createDataFrame(bad, "rule string, bucket long")
            hit = lambda rows: rows.withColumn("bucket", _bucket(F.col("key"), SHIFT)).join(there, ["rule", "bucket"], "left_semi")
            orphans = hit(own).groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n")).join(hit(parents).select("rule", "key"), ["rule", "key"], "left_anti")
            checked = checked.join(orphans.groupBy("rule").agg(F.sum("n").alias("violations")), "rule", "left")
        else:
            checked = checked.withColumn("violations", F.lit(0))
        frames.append(_by_rule(checked, [rule(c, p, pc) for c, p, _, pc in by_bits]))
    frames += [foreign_key_audit(child, rows, child_table, c, p, pc) for c, p, rows, pc in by_key]
    return union_all(frames)


def constraint_audits(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared constraint of ``tables`` (i1-i7): rule, checked_rows, violations.

    A table is scanned once for its row rules, once for its dense keys and once for its foreign
    keys with dense parents; sparse and text keys take an aggregation each.
    Money is read as NUMERIC(15,2), so a value that doesn't fit (i8) fails the scan."""
    spark = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(len(tables)) as pool:  # small jobs, several at a time
        passes = dict(zip(tables, pool.map(lambda t: row_pass(tables[t], t), tables)))
        dense = {t: found for t, (_, found) in passes.items()}

        def keys(t: str) -> list[tuple[str, int, int]]:
            own = [("primary_key", S.PRIMARY_KEYS[t])] + [("unique", k) for k in S.UNIQUE_KEYS.get(t, [])]
            found = [key_audits(tables[t], t, own, dense[t])]
            if links := [(c, p, tables[p], pc) for child, c, p, pc, _ in S.FOREIGN_KEYS if child == t and p in tables]:
                found.append(foreign_key_audits(tables[t], t, links, dense))
            return [tuple(r) for r in union_all(found).collect()]  # one row a constraint

        of_keys = list(pool.map(keys, tables))
    return spark.createDataFrame([r for rules, _ in passes.values() for r in rules] + [r for found in of_keys for r in found], AUDIT)
