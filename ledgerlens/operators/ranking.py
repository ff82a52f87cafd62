"""RANK / ROW_NUMBER inside groups that stays balanced when one group is huge.

A window partitioned by the group key alone sends each group to one task.  Here a
group is cut into *pieces* by a column that follows the order (rows of a smaller piece
come first, ties share a piece): rows are ranked inside (group, piece), and each piece
adds the number of the group's rows in the pieces before it.  That running sum is a
window over one row per (group, piece), counted with map-side partial sums, so no task
sees more than a piece's rows or a group's pieces.  It is one lazy plan for every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rank_fn(kind: str):
    if kind == "rank":
        return F.rank()
    if kind == "row_number":
        return F.row_number()
    raise ValueError(f"unknown ranking kind {kind!r}")


def descending_magnitude(value: Column, per_doubling: int = 8) -> Column:
    """A piece for ``value`` descending, NULLs first: ``per_doubling`` pieces for each
    doubling of a positive value; values of zero or less share the last piece."""
    steps = F.floor(F.log2(F.greatest(value.cast("double"), F.lit(0.0)) + 1) * per_doubling)
    return F.when(value.isNull(), F.lit(-(2**31))).otherwise(-steps)


def rank_within_groups(
    df: DataFrame,
    group_cols: list[str],
    order: list[Column],
    out_col: str,
    piece: Column,
    kind: str = "rank",
) -> DataFrame:
    """RANK / ROW_NUMBER of ``order`` inside ``group_cols`` (a NULL group is a group too)."""
    keys = [*group_cols, "_piece"]
    cut = df.withColumn("_piece", piece)
    local = cut.withColumn("_local", _rank_fn(kind).over(Window.partitionBy(*keys).orderBy(*order)))
    before = Window.partitionBy(*group_cols).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(*[F.col(c).alias(f"_o_{c}") for c in keys], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    same = [local[c].eqNullSafe(offsets[f"_o_{c}"]) for c in keys]
    ranked = local.join(offsets, same).withColumn(out_col, (F.col("_local") + F.col("_off")).cast("int"))
    return ranked.drop("_piece", "_local", "_off", *[f"_o_{c}" for c in keys])


# ---- rank by splitters -----------------------------------------------------------

MIN_SPLITTERS, MAX_SPLITTERS, STEP = 64, 2048, 32


def _below(splitters: str, coarse: str, value: Column) -> Column:
    """How many of the ascending ``splitters`` are below ``value``: every ``STEP``-th first, then one stretch."""
    from_here = F.greatest(F.size(F.filter(coarse, lambda x: x < value)) - 1, F.lit(0)) * STEP
    return from_here + F.size(F.filter(F.slice(splitters, from_here + 1, F.lit(STEP)), lambda x: x < value))


def deal(df: DataFrame, group_cols: list[str], value_col: str, splitters: int) -> DataFrame:
    """``df`` with _piece (ascending with the value; NULL highest) and _salt.

    The splitters are a group's row quantiles (a mergeable sketch, one row a group).  A value that is
    several quantiles at once is a piece of its own, and its rows, being ties, may be dealt over as
    many salts; all other pieces hold about a ``splitters``-th of the group's rows."""
    value = F.col(value_col)
    at = F.percentile_approx(value, [k / splitters for k in range(1, splitters)], 20 * splitters)
    names = [f"_g_{c}" for c in group_cols]
    quantiles = df.groupBy(*[F.col(c).alias(n) for c, n in zip(group_cols, names)]).agg(at.alias("_all"))
    quantiles = quantiles.withColumn("_all", F.coalesce("_all", F.slice(F.array(F.lit(None).cast(df.schema[value_col].dataType)), 1, 0)))
    quantiles = quantiles.withColumn("_cuts", F.array_sort(F.array_distinct("_all")))
    quantiles = quantiles.withColumn("_coarse", F.filter("_cuts", lambda x, i: i % STEP == 0))
    joined = df.join(quantiles, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(group_cols, names)])
    times = F.coalesce(F.size(F.filter("_all", lambda x: x == value)), F.lit(0))
    share = F.when(value.isNull(), F.lit(splitters)).when(times > 1, times).otherwise(0)
    piece = F.when(value.isNull(), 2 * F.size("_cuts") + 2).otherwise(2 * _below("_cuts", "_coarse", value) + F.when(share > 0, 1).otherwise(0))
    salt = F.when(share > 0, F.pmod(F.xxhash64(*df.columns), share)).otherwise(F.lit(0))
    return joined.withColumns({"_piece": piece, "_salt": salt.cast("int")}).drop("_all", "_cuts", "_coarse", *names)


def rank_by_splitters(df: DataFrame, group_cols: list[str], value_col: str, out_col: str, splitters: int | None = None) -> DataFrame:
    """RANK of ``value_col`` descending (NULLs first) inside ``group_cols``, balanced for any distribution of values.

    Rows are ranked inside (group, piece, salt) and add the number of the group's rows in higher
    pieces; equal values of a salted piece all have the local rank 1, so ties of any number are
    counted, not brought together.  One lazy plan; the pieces' sizes are one row a piece."""
    if splitters is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        splitters = max(MIN_SPLITTERS, min(MAX_SPLITTERS, 4 * partitions))
    dealt = deal(df, group_cols, value_col, splitters)
    names = [f"_g_{c}" for c in group_cols]
    sizes = dealt.groupBy(*[F.col(c).alias(n) for c, n in zip(group_cols, names)], "_piece").agg(F.count(F.lit(1)).alias("_n"))
    above = F.sum("_n").over(Window.partitionBy(*names).orderBy(F.desc("_piece")).rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*names, F.struct("_piece", F.coalesce(above, F.lit(0)).alias("above")).alias("e"))
    starts = starts.groupBy(*names).agg(F.map_from_entries(F.collect_list("e")).alias("_above"))
    local = F.rank().over(Window.partitionBy(*group_cols, "_piece", "_salt").orderBy(F.col(value_col).desc_nulls_first()))
    ranked = dealt.withColumn("_local", local).join(starts, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(group_cols, names)])
    return ranked.withColumn(out_col, (F.col("_local") + F.element_at("_above", F.col("_piece"))).cast("int")).select(*df.columns, out_col)
