"""Sharding by balanced label propagation (operator 12).

Documents of equal text are linked.  Each starts in the shard that its place in the input
gives it, so shards start even; then rounds of Spark joins move documents towards the
shard where most of their neighbours are, under quotas, until nothing moves:

1. *Cells.*  Documents of one group in one shard have the same neighbours and the same gain,
   so the state is one row per (group, shard) with a count: a group of a third of all rows is
   as many rows as there are shards, whatever its size.
2. *Wishes.*  Each cut group (in several shards) names the shard where most of it is, and
   every second round the fullest of its shards that has room; its other cells ask to move.
   A shard that one group fills by itself is left out, so that a group larger than a quota
   gathers in one shard after the other.
3. *Quotas.*  Demands are summed per (shard, target, gain, bucket), a table of bounded size.
   What two shards ask of each other is swapped, more goes as far as the target's quota of
   all rows has room, in order of gain.  A group over a quota's ``LARGE``-th is a bucket of
   its own and may move in part.
4. Documents join their group's cells for their shard; documents without links (and linked
   ones beyond a quota, where buckets were swapped unevenly) fill what is left of the
   quotas, exactly.

Law: ``rows``.  A shard's quota is its even share of the rows, so counts are at most one
apart; groups are cut only where a shard can't hold them.  ``cut`` counts the cut links.

Skew: groups with over 1/``PIECES`` of all rows (so at most ``PIECES`` of them) are numbered
and joined in pieces; slots are numbered in buckets of about ``BUCKET`` rows.  The tables that
are broadcast by hint have at most that many groups' pieces; others are left to the planner.

Defined cases: a null text has no bytes and is equal to the empty text; null ids and repeated
rows are documents of their own; fewer rows than shards leave shards empty; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import land, run_folder, table, text_of

SHARDS = 8
ROUNDS = 12
#: A group with more than 1/LARGE of a shard's quota moves by itself, in part if need be.
LARGE = 64
#: A shard that one group fills to this share is left alone by that group.
FULL = 0.95
#: Buckets of small groups for each (shard, target, gain).
CELLS = 1024
#: At most this many groups are treated in pieces: those with over 1/PIECES of all rows.
PIECES = 4096
#: Rows of a numbering bucket, about.
BUCKET = 1 << 16


def _base(docs: DataFrame, folder: str) -> DataFrame:
    """row (unique), doc_id, size, crc, g (digest of the text)."""
    text = text_of("text")
    body = text.cast("binary")
    return land(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(body).alias("crc"), F.unhex(F.sha2(body, 256)).alias("g")), f"{folder}/base")


def _members(base: DataFrame, n: int, folder: str) -> DataFrame:
    """``base`` with place (0 to n - 1), salt, k (number in the group) and members (the group's size)."""
    part = F.shiftright("row", 33).alias("part")
    parts = base.groupBy(part).agg(F.count(F.lit(1)).alias("c"), F.min("row").alias("lo"))  # one row per written partition
    before = F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = land(parts.select("part", "lo", F.coalesce(before, F.lit(0)).alias("before")), f"{folder}/starts")
    placed = base.withColumn("part", part).join(starts, "part").withColumn("place", F.col("before") + F.col("row") - F.col("lo")).drop("part", "before", "lo")

    share = max(1, n // PIECES)
    sizes = base.groupBy("g").agg(F.count(F.lit(1)).alias("hot_size")).where(F.col("hot_size") > max(1, share))
    hot = land(sizes.select("g", "hot_size", F.ceil(F.col("hot_size") / share).cast("int").alias("pieces")), f"{folder}/hot")  # at most PIECES rows
    salt = F.coalesce(F.pmod(F.col("row"), F.col("pieces")).cast("int"), F.lit(0))
    salted = placed.join(F.broadcast(hot), "g", "left").withColumn("salt", salt)
    lengths = base.join(F.broadcast(hot), "g").groupBy("g", salt.alias("salt")).agg(F.count(F.lit(1)).alias("c"))  # at most 2 x PIECES rows
    offset = F.sum("c").over(Window.partitionBy("g").orderBy("salt")) - F.col("c")
    offsets = land(lengths.select("g", "salt", offset.alias("offset")), f"{folder}/offsets")

    piece = Window.partitionBy("g", "salt")
    counted = salted.withColumns({"k": F.row_number().over(piece.orderBy("row")) - 1, "c": F.count(F.lit(1)).over(piece)})
    whole = counted.join(F.broadcast(offsets), ["g", "salt"], "left")
    return land(whole.select(
        "row", "doc_id", "size", "crc", "g", "salt", "place", F.coalesce("pieces", F.lit(1)).alias("pieces"),
        (F.col("k") + F.coalesce("offset", F.lit(0))).alias("k"), F.coalesce("hot_size", "c").cast("long").alias("members")), f"{folder}/members")


def _pick(values: list[int], at: Column) -> Column:
    return F.get(F.lit(values), at)


def cut(cells: DataFrame) -> int:
    """Links that are cut, where each group is a star around its fullest shard."""
    apart = cells.groupBy("g").agg((F.sum("n") - F.max("n")).alias("c"))
    return apart.agg(F.sum("c")).first()[0] or 0


def _flows(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many may go from shard to shard: what both directions ask for is swapped, the rest shares the target's room."""
    flows = {(i, j): min(d, asked.get((j, i), 0)) for (i, j), d in asked.items()}
    for j, free in enumerate(room):
        rest = {i: asked[i, t] - flows[i, t] for i, t in asked if t == j}
        for i in sorted(rest, key=rest.get, reverse=True):
            more = max(0, min(rest[i], free))
            flows[i, j] += more
            free -= more
    return flows


def _round(cells: DataFrame, quotas: list[int], number: int, folder: str) -> DataFrame:
    """The moves that are admitted (g, shard, target, moved), from the state ``cells`` (g, members, pieces, shard, n)."""
    shards = len(quotas)
    held = {r.shard: r.n for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # one row per shard
    room = [max(0, quotas[s] - held.get(s, 0)) for s in range(shards)]
    large = F.col("members") > max(1, max(quotas) // LARGE)

    # a shard that a group fills by itself takes no more of it and gives none up
    loose = cells.where(F.col("n") < F.ceil(_pick(quotas, F.col("shard")) * FULL))
    order = F.struct("n", F.pmod(F.xxhash64("g", "shard", F.lit(number)), F.lit(1 << 20)).alias("tie"), "shard")
    needs = F.when(large, F.lit(1)).otherwise(F.col("members") - F.col("n"))
    wanted = F.max(order) if number % 2 else F.max(F.when(_pick(room, F.col("shard")) >= needs, order))
    tally = loose.groupBy("g").agg(F.count(F.lit(1)).alias("spread"), wanted.alias("to")).where("spread > 1 AND to IS NOT NULL")
    wishes = loose.join(tally, "g").where((F.col("shard") != F.col("to.shard")) & (~large | (F.col("n") <= F.col("to.n"))))
    wishes = wishes.select("g", "shard", F.col("to.shard").alias("target"), "n", large.alias("large"), F.floor(F.log2("members")).cast("int").alias("gain"))
    bucket = F.when(F.col("large"), F.hex("g")).otherwise(F.pmod(F.xxhash64("g", F.lit(number)), F.lit(CELLS)).cast("string"))
    wishes = land(wishes.withColumn("bucket", bucket), f"{folder}/wishes-{number}")

    key = ["shard", "target", "gain", "bucket"]
    demand = land(wishes.groupBy(*key, "large").agg(F.sum("n").alias("asked")), f"{folder}/demand-{number}")  # shards x shards x gains x CELLS at most
    asked = {(r.shard, r.target): r.n for r in demand.groupBy("shard", "target").agg(F.sum("asked").alias("n")).collect()}  # one row per pair of shards
    flows = _flows(asked, room)
    flow = _pick([flows.get((i, j), 0) for i in range(shards) for j in range(shards)], F.col("shard") * shards + F.col("target"))
    upto = F.sum("asked").over(Window.partitionBy("shard", "target").orderBy(F.desc("gain"), "bucket"))
    left = flow - (upto - F.col("asked"))
    granted = F.when(left >= F.col("asked"), F.col("asked")).when(F.col("large") & (left > 0), left)
    quota = demand.select(*key, granted.alias("granted")).where("granted > 0")
    return wishes.join(quota, key).select("g", "shard", "target", F.least("n", "granted").alias("moved"))


def propagate(cells: DataFrame, quotas: list[int], folder: str, rounds: int = ROUNDS) -> DataFrame:
    """Cells (g, members, pieces, shard, n) after label propagation, with about ``quotas[s]`` linked documents in shard s at most."""
    names = ["g", "members", "pieces", "shard", "n"]
    cells = land(cells.select(names), f"{folder}/cells-0")
    idle = 0
    for number in range(1, rounds + 1):
        moves = land(_round(cells, quotas, number, folder), f"{folder}/moves-{number}")
        idle = idle + 1 if moves.isEmpty() else 0
        if idle == 2:
            break
        if idle:
            continue
        gone = moves.select("g", "shard", (-F.col("moved")).alias("n"))
        come = moves.select("g", F.col("target").alias("shard"), F.col("moved").alias("n"))
        changed = gone.unionByName(come).join(cells.select("g", "members", "pieces").distinct(), "g").select(names)
        after = cells.unionByName(changed).groupBy("g", "members", "pieces", "shard").agg(F.sum("n").alias("n"))
        cells = land(after.where("n > 0").select(names), f"{folder}/cells-{number}")
    return cells


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, size, crc, g, members (rows of its text), shard, slot (gapless from 0 in the shard)."""
    folder = run_folder(docs.sparkSession, "shards")
    base = _base(docs, folder)
    n = base.count()
    quotas = [n // shards + (s < n % shards) for s in range(shards)]
    members = _members(base, n, folder)
    start = F.pmod(F.col("place"), F.lit(shards)).cast("int").alias("shard")
    linked = members.where("members > 1")
    cells = propagate(linked.groupBy("g", "members", "pieces", start).agg(F.count(F.lit(1)).alias("n")), quotas, folder, rounds)

    # numbers upto[s - 1] to upto[s] - 1 of a group are the documents of shard s
    ends = cells.groupBy("g", "pieces").agg(*(F.sum(F.when(F.col("shard") == s, F.col("n")).otherwise(0)).alias(f"n{s}") for s in range(shards)))
    upto = F.array(*(sum((F.col(f"n{j}") for j in range(s)), F.col(f"n{s}")) for s in range(shards)))
    ends = ends.select("g", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("salt"), upto.alias("upto"))
    keep = ["row", "doc_id", "size", "crc", "g", "members"]
    shard = F.size(F.filter("upto", lambda end: end <= F.col("k"))).alias("shard")
    settled = linked.join(ends, ["g", "salt"]).select(*keep, shard)
    alone = members.where("members = 1").select(*keep, F.lit(None).cast("int").alias("shard"))
    bucket = F.pmod(F.xxhash64("row"), F.lit(max(1, -(-n // BUCKET)))).alias("bucket")
    return _slots(land(settled.unionByName(alone).withColumn("bucket", bucket), f"{folder}/settled"), quotas, folder)


def _slots(rows: DataFrame, quotas: list[int], folder: str) -> DataFrame:
    """Deal the rows without a shard into what is left of the quotas, and number each shard's rows.

    Where more rows are settled in a shard than its quota, the last ones are dealt too."""
    shards = len(quotas)
    counts = rows.groupBy("bucket").agg(
        F.count(F.when(F.col("shard").isNull(), 1)).alias("free"), *(F.count(F.when(F.col("shard") == s, 1)).alias(f"c{s}") for s in range(shards)))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row for BUCKET rows of the input

    def ahead(column: Column) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    counts = counts.select("*", *(ahead(F.col(f"c{s}")).alias(f"b{s}") for s in range(shards)))
    counts = counts.select("bucket", "free", *(F.greatest(F.lit(0), F.least(F.col(f"c{s}"), quotas[s] - F.col(f"b{s}"))).alias(f"k{s}") for s in range(shards)),
                           sum((F.col(f"c{s}") for s in range(shards)), F.lit(0)).alias("settled"))
    kept = sum((F.col(f"k{s}") for s in range(shards)), F.lit(0))
    counts = land(counts.withColumn("free", F.col("free") + F.col("settled") - kept), f"{folder}/buckets")
    totals = counts.agg(*(F.sum(f"k{s}") for s in range(shards))).first()
    ends = [0]
    for s in range(shards):
        ends.append(ends[-1] + quotas[s] - (totals[s] or 0))  # free rows number ends[s] to ends[s + 1] - 1 go to shard s

    counts = counts.withColumn("first", ahead(F.col("free")))
    filled = [F.greatest(F.lit(0), F.least(F.col("first") + F.col("free"), F.lit(ends[s + 1])) - F.greatest("first", F.lit(ends[s]))) for s in range(shards)]
    counts = counts.select("bucket", "first", F.array(*(F.col(f"k{s}") for s in range(shards))).alias("kept"), *((F.col(f"k{s}") + filled[s]).alias(f"n{s}") for s in range(shards)))
    starts = land(counts.select("bucket", "first", "kept", F.array(*(ahead(F.col(f"n{s}")) for s in range(shards))).alias("starts")), f"{folder}/starts-of-slots")

    def number(*keys) -> Column:
        return F.row_number().over(Window.partitionBy("bucket", *keys).orderBy("row"))

    dealt = rows.repartition("bucket").join(starts, "bucket")
    dealt = dealt.withColumn("in_shard", number("shard")).withColumn("shard", F.when(F.col("in_shard") <= F.get("kept", F.col("shard")), F.col("shard")))
    dealt = dealt.withColumn("is_free", F.col("shard").isNull()).withColumn("place", F.col("first") + number("is_free") - 1)
    dealt = dealt.withColumn("shard", F.coalesce("shard", F.size(F.filter(F.lit(ends[1:]), lambda end: end <= F.col("place")))))
    slot = F.get("starts", F.col("shard")) + number("shard") - 1
    return dealt.select("doc_id", "size", "crc", "g", "members", "shard", slot.cast("long").alias("slot"))


def op12_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document under the law ``rows`` (contract of op12)."""
    found = assign(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("members").alias("group_size"))
