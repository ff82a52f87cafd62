"""Exact dedup as a stateful stream (operator 1).

Arrivals are keyed by the SHA-256 of the normalised text.  A Structured
Streaming aggregation keeps, per digest and without expiry, the stable
identifier (smallest ``doc_id``), the content locator that goes with it and
the number of rows.  The state lives in RocksDB on the executors' disks, with
its change log in the stream's checkpoint below ``spark.checkpoint.dir``, so a
lost executor's state is rebuilt from there.  A digest hit is not trusted: the
full bytes of every arrival whose digest is already held are compared with the
bytes of the document the state points to, and texts that differ form groups of
their own.

Skew: the stream sums each micro-batch per digest before its exchange (a hot
digest is one row per map task); the byte comparison salts each hit group by
its size, so a group of a third of all rows is spread over many tasks.

Defined cases: a null text is the empty text; of rows that repeat a ``doc_id`` with
an equal text one stays (``group_size`` counts the rows, ``every_row`` returns them all);
a null ``doc_id`` sorts after every number and stays only if its group has no other; an empty
table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import WHITE, land, run_folder, text_of

#: Settings while the stream runs.  Changed rows alone are uploaded to the checkpoint, and
#: a store takes the disk that it uses (by default each preallocates some MB, for every partition).
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Copies of a row that are made at once.
CHUNK = 4096
#: Rows of a hit group that one task compares with its stored document.
SALT_ROWS = 2048
ARRIVAL = T.StructType([
    T.StructField("digest", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("sha", T.StringType()),
    T.StructField("locator", T.StringType()),
    T.StructField("n", T.LongType()),
])
LAST_ID = 9223372036854775807  # stands for a null identifier while ids are compared


def normalised(text: Column) -> Column:
    """Every run of ASCII white space becomes one space."""
    return F.regexp_replace(text, WHITE, " ")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _keyed(docs: DataFrame, digest) -> DataFrame:
    """(id, digest, sha, body): the whole normalised text, the key of the state and the SHA-256 (one value by default)."""
    body = docs.select(F.col("doc_id").cast("long").alias("id"), normalised(text_of("text")).alias("body"))
    keyed = body.select("id", digest(F.col("body")).alias("digest"), "body")
    return keyed.withColumn("sha", F.col("digest") if digest is sha256_hex else sha256_hex(F.col("body")))


class DedupStream:
    """Deduplication state that outlives a batch: ``ingest`` any number of
    batches of documents, then read the state with ``held``."""

    def __init__(self, spark: SparkSession, folder: str | None = None, digest=sha256_hex, files_per_batch: int | None = None):
        self.spark, self.digest = spark, digest
        self.folder = folder or run_folder(spark, "dedup")
        self.files_per_batch = files_per_batch
        self.batches = 0

    def ingest(self, docs: DataFrame) -> DataFrame:
        """Add a batch; returns its arrivals, one row per document (digest, id, sha, locator, n)."""
        at = f"{self.folder}/inbox/{self.batches:06d}"
        self.batches += 1
        keyed = _keyed(docs, self.digest).select("digest", "id", "sha", F.concat_ws("#", F.input_file_name(), F.col("id")).alias("locator"))
        arrivals = land(keyed.groupBy("digest", "id", "sha").agg(F.min("locator").alias("locator"), F.count(F.lit(1)).alias("n")), at)
        self._consume()
        return arrivals

    def _consume(self) -> None:
        """Run the stream over what is new in the inbox, then stop."""
        spark = self.spark
        source = spark.readStream.schema(ARRIVAL)
        if self.files_per_batch:
            source = source.option("maxFilesPerTrigger", self.files_per_batch)
        arrivals = source.parquet(f"{self.folder}/inbox/*")
        first = F.min(F.struct(F.coalesce("id", F.lit(LAST_ID)).alias("id"), "locator"))
        state = arrivals.groupBy("digest").agg(first.alias("first"), F.sum("n").alias("group_size"))
        state = state.select("digest", F.col("first.id").alias("first_id"), F.col("first.locator").alias("locator"), "group_size")
        changed = f"{self.folder}/changed"

        def keep(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{changed}/batch={number}")

        before = {key: spark.conf.get(key, None) for key in STATE}
        for key, value in STATE.items():
            spark.conf.set(key, value)
        try:
            query = (
                state.writeStream.outputMode("update").foreachBatch(keep)
                .option("checkpointLocation", f"{self.folder}/stream").trigger(availableNow=True).start()
            )
            query.awaitTermination()
        finally:
            for key, value in before.items():
                spark.conf.set(key, value) if value is not None else spark.conf.unset(key)

    def held(self) -> DataFrame:
        """The state: digest, first_id (stable identifier), locator, group_size."""
        changed = self.spark.read.schema("digest string, first_id long, locator string, group_size long, batch int").parquet(f"{self.folder}/changed")
        last = changed.groupBy("digest").agg(F.max_by(F.struct("first_id", "locator", "group_size"), "batch").alias("s"))
        return last.select("digest", "s.first_id", "s.locator", "s.group_size")


def classes(docs: DataFrame, digest=sha256_hex, stream: DedupStream | None = None) -> DataFrame:
    """One row per (doc_id, text): doc_id, keep_id, group_size (rows), kept, text_sha256, locator, n (rows like it)."""
    spark = docs.sparkSession
    stream = stream or DedupStream(spark, digest=digest)
    arrivals = stream.ingest(docs)
    held = stream.held()
    hits = _hits(docs, held, digest, f"{stream.folder}/hits")
    other = land(_differing(hits), f"{stream.folder}/differing")  # empty unless a digest collides
    moved = other.groupBy("digest", "sha", "body").agg(
        F.min(F.coalesce("id", F.lit(LAST_ID))).alias("new_first"), F.count(F.lit(1)).alias("new_size")).drop("body")
    lost = other.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    rows = arrivals.withColumn("key", F.coalesce("id", F.lit(LAST_ID))).drop("locator").join(held, "digest")
    rows = rows.join(lost, "digest", "left").join(moved, ["digest", "sha"], "left")
    first = F.coalesce("new_first", "first_id")
    return rows.select(
        F.nullif("key", F.lit(LAST_ID)).alias("doc_id"),
        F.nullif(first, F.lit(LAST_ID)).alias("keep_id"),
        F.coalesce("new_size", F.col("group_size") - F.coalesce("lost", F.lit(0))).cast("long").alias("group_size"),
        (F.col("key") == first).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "locator",
        "n",
    )


def every_row(found: DataFrame) -> DataFrame:
    """``classes`` with a row for every input row; of rows equal in id and text the first alone is kept."""
    some = found.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
    copies = F.sequence(F.col("chunk") * CHUNK, F.least(F.col("n"), (F.col("chunk") + 1) * CHUNK) - 1)  # arrays of bounded size
    each = some.withColumn("copy", F.explode(copies))
    return each.withColumn("kept", F.col("kept") & (F.col("copy") == 0)).drop("n", "chunk", "copy")


def _hits(docs: DataFrame, held: DataFrame, digest, at: str) -> DataFrame:
    """Rows whose digest is held more than once, with their full bytes."""
    repeated = held.where("group_size > 1").select("digest", "first_id", "group_size")
    return land(_keyed(docs, digest).join(repeated, "digest"), at)  # text is written for hits alone


def _differing(hits: DataFrame) -> DataFrame:
    """Hits whose bytes are not those of the document the state points to."""
    pieces = (F.col("group_size") / F.lit(SALT_ROWS)).cast("int") + 1
    key = F.coalesce("id", F.lit(LAST_ID))
    stored = hits.where(key == F.col("first_id")).groupBy("digest", "group_size").agg(F.min(F.struct("sha", "body")).alias("s"))
    stored = stored.select("digest", "group_size", F.col("s.body").alias("stored"))
    stored = stored.select("digest", "stored", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("salt"))
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("id", "body"), pieces).cast("int"))
    return salted.join(stored, ["digest", "salt"]).where(F.col("body") != F.col("stored")).select("digest", "id", "sha", "body")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, all their columns: one of each group of equal texts."""
    names = docs.columns
    found = classes(docs).where("kept").select(
        F.coalesce("doc_id", F.lit(LAST_ID)).alias("__key"), F.col("text_sha256").alias("__digest"), F.col("group_size").alias("__size"))
    tagged = docs.withColumns({
        "__key": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "__digest": sha256_hex(normalised(text_of("text")))})
    stay = tagged.join(found, ["__key", "__digest"])
    alone = stay.where("__size = 1").select(names)
    return alone.unionByName(stay.where("__size > 1").dropDuplicates(["__key", "__digest"]).select(names))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of equal texts stays (contract of op1)."""
    from ledgerlens.llm.common import table

    return every_row(classes(table(spark, sf_dir, "documents").select("doc_id", "text"))).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents
), g AS (
  SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body
)
SELECT n.doc_id, g.keep_id, g.group_size, row_number() OVER (PARTITION BY n.body ORDER BY n.doc_id NULLS LAST) = 1 AS kept, n.text_sha256
FROM n JOIN g ON n.body = g.body
"""
