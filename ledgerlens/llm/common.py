"""Helpers the operators of this subpackage share: shared folders and reads."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import checkpoint_root

#: The columns of ``documents``; a filtering stage returns exactly these.
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = r"[\x20\x09-\x0D]+"


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` (shared by all executors)."""
    return f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: a lineage
    cut that survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


LAST_ID = 9223372036854775807  # stands for a null identifier while ids are compared


def row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with __id (null ids last) and __hash (of the whole text)."""
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "__hash": F.xxhash64(text_of("text"))})


def rows_chosen(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (__id, __hash) is in ``chosen``, all their columns.

    ``chosen`` also has __copies, the number of such rows: only rows that really
    repeat go through a second exchange, which leaves one of them."""
    names = docs.columns
    stay = row_key(docs).join(chosen, ["__id", "__hash"])
    alone = stay.where("__copies = 1").select(names)
    return alone.unionByName(stay.where("__copies > 1").dropDuplicates(["__id", "__hash"]).select(names))


#: Rows of a record batch whose texts are Python objects at a time.
PIECE_ROWS = 256


def pieces(batches: Iterable[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``rows`` rows, in order and without copies.  Spark sends 10,000 rows at once;
    texts made of all of them, and a result as large, stay with the Python worker after its task."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once for each application (needed where
    it isn't installed on the executors): a zip that Spark's own file server hands out."""
    import os
    import shutil
    import tempfile

    import ledgerlens

    context = spark.sparkContext
    if getattr(context, "_ledgerlens_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(ledgerlens.__file__))
    package = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-package-"), "ledgerlens")
    context.addPyFile(shutil.make_archive(package, "zip", os.path.dirname(here), "ledgerlens"))
    context._ledgerlens_shipped = True
