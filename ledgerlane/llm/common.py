"""What the operators of this folder share."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.sources.versions import delete
from ledgerlane.sources.workspace import new_run_folder

# Whole texts are handled in slices of about this many bytes and at most this many texts inside a task,
# so that a slice's texts can be numbered in 16 bits.
SLICE_BYTES = 2 << 20
SLICE_TEXTS = 1 << 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        # The driver serves this file itself; executors never look for its folder.
        archive = Path(tempfile.mkdtemp()) / package.name
        made = shutil.make_archive(str(archive), "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(made)
        _SHIPPED.add(app)


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held(docs: DataFrame, **named: Column) -> DataFrame:
    """The whole row as one column `row` beside named ones, so that no column of docs can clash with these.

    `select("row.*")` gives the rows back.
    """
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), *[c.alias(name) for name, c in named.items()])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the folder all executors share, and read that from then on."""
    spark = df.sparkSession
    folder = new_run_folder(spark, purpose)
    df.write.parquet(folder)
    _WRITTEN.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


# Folders that `stored` has made in this process, in order.
_WRITTEN: list[str] = []


def written() -> int:
    return len(_WRITTEN)


def drop_written(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Delete what `stored` has written since there were so many folders, but the last `keep`.

    For callers that know that nothing reads these any more.
    """
    for folder in _WRITTEN[since : len(_WRITTEN) - keep]:
        delete(spark, folder)
    del _WRITTEN[since : len(_WRITTEN) - keep]


# Tasks for each core that write a table on the way, and whole texts, at most.
WRITERS, TEXT_WRITERS = 2, 4


def in_few_files(df: DataFrame, writers: int = WRITERS) -> DataFrame:
    """The rows of df in at most so many tasks for each core, so that as many files hold them when they are written.

    Hadoop starts a process for every file that it makes in a local folder. Tasks read the former partitions one after
    another, so df must not name rows by its tasks' numbers in its last step.
    """
    return df.coalesce(writers * df.sparkSession.sparkContext.defaultParallelism)


# Only glibc has it.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return this process' free memory to the system.

    Spark keeps Python workers between tasks, and what a worker has once held it would hold on to.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels must never be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def utf8(texts: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    for value in texts.cast(pa.binary()):
        yield value.as_py() or b""


def byte_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into slices of about `size` bytes and at most SLICE_TEXTS texts, never inside a text.

    Yields first row, row after the last, the bytes of these rows, and the byte
    offset of each row and of the end. A null text has no bytes.
    """
    if texts.null_count:
        texts = texts.fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    large = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    if len(texts) == 0:
        return
    offsets = np.frombuffer(places, dtype=np.int64 if large else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        end = min(max(end, first + 1), first + SLICE_TEXTS, len(texts))
        at = offsets[first : end + 1]
        yield first, end, raw[at[0] : at[-1]], at - at[0]
        first = end


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(text, label) of at most `rows` labels that may be learned from and have a document, by hash of doc_id.

    The chosen ids are bounded by `rows`, so they are broadcast. Of several texts of a chosen id one is
    taken, so the sample has at most `rows` rows however often an id stands in docs.
    """
    chosen = (
        labels.filter(~held_out(F.col("doc_id")) & F.col(label).isin(0, 1))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .distinct()
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    return (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select("text", "label")
    )
