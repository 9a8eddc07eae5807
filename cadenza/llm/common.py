"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from cadenza.session import ensure_checkpoint_dir

# Text handed to one numpy pass; bounds a task's temporaries whatever the
# size of an Arrow batch. A longer single text is a pass of its own.
SLICE_BYTES = 1 << 18
# Rows handed to Python at a time: whole texts are wide, and every task holds a
# batch on both sides of the pipe outside the JVM's heap.
ARROW_ROWS = 250
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage, and a lost executor costs no recomputation. The
    shuffles of the write are removed with its end."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` over batches of at most ``ARROW_ROWS`` rows (a setting of the session).

    A worker outlives its task, so what Arrow has to spare is given back at the end.
    """
    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df.mapInArrow(task, schema)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def same(a: Column, b: Column) -> Column:
    """Equality in which null equals null."""
    return a.eqNullSafe(b)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of each piece add up to about ``limit`` bytes."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = size = 0
        for i, n in enumerate(lengths):
            if i > start and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


# Rows of one long each that a broadcast may hold (about 16 MB once hashed);
# beyond it the same join shuffles both sides.
BROADCAST_ROWS = 500_000


def by_ids(docs: DataFrame, ids: DataFrame, how: str, key: str = "doc_id") -> DataFrame:
    """Semi or anti join of ``docs`` with distinct ``ids`` (a stored table of one
    column ``key``). Wide texts stay in place while the ids are few; a counted
    check decides, and beyond it both sides are shuffled."""
    if ids.count() <= BROADCAST_ROWS:
        ids = ids.hint("broadcast")
    return docs.join(ids, key, how)
