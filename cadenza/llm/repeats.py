"""Windows that repeat in a corpus, found without shuffling every window.

Used by the byte-level (operator 4) and word-level (operator 6) removers.
The units of a text are bytes or words; a window is ``length`` of them.

1. Every text is covered by spans (``cover``). The hashes of their
   representatives are counted; a window can only repeat if its
   representative does, so all other spans end here.
2. Spans of one content form a class. A class of two or more members decides
   all their windows at once (the long ties). Only the earliest member of
   each class goes on, and only where a representative has several classes
   (the ends of matches).
3. For those the single windows are hashed and grouped, bucket by bucket of
   representative, offset and content.

No pairs are formed and nothing is dropped: every step is a count or minimum
per key with partial aggregation, so a passage in a third of all documents is
folded inside each task. Classes are told apart by the 64-bit hashes of their
content and representative, windows by 64 bits of content and 32 of the
representative.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import cover
from cadenza.llm.common import in_batches, slices, stored
from cadenza.llm.hashing import Prefix

# column of texts -> (prefix hashes over units, bounds of each text in units)
Units = Callable[[pa.Array], tuple[Prefix, np.ndarray]]


def _int64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text and row_id: a unique number of each row, in the order of doc_id (null last) and content.

    Unique ids number their rows themselves. With null or shared ids the rows
    are sorted and stored with their numbers; equal rows stand in any order.
    """
    docs = docs.select("doc_id", "text")
    if docs.where("doc_id IS NULL").isEmpty() and docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.withColumn("row_id", F.col("doc_id"))
    # The last key only deals equal rows out to several parts.
    rows = docs.withColumns({"key": F.sha2(F.coalesce("text", F.lit("")), 256), "at": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_last(), "key", "at"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.select("doc_id", "text", F.monotonically_increasing_id().alias("row_id")), "numbered")


def span_table(docs: DataFrame, units: Units, length: int, gram: int, only_gram: bool = False) -> DataFrame:
    """g (representative), and row_id, h (content class), start, count of each span."""
    def run(batches):
        for b in slices(batches):
            s = cover.spans(*units(b.column("text")), length, gram)
            if only_gram:
                yield pa.RecordBatch.from_arrays([_int64(s.gram)], ["g"])
                continue
            ids = b.column("row_id").take(pa.array(s.doc))
            yield pa.RecordBatch.from_arrays([_int64(s.gram), ids, _int64(s.content), pa.array(s.start, pa.int32()), pa.array(s.count, pa.int32())], ["g", "row_id", "h", "start", "count"])
    return docs.select("row_id", "text").transform(in_batches, run, "g long" if only_gram else "g long, row_id long, h long, start int, count int")


def window_table(docs: DataFrame, units: Units, length: int, gram: int) -> DataFrame:
    """Windows of the spans listed in column ``open`` (array of start, count): row_id, place, w (content), g (half of the representative)."""
    def run(batches):
        for b in slices(batches):
            prefix, bounds = units(b.column("text"))
            lists = b.column("open")
            flat = lists.flatten()
            n = np.asarray(pa.compute.list_value_length(lists).fill_null(0))
            doc = np.repeat(np.arange(len(n)), n)
            start = np.asarray(flat.field("start")).astype(np.int64)
            count = np.asarray(flat.field("count")).astype(np.int64)
            g = np.asarray(flat.field("g")).astype(np.int64)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            place = np.repeat(start, count) + step
            at = place + np.repeat(bounds[doc], count)
            ids = b.column("row_id").take(pa.array(np.repeat(doc, count)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(place, pa.int32()), _int64(prefix.of(at, at + length)), pa.array(np.repeat(g.astype(np.int32), count))], ["row_id", "place", "w", "g"])
    return docs.select("row_id", "text", "open").transform(in_batches, run, "row_id long, place int, w long, g int")


def repeated_ranges(docs: DataFrame, units: Units, length: int, gram: int, earlier_only: bool) -> DataFrame:
    """row_id, ranges: array of (first, last) window starts that repeat.

    ``docs`` are ``numbered`` rows. With ``earlier_only`` a window counts if
    its content also starts earlier (smaller row_id, or before it in the same
    row), else if it also starts anywhere else.
    """
    # Stored, so that both sides of the joins on g come from a shuffle and a hot g is split.
    grams = stored(span_table(docs, units, length, gram, only_gram=True).groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "grams", "zstd")
    held = stored(span_table(docs, units, length, gram).join(grams, "g", "left_semi"), "spans", "zstd")
    classes = stored(held.groupBy("g", "h").agg(F.count("*").alias("n"), F.min(F.struct("row_id", "start", "count")).alias("m")), "classes", "zstd")
    if earlier_only:
        sure = held.join(classes.where("n > 1").select("g", "h", "m"), ["g", "h"]).where(
            (F.col("row_id") != F.col("m.row_id")) | (F.col("start") != F.col("m.start")))
    else:
        sure = held.join(classes.where("n > 1").select("g", "h"), ["g", "h"], "left_semi")
    sure = sure.select("row_id", F.col("start").alias("a"), (F.col("start") + F.col("count") - 1).alias("b"))

    several = stored(classes.groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g"), "several", "zstd")
    ends = classes.join(several, "g", "left_semi").select("m.*", "g").groupBy("row_id").agg(
        F.collect_list(F.struct("start", "count", "g")).alias("open"))
    windows = stored(window_table(docs.join(ends, "row_id"), units, length, gram), "windows", "zstd")
    if earlier_only:
        same = windows.groupBy("g", "w").agg(F.count("*").alias("n"), F.min(F.struct("row_id", "place")).alias("m")).where("n > 1").drop("n")
        single = windows.join(same, ["g", "w"]).where((F.col("row_id") != F.col("m.row_id")) | (F.col("place") != F.col("m.place")))
    else:
        same = windows.groupBy("g", "w").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        single = windows.join(same, ["g", "w"], "left_semi")
    single = single.select("row_id", F.col("place").alias("a"), F.col("place").alias("b"))
    # Stored, so that the shuffles of these joins are gone when the texts are shuffled.
    return stored(sure.unionByName(single).groupBy("row_id").agg(F.collect_list(F.struct("a", "b")).alias("ranges")), "ranges", "zstd")


def runs_of(ranges: pa.Array, i: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered runs of units in row i of a ``ranges`` column."""
    v = ranges[i].values if ranges[i].is_valid else None
    if v is None or not len(v):
        e = np.zeros(0, dtype=np.int64)
        return e, e
    return cover.merge(np.asarray(v.field("a")).astype(np.int64), np.asarray(v.field("b")).astype(np.int64) + length)
