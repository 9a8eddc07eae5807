"""Removal of byte strings that occur more than once (operator 4).

Blockwise suffix sorting with a precomputed cover: the suffixes that matter
are those whose first 200 bytes repeat. A sparse cover of the text is ranked
first (spans of equal content are one rank); suffixes are then compared one
bucket at a time, and the long ties between copies are settled by the ranks
of the cover alone. The cover is chosen by content instead of by position
modulo a period (see README for why).

A null text is empty. Texts under 200 bytes never lose anything of
themselves. Rows that repeat a document whole count as copies of each other
(each is matched by the other's bytes); null and shared ids too, as rows are
told apart by numbers of their own. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import hashing as H
from cadenza.llm.common import in_batches, slices
from cadenza.llm.repeats import numbered, repeated_ranges, runs_of

LENGTH = 200
GRAM = 120


def byte_units(column: pa.Array) -> tuple[H.Prefix, np.ndarray]:
    t = H.texts_of(column)
    return H.Prefix(H.byte_values()[t.data]), t.offsets


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` (doc_id, text) with ``ranges``, the window starts that repeat, null if none."""
    docs = numbered(docs)
    return docs.join(repeated_ranges(docs, byte_units, length, gram, earlier_only=False), "row_id", "left").drop("row_id")


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    def run(batches):
        for b in slices(batches):
            t = H.texts_of(b.column("text"))
            ranges, out = b.column("ranges"), ([], [], [], [])
            for i in range(b.num_rows):
                data = t.data[t.offsets[i]:t.offsets[i + 1]]
                start, end = runs_of(ranges, i, length)
                keep = np.ones(len(data), dtype=bool)
                for s, e in zip(start, end, strict=True):
                    keep[s:e] = False
                kept = data[keep].tobytes() if len(start) else data.tobytes()
                for column, x in zip(out, (len(data), len(data) - len(kept), len(start), kept), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return repeated_bytes(docs, length, gram).transform(in_batches, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
