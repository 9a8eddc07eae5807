"""Removal of word spans that occurred earlier (operator 6).

Relative Lempel-Ziv parsing against the corpus itself: every earlier text is
a reference block, indexed by the representatives of its windows (``cover``).
A document is factored into the spans of those representatives; a span whose
content an earlier block holds is a factor, and factors of 20 words or more
are duplicate spans (a span has at least 20 words). Windows at factor
boundaries, where the neighbouring text differs, are looked up one by one.

A null text has no words. For the order of rows with null or shared ids see
``remove_earlier_spans``. Extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import hashing as H
from cadenza.llm.common import in_batches, slices
from cadenza.llm.repeats import numbered, repeated_ranges, runs_of

LENGTH = 20
GRAM = 5


def word_units(column: pa.Array) -> tuple[H.Prefix, object]:
    t = H.texts_of(column)
    w = H.words_of(t, H.white_space())
    return H.Prefix(H.word_hashes(t, w, lower=False), H.WORD_STEP), w.first


def remove_earlier_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept (remaining words joined by one space).

    Rows are ordered by doc_id, null last, and rows that share an id by a hash
    of their text; of equal rows all but one lose what they repeat.
    """
    def run(batches):
        for b in slices(batches):
            t = H.texts_of(b.column("text"))
            w = H.words_of(t, H.white_space())
            ranges, words, removed, texts = b.column("ranges"), [], [], []
            for i in range(b.num_rows):
                data = t.data[t.offsets[i]:t.offsets[i + 1]].tobytes()
                first, last = w.first[i], w.first[i + 1]
                tokens = [data[s:e] for s, e in zip(w.start[first:last] - t.offsets[i], w.end[first:last] - t.offsets[i], strict=True)]
                start, end = runs_of(ranges, i, length)
                kept, at = [], 0
                for s, e in zip(start, end, strict=True):
                    kept += tokens[at:s]
                    at = e
                kept += tokens[at:]
                words.append(len(tokens))
                removed.append(len(tokens) - len(kept))
                texts.append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
    docs = numbered(docs)
    found = repeated_ranges(docs, word_units, length, gram, earlier_only=True)
    return docs.join(found, "row_id", "left").drop("row_id").transform(in_batches, run, "doc_id long, n_words long, n_removed long, kept string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_earlier_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
