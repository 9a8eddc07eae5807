"""The corpus pipeline end to end, and what its stages keep."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cadenza.llm import decontaminate, mixing, near_dedup, token_files, toxicity
from cadenza.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    kept = corpus_pipeline.toxicity_stage(spark, docs, SF)
    assert kept.columns == columns
    toxic = {r.doc_id for r in toxicity.toxicity(docs, table(spark, SF, "labels")).where("predicted = 1").collect()}
    after_toxic = {r.doc_id for r in kept.collect()}
    assert after_toxic == set(rows) - toxic
    kept = corpus_pipeline.near_dedup_stage(spark, kept, SF)
    groups = near_dedup.near_duplicates(docs.where(F.col("doc_id").isin(sorted(after_toxic)))).collect()
    after_dedup = {r.doc_id for r in kept.collect()}
    assert kept.columns == columns and after_dedup == {r.doc_id for r in groups if r.doc_id == r.component_id}
    kept = corpus_pipeline.decontamination_stage(spark, kept, SF)
    bad = {r.doc_id for r in decontaminate.contamination(docs, table(spark, SF, "benchmark")).where("contaminated").collect()}
    after_clean = {r.doc_id for r in kept.collect()}
    assert kept.columns == columns and after_clean == after_dedup - bad
    mixed = corpus_pipeline.mixing_stage(spark, kept, SF)
    taken = Counter((r.doc_id, r.text) for r in mixed.collect())
    assert mixed.columns == columns and all(n <= 2 and rows[i].text == t for (i, t), n in taken.items())
    plan = mixing.mix(kept).select("source", "_mix_size", "_mix_target").collect()
    for source in {r.source for r in plan}:
        got = sum(n * len(mixing_words(t)) for (i, t), n in taken.items() if rows[i].source == source)
        largest = max(r["_mix_size"] for r in plan if r.source == source)
        assert abs(got - next(r["_mix_target"] for r in plan if r.source == source)) <= largest / 2 + 1


def mixing_words(text):
    import re
    return re.findall(mixing.WORD, text or "")


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    got = out.collect()
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    encoder = token_files.encoder(token_files.tokenizer_path())
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        ids = np.append(np.frombuffer(encoder.encode([docs[r.doc_id]])[0], dtype="<u2"), token_files.END_ID).astype("<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) > 0 and [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted(r.doc_id for r in got)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_of_awkward_rows(spark, name, stage):
    """Null and shared ids, null texts, extra columns, no rows."""
    docs = table(spark, SF, "documents").withColumn("size", F.lit(1)).withColumn("row_id", F.lit("x"))
    extra = spark.createDataFrame([(None, "one lone text"), (None, None), (0, "another row of id 0"), (0, "another row of id 0")], "doc_id long, text string")
    odd = docs.unionByName(extra, allowMissingColumns=True)
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns
    assert 0 < out.count() <= 2 * odd.count()
    assert stage(spark, odd.limit(0), SF).count() == 0
