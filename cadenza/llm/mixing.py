"""Mixing sources to target weights with DataFrame functions only (operator 1).

1. Every document's words are counted once; each source gets a target: its
   weight's share of ``total_share`` times all words, at most ``max_repeat``
   times its own words, the excess reshared among the others.
2. A source's documents lie in blocks by a hash of doc_id (a hot source has
   more blocks, not larger ones). Its target becomes block draws: all blocks
   once per full pass, then blocks in permuted order; the last block gives
   its first documents in permuted order, the last document its first words (the
   mix itself takes that document whole or not at all).
3. The draws of all sources are dealt to output shards by a multivariate
   hypergeometric splitting tree: each node hands its left half an exactly
   drawn number of every source's block draws. The permuted draws of a source
   are then cut along the leaves, so that shards hold disjoint blocks.
4. Inside a shard, documents are ordered by a hash of doc_id and pass.

All chances come from hashes of keys and a seed, so reruns agree. Null texts
have no words. A null source is a source of its own, the last. Rows that
repeat a doc_id share one place in their block and what it is given; null ids
likewise. Extra columns stay with their document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import stored, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_REPEAT = 2
BLOCK_DOCS = 256
SHARD_WORDS = 1 << 22
SEED = 20_011


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key() -> Column:
    """One non-null key per source; null has its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE, max_repeat: int = MAX_REPEAT, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row per source: key, rank, n_docs, source_size, target, blocks. Sources are few, so one window orders them."""
    per = sizes.groupBy("key").agg(F.first("source").alias("source"), F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    per = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    per = per.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("rank") % len(weights)).cast("double")).withColumn("most", max_repeat * F.col("source_size"))
    # Sources reach their cap in the order of cap per weight; the level is what a unit of weight gets once those before are full.
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.withColumn("level", (total_share * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(order), F.lit(0)))
                         / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0.0))))
    per = per.withColumn("level", F.max(F.when(F.col("most") > F.col("weight") * F.col("level"), F.col("level"))).over(everything))
    target = F.when(F.col("level").isNull(), F.col("most").cast("double")).otherwise(F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")))
    return per.select("key", "rank", "n_docs", "source_size", target.alias("target"), F.ceil(F.col("n_docs") / block_docs).cast("long").alias("blocks"))


def block_of(blocks: Column, seed: int = SEED) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "doc_id"), blocks)


def block_draws(sizes: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """key, rank, block, pass, words (of the block), take (of these): one row per block and pass that the mix draws from."""
    blocks = sizes.join(targets.select("key", "rank", "source_size", "target", "blocks"), "key").groupBy(
        "key", "rank", "source_size", "target", block_of(F.col("blocks"), seed).alias("block")).agg(F.sum("size").alias("words"))
    whole = F.floor(F.col("target") / F.col("source_size"))
    blocks = blocks.where("source_size > 0").withColumn("whole", whole).withColumn("rest", (F.round("target") - whole * F.col("source_size")).cast("long"))
    order = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(seed + 1), "block", "whole"), "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("part", F.least("words", F.greatest(F.lit(0), F.col("rest") - F.coalesce(F.sum("words").over(order), F.lit(0)))))
    draws = F.concat(F.transform(F.sequence(F.lit(1), F.col("whole").cast("int") + 1), lambda i: F.struct(
        (i - 1).alias("pass"), F.when(i <= F.col("whole"), F.col("words")).otherwise(F.col("part")).alias("take"))))
    return blocks.select("key", "rank", "block", "words", F.explode(draws).alias("d")).select("key", "rank", "block", "words", "d.*").where("take > 0")


def _hypergeometric(everything: str, marked: str, drawn: str, u: str) -> str:
    """SQL for how many of ``drawn`` are marked, by inverting the distribution at ``u`` (0-1).

    The terms follow from their ratios, over 12 standard deviations about the mean (what lies beyond is less than a double resolves)."""
    mean = f"({drawn} * {marked} / {everything})"
    reach = f"(12 * sqrt({mean} * (1 - {marked} / {everything}) + 1) + 2)"
    low = f"CAST(greatest(0D, {drawn} + {marked} - {everything}, floor({mean} - {reach})) AS BIGINT)"
    high = f"CAST(least({marked}, {drawn}, ceil({mean} + {reach})) AS BIGINT)"
    step = f"h.t * ({marked} - x) * ({drawn} - x) / ((x + 1D) * greatest({everything} - {marked} - {drawn} + x + 1D, 1D))"
    total = f"aggregate(sequence(b.lo, b.hi), named_struct('t', 1D, 'sum', 0D), (h, x) -> named_struct('t', {step}, 'sum', h.sum + h.t)).sum"
    below = f"""aggregate(sequence(b.lo, b.hi), named_struct('t', 1D, 'sum', 0D, 'k', 0L), (h, x) -> named_struct(
        't', {step}, 'sum', h.sum + h.t, 'k', h.k + IF(h.sum + h.t < c, 1L, 0L))).k"""
    # lo, hi and the cut through the sum of all terms are bound once each.
    pick = f"transform(array({u} * {total}), c -> least(b.hi, b.lo + {below}))[0]"
    return f"transform(array(named_struct('lo', {low}, 'hi', {high})), b -> {pick})[0]"


def deal(draws: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``draws`` with ``shard``, through the splitting tree. ``shards`` is a power of two."""
    quotas = draws.groupBy("rank").agg(F.count("*").alias("n"))
    node = quotas.agg(F.array_sort(F.collect_list(F.struct("rank", "n"))).alias("q")).select(F.lit(0).cast("long").alias("node"), "q")
    for level in range(shards.bit_length() - 1):
        u = lambda salt: f"(shiftrightunsigned(xxhash64({seed}L, {level}, node, {salt}), 11) / 9007199254740992D)"  # noqa: B023,E731
        split = _hypergeometric("a.n", "CAST(s.n AS DOUBLE)", "a.left", u("s.rank"))
        node = node.withColumn("n", F.expr("aggregate(q, 0D, (a, s) -> a + s.n)"))
        node = node.withColumn("half", F.expr(f"floor(n / 2) + IF(n % 2 = 1 AND {u('-1')} < 0.5, 1, 0)"))
        node = node.withColumn("lefts", F.expr(f"""aggregate(q, named_struct('n', n, 'left', CAST(half AS DOUBLE), 'got', CAST(array() AS ARRAY<BIGINT>)),
            (a, s) -> transform(array(IF(s.n = 0 OR a.left <= 0, 0L, {split})), x -> named_struct('n', a.n - s.n, 'left', a.left - x, 'got', array_append(a.got, x)))[0]).got"""))
        node = node.select(F.explode(F.expr("""array(
            named_struct('node', node * 2, 'q', zip_with(q, lefts, (s, x) -> named_struct('rank', s.rank, 'n', x))),
            named_struct('node', node * 2 + 1, 'q', zip_with(q, lefts, (s, x) -> named_struct('rank', s.rank, 'n', s.n - x))))""")).alias("c")).select("c.*")
    leaves = node.select(F.col("node").alias("shard"), F.explode("q").alias("s")).select("shard", "s.rank", "s.n").where("n > 0")
    end = F.sum("n").over(Window.partitionBy("rank").orderBy("shard"))
    slots = leaves.withColumn("end", end).select("shard", "rank", F.explode(F.sequence(F.col("end") - F.col("n") + 1, F.col("end"))).alias("slot"))
    order = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed + 2), "block", "pass"), "block", "pass")
    return draws.withColumn("slot", F.row_number().over(order).cast("long")).join(slots, ["rank", "slot"]).drop("slot")


def mix(docs: DataFrame, seed: int = SEED, shard_words: int = SHARD_WORDS, block_docs: int = BLOCK_DOCS, texts: bool = True, **how) -> DataFrame:
    """Every row of ``docs`` (only doc_id without ``texts``) with _mix_size, _mix_source_size, _mix_target and _mix_pieces.

    A piece is what one pass takes of a document: shard, position (the order
    inside the shard), pass and words (the first so many words of the text;
    all of them for a whole copy).
    """
    key = _source_key()
    sizes = stored(docs.select("doc_id", "source", key.alias("key"), n_words(F.col("text")).alias("size")), "mix-sizes")
    targets = stored(source_targets(sizes, block_docs=block_docs, **how), "mix-targets")
    draws = stored(block_draws(sizes, targets, seed), "mix-draws")
    total = draws.agg(F.sum("take")).first()[0] or 0
    shards = 1 << max(0, -(-int(total) // shard_words) - 1).bit_length()
    dealt = deal(draws, shards, seed)
    blocks = stored(dealt.groupBy("key", "block").agg(F.collect_list(F.struct("pass", "shard", F.when(F.col("take") < F.col("words"), F.col("take")).alias("cut"))).alias("draws")), "mix-blocks")

    # Cut blocks, one a source at most: which documents, and how far into the last.
    cut = blocks.select("key", "block", F.explode("draws").alias("d")).where("d.cut IS NOT NULL").select("key", "block", "d.pass", "d.cut")
    placed = sizes.join(targets.select("key", "blocks"), "key").select("key", block_of(F.col("blocks"), seed).alias("block"), "doc_id", "size")
    unit = placed.join(cut, ["key", "block"]).groupBy("key", "block", "pass", "cut", "doc_id").agg(F.sum("size").alias("size"), F.count("*").alias("copies"))
    order = Window.partitionBy("key", "block").orderBy(F.xxhash64(F.lit(seed + 3), "doc_id", "pass"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    given = F.least("size", F.greatest(F.lit(0), F.col("cut") - F.coalesce(F.sum("size").over(order), F.lit(0))))
    given = stored(unit.select("key", "doc_id", F.floor(given / F.col("copies")).alias("given")), "mix-cuts")

    rows = docs.withColumns({"_mix_key": key, "_mix_size": n_words(F.col("text"))}) if texts else sizes.select("doc_id", F.col("key").alias("_mix_key"), F.col("size").alias("_mix_size"))
    return _with_pieces(rows, targets, blocks, given, seed)


def _with_pieces(rows: DataFrame, targets: DataFrame, blocks: DataFrame, given: DataFrame, seed: int) -> DataFrame:
    """Join the plan of the mix to rows that have doc_id, _mix_key and _mix_size, under names of its own."""
    t = targets.select(F.col("key").alias("_mix_key"), F.col("source_size").alias("_mix_source_size"), F.col("target").alias("_mix_target"), F.col("blocks").alias("_mix_blocks"))
    b = blocks.select(F.col("key").alias("_mix_key"), F.col("block").alias("_mix_block"), F.col("draws").alias("_mix_draws"))
    g = given.select(F.col("key").alias("_mix_gk"), F.col("doc_id").alias("_mix_gid"), F.col("given").alias("_mix_given"))
    rows = rows.join(t, "_mix_key").withColumn("_mix_block", block_of(F.col("_mix_blocks"), seed)).join(b, ["_mix_key", "_mix_block"], "left")
    rows = rows.join(g, (F.col("_mix_gk") == F.col("_mix_key")) & F.col("_mix_gid").eqNullSafe(F.col("doc_id")), "left")
    pieces = F.filter(F.transform(F.coalesce("_mix_draws", F.array().cast(dict(b.dtypes)["_mix_draws"])), lambda d: F.struct(
        d["shard"].alias("shard"), F.xxhash64(F.lit(seed + 4), "doc_id", d["pass"]).alias("position"), d["pass"].alias("pass"),
        F.when(d["cut"].isNull(), F.col("_mix_size")).otherwise(F.least(F.coalesce("_mix_given", F.lit(0)), F.col("_mix_size"))).alias("words"))), lambda p: p["words"] > 0)
    return rows.withColumn("_mix_pieces", pieces).drop("_mix_key", "_mix_block", "_mix_blocks", "_mix_draws", "_mix_gk", "_mix_gid", "_mix_given")


def taken_words() -> Column:
    return F.aggregate("_mix_pieces", F.lit(0).cast("long"), lambda a, p: a + p["words"])


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: rows like ``docs``, one per piece, shard by shard in shuffled order.

    Texts stay whole: the one document a source and run of which the plan takes
    the first words comes whole if these are at least half of it, else not at
    all, so a source misses its target by half of that document at most.
    """
    rows = mix(docs, seed).withColumn("_mix_piece", F.explode("_mix_pieces")).where(2 * F.col("_mix_piece.words") >= F.col("_mix_size"))
    return rows.repartition("_mix_piece.shard").sortWithinPartitions("_mix_piece.shard", "_mix_piece.position").select(*docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), texts=False).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
        taken_words().alias("taken"), F.transform("_mix_pieces", lambda p: p["shard"]).alias("shards"))
