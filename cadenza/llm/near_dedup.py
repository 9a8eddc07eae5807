"""MinHash near-duplicate groups from bottom-k sketches (operator 5).

One hash function ranks the word shingles of a document; its ``k`` smallest
hashes are the sketch. Inverted lists of the retained values give the
candidates, the sketch of the union estimates each one's similarity, and the
full shingle sets confirm what remains.

Documents with one shingle set are folded into one node first, so exact
copies never meet in a list. No list emits all its pairs:

1. Lists of the same members say the same and count as one. Lists over ``LONG_LIST`` members (a line or passage that many documents
   share) are set aside. Two linked documents share at least a quarter of
   their union outside them, and so meet in a short list, unless half or more
   of both sketches lies in long lists. Such documents, the crowd, meet by the
   shingles of their full sets that fewest of the crowd have (an exact prefix
   filter), so common matter opens no lists for them either.
2. In turns, the members of a list are compared with a few pivots, and
   confirmed links are joined to components. A list that one component holds
   entirely is done. A group of copies becomes one component after few turns,
   whatever its size.
3. Once the rest is small (``WORK`` pairs a member), the members outside a
   list's largest component are compared with all that lie in others. After
   ``TURNS`` turns this is done whatever the rest, so no link is lost.

With k = 48 a linked pair shares no retained value with probability below
0.25**48, and none in a short list with probability below 0.75**48 (1e-6)
where nearly half of a sketch is common matter. The union estimate keeps all
that lie within 6 standard deviations.

A document is a row, whatever its id: rows are numbered in the order of their
ids (null last) and compared, joined and dropped by number. Of a group of linked
rows the first is kept, and its doc_id is the group's component_id (null if no
row of the group has an id). Null or empty texts have no shingles and are linked
with nothing. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import hashing as H
from cadenza.llm.common import by_ids, in_batches, slices, stored, unused
from cadenza.llm.graph import components

SHINGLE = 5
THRESHOLD = 0.75
K = 48
PARITY = 512  # bits
LONG_LIST = 16
PIVOTS = 4
TURNS = 3
WORK = 8  # pairs a member that the last turn may form without another turn of pivots
MARGIN = 6 * (0.75 * 0.25 / K) ** 0.5


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    t = H.texts_of(column)
    w = H.words_of(t, H.white_space())
    hashes = H.word_hashes(t, w, lower=True)
    n = np.diff(w.first)
    prefix = H.Prefix(hashes, H.WORD_STEP)
    at = np.arange(max(0, len(hashes) - width + 1))
    full = prefix.of(at, at + width)
    for i, first in enumerate(w.first[:-1]):
        if n[i] >= width:
            yield np.unique(full[first:first + n[i] - width + 1])
        elif n[i]:
            yield prefix.of(np.array([first]), np.array([first + n[i]]))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _sketches(k: int, width: int):
    import hashlib

    def run(batches):
        for b in slices(batches):
            sizes, prints, sketches, parities = [], [], [], []
            for s in shingle_sets(b.column("text"), width):
                sizes.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sketches.append((s[:k] >> np.uint64(1)).view(np.int64))  # 63 bits, so that Spark orders them as they are
                odd = np.bincount((s & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
                parities.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(sketches, pa.list_(pa.int64())), pa.array(parities, pa.list_(pa.int64()))],
                                             ["doc_id", "row_id", "n_shingles", "print", "sketch", "parity"])
    return run


def rows_of(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that numbers its rows in the order of doc_id, null last, and that column's name.

    Unique ids number their rows themselves. With null or shared ids the rows
    are sorted and stored with their numbers; rows of one id stand in any order.
    """
    name = unused(docs, "row_id")
    ids = docs.select("doc_id")
    if ids.where("doc_id IS NULL").isEmpty() and ids.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.withColumn(name, F.col("doc_id")), name
    # The number of the row as it was read deals rows of one id out to several parts.
    order = [F.col("doc_id").asc_nulls_last(), name]
    rows = docs.withColumn(name, F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def sketch(docs: DataFrame, k: int = K, width: int = SHINGLE) -> DataFrame:
    """doc_id, row_id, n_shingles, print (digest of the whole set, null if empty), sketch, parity."""
    return docs.select("doc_id", "row_id", "text").transform(
        in_batches, _sketches(k, width), "doc_id long, row_id long, n_shingles long, print binary, sketch array<long>, parity array<long>")


def full_sets(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """row_id and its whole shingle set."""
    def run(batches):
        for b in slices(batches):
            sets = [s.view(np.int64) for s in shingle_sets(b.column("text"), width)]
            yield pa.RecordBatch.from_arrays([b.column("row_id"), pa.array(sets, pa.list_(pa.int64()))], ["row_id", "shingles"])
    return docs.select("row_id", "text").transform(in_batches, run, "row_id long, shingles array<long>")


def union_estimate(a: Column, b: Column, k: int = K) -> Column:
    """Share of the union's bottom-k sketch that both sketches retain."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    return F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union)


def _may_link(n: str, m: str, p: str, q: str, threshold: float) -> Column:
    """False only for pairs that cannot be linked, by set sizes and parities.

    ``parity`` has a bit for each residue of the shingle hashes, set where an
    odd number of shingles has it. Every shingle that one set lacks flips one
    bit, so the bits that differ bound the sets' difference from below.
    """
    differ = sum((F.bit_count(F.get(p, F.lit(i)).bitwiseXOR(F.get(q, F.lit(i)))) for i in range(PARITY // 64)), F.lit(0))
    return (F.least(n, m) >= F.greatest(n, m) * F.lit(threshold)) & (differ <= (F.col(n) + F.col(m)) * F.lit((1 - threshold) / (1 + threshold)) + F.lit(1e-6))


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, threshold: float, k: int, width: int) -> DataFrame:
    """Links (a, b) among candidate ``pairs``: union-sketch filter, then the full sets."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("sketch").alias(f"sketch_{c}"))
    near = stored(pairs.join(side("a"), "a").join(side("b"), "b")
                  .where(union_estimate(F.col("sketch_a"), F.col("sketch_b"), k) >= threshold - MARGIN).select("a", "b"), "near")
    wanted = stored(near.select(F.explode(F.array("a", "b")).alias("row_id")).distinct(), "wanted")
    sets = stored(full_sets(by_ids(docs, wanted, "left_semi", "row_id"), width), "sets")
    side = lambda c: sets.select(F.col("row_id").alias(c), F.col("shingles").alias(f"set_{c}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return near.join(side("a"), "a").join(side("b"), "b").where(
        100 * both >= F.lit(round(100 * threshold)) * (F.size("set_a") + F.size("set_b") - both)).select("a", "b")


def _rarest(docs: DataFrame, crowd: DataFrame, threshold: float, width: int) -> DataFrame:
    """v, node, n, rest: of each crowd document the n - ceil(threshold n) + 1 shingles that
    fewest of the crowd have, and how many it has from there on in that order. Two linked
    documents share one of them, and no more shingles than the rest from the first on."""
    sets = stored(full_sets(by_ids(docs, crowd, "left_semi", "row_id"), width), "crowd-sets")
    each = sets.select(F.col("row_id").alias("node"), F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("v"))
    counts = each.groupBy("v").agg(F.count("*").alias("c"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("c", "v"))
    return each.join(counts, "v").withColumn("place", place).where(
        (F.col("place") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1) & (F.col("c") > 1)).select(
        "v", "node", "n", (F.col("n") - F.col("place") + 1).alias("rest"))


def _different(posts: DataFrame) -> DataFrame:
    """``posts`` (v, node, n, rest) with one list in place of all that have the same members, and the longest rests of these.

    The shingles of a passage that some documents share make as many equal lists.
    Equal are lists of one size whose members' hashes agree in 128 bits.
    """
    marks = posts.groupBy("v").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    return posts.join(marks, "v").groupBy("c", "x", "y", "node").agg(F.min("v").alias("v"), F.max("rest").alias("rest"), F.first("n").alias("n")).select("v", "node", "n", "rest")


def _mixed_lists(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """v, node, n, component, largest (component of most members), others (members outside it) of the lists that several components share."""
    if found is None:
        placed = members.withColumn("component", F.col("node"))
    else:
        placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    held = placed.groupBy("v", "component").agg(F.count("*").alias("c")).groupBy("v").agg(
        F.count("*").alias("groups"), F.max_by("component", F.struct("c", "component")).alias("largest"), (F.sum("c") - F.max("c")).alias("others")).where("groups > 1")
    return placed.join(held.drop("groups"), "v")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _to_pivots(mixed: DataFrame, turn: int, threshold: float) -> DataFrame:
    """Every member of a mixed list with one member of another component; lists
    of one group mostly agree on it, so a turn adds few pairs a document."""
    order = F.xxhash64(F.lit(turn), F.pmod("v", F.lit(PIVOTS)), "node")
    pivots = mixed.groupBy("v").agg(F.min(F.struct(order, "node", "n", "component", "parity")).alias("p"))
    return mixed.join(pivots, "v").where("component <> p.component").where(_may_link("n", "p.n", "parity", "p.parity", threshold)).select(*_pair("node", "p.node")).distinct()


def _across(mixed: DataFrame, threshold: float) -> DataFrame:
    """All pairs of a list whose components differ."""
    left = mixed.where("component <> largest").select("v", F.col("node").alias("x"), F.col("n").alias("xn"), F.col("rest").alias("xr"), F.col("component").alias("xc"), F.col("parity").alias("xp"))
    right = mixed.select("v", F.col("node").alias("y"), F.col("n").alias("yn"), F.col("rest").alias("yr"), F.col("component").alias("yc"), F.col("parity").alias("yp"))
    # At the first shingle that two linked documents share, both have this many left.
    enough = F.least("xr", "yr") >= (F.col("xn") + F.col("yn")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-6)
    return left.join(right, "v").where("xc <> yc").where(enough & _may_link("xn", "yn", "xp", "yp", threshold)).select(*_pair("x", "y")).distinct()


def _labelled(docs: DataFrame, threshold: float, k: int, width: int, long_list: int) -> DataFrame:
    """doc_id, row_id, n_shingles, component (first row of the group), component_id, n_copies of rows with a ``row_id``."""
    rows = stored(sketch(docs, k, width), "sketch")
    some = rows.where("n_shingles > 0")
    nodes = stored(some.groupBy("print").agg(F.min(F.struct("row_id", "doc_id", "n_shingles", "sketch", "parity")).alias("m"), F.count("*").alias("n_copies"))
                   .select("print", "n_copies", F.col("m.row_id").alias("node"), F.col("m.doc_id").alias("doc_id"), F.col("m.n_shingles").alias("n"), F.col("m.sketch").alias("sketch"), F.col("m.parity").alias("parity")), "nodes")
    posts = nodes.select("node", "n", F.explode("sketch").alias("v"))
    lists = posts.groupBy("v").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(posts.join(lists, "v"), "members")
    hot = members.where(F.col("size") > long_list).groupBy("node").agg(F.count("*").alias("n_long"))
    crowd = stored(nodes.join(hot, "node").where(2 * F.col("n_long") >= F.least("n", F.lit(k))).select(F.col("node").alias("row_id")), "crowd")
    short = members.where(F.col("size") <= long_list).select("v", "node", "n", F.col("n").alias("rest"))
    posts = stored(short.unionByName(_rarest(docs, crowd, threshold, width)), "posts")
    members = stored(_different(posts).join(nodes.select("node", "parity"), "node"), "lists")
    bound = WORK * members.count()
    found = tried = None
    for turn in range(TURNS):
        mixed = stored(_mixed_lists(members, found), "mixed")
        work = mixed.agg(F.sum("others")).first()[0] or 0  # members of a list times those outside its largest component
        last = work <= bound or turn == TURNS - 1
        pairs = _across(mixed, threshold) if last else _to_pivots(mixed, turn, threshold)
        pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        new = verified(docs, nodes, pairs, threshold, k, width)
        # What is joined already is as good as its stars.
        links = stored(new if found is None else new.unionByName(found.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))), "links")
        found = stored(components(links), "found")
        if last:
            break

    groups = nodes.where("n_copies > 1").join(found, "node", "full").select(
        "node", F.coalesce("component", "node").alias("component"))
    first = nodes.select(F.col("node").alias("component"), F.col("doc_id").alias("component_id"))
    labels = nodes.select("print", "node", "n_copies").join(groups, "node").join(first, "component").select("print", "component", "component_id", "n_copies")
    out = rows.join(labels, "print", "left")
    alone = F.col("component").isNull()
    return out.select("doc_id", "row_id", "n_shingles", F.coalesce("component", "row_id").alias("component"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, k: int = K, width: int = SHINGLE,
                    long_list: int = LONG_LIST) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id), n_copies (rows with the same set), kept, of every row."""
    rows, name = rows_of(docs.select("doc_id", "text"))
    out = _labelled(rows.withColumnRenamed(name, "row_id"), threshold, k, width, long_list)
    return out.select("doc_id", "n_shingles", "component_id", "n_copies", (F.col("row_id") == F.col("component")).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that the first of their linked rows replaces; all columns stay."""
    rows, name = rows_of(docs)
    labels = _labelled(rows.select("doc_id", "text", F.col(name).alias("row_id")), THRESHOLD, K, SHINGLE, LONG_LIST)
    gone = stored(labels.where("row_id <> component").select(F.col("row_id").alias(name)), "gone")
    return by_ids(rows, gone, "left_anti", name).select(*docs.columns)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
