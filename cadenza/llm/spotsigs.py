"""Document fingerprints by SpotSigs, with DataFrame functions only (operator 10).

An anchor is a common word of a fixed list; its signature is the anchor with
the two content words that follow, skipping further anchors. A document's
fingerprint is its set of signatures. Fingerprints are compared by the Jaccard
likeness of these sets; sets whose lengths rule a likeness out are never
compared (``similar_pairs``: partitions by set length).

A text without anchors is fingerprinted by its chains of three words, one
without words by itself as a whole; a null or empty text has the empty
fingerprint. Two empty sets have likeness 1, an empty and another 0.

Documents follow each other by doc_id, null last; rows that share a doc_id
follow each other by a hash of their text. After the last comes the first. An
empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import stored, table

# Fixed list: common words of English, German, French and Spanish.
COMMON = ("the of and to in is was it that for on are as with be this at from by or an "
          "der die das und ist nicht mit ein eine von zu auf für sich den im des "
          "le la les de des est et un une dans que pour en sur pas avec par "
          "el los las y del que por una con para como su al se no").split()
CHAIN = 2
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKET = 64  # documents that look for their successor together
TOP = 4096  # buckets that look for theirs together
LENGTH_STEP = 0.75


def _short(h: Column) -> Column:
    return h.bitwiseAND(F.lit(0xFFFFFFFF))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda reads it again and again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def signature_set(text: str) -> Column:
    """Sorted distinct 32-bit signatures of column ``text``."""
    common = sorted(set(COMMON))
    raw = F.coalesce(F.col(text), F.lit(""))

    def chains(words: Column) -> Column:
        # The j-th anchor, at place i, has i - j content words before it.
        anchors = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(common))
        content = F.filter(words, lambda w: ~w.isin(common))
        nth = lambda c, i: F.coalesce(F.get(c, i), F.lit(""))
        return _let(content, lambda c: F.transform(anchors, lambda i, j: _short(F.xxhash64(F.get(words, i), *(nth(c, i - j + k) for k in range(CHAIN))))))

    def plain(words: Column) -> Column:
        word = lambda i: F.coalesce(F.get(words, i), F.lit(""))
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))), lambda i: _short(F.xxhash64(word(i), word(i + 1), word(i + 2))))

    def of(words: Column) -> Column:
        return (F.when(F.exists(words, lambda w: w.isin(common)), chains(words)).when(F.size(words) > 0, plain(words))
                .when(raw != "", F.array(_short(F.xxhash64(raw)))).otherwise(F.array().cast("array<bigint>")))
    words = F.filter(F.split(F.lower(raw), GAP), lambda w: w != "")
    return F.array_sort(F.array_distinct(_let(words, of)))


def as_text(signatures: str) -> Column:
    """Fingerprint as a string: eight hex digits a signature."""
    return F.array_join(F.transform(signatures, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two signature sets; an empty set needs no comparison."""
    both = F.size(F.array_intersect(a, b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(both / (F.size(a) + F.size(b) - both)))


def length_class(signatures: str) -> Column:
    """Partition by set length: sets two classes apart differ in length by more than LENGTH_STEP allows."""
    return F.when(F.size(signatures) > 0, F.floor(F.log(F.size(signatures).cast("double")) / -F.log(F.lit(LENGTH_STEP)))).otherwise(F.lit(-1)).cast("int")


def similar_pairs(prints: DataFrame, threshold: float = LENGTH_STEP) -> DataFrame:
    """a, b, likeness of all documents whose sets are at least ``threshold`` (0.75 or more) alike.

    ``prints`` has doc_id (unique) and signatures. Documents with one set are
    compared once, by their smallest doc_id (``a`` and ``b`` stand for their
    class). Two alike sets lie in one length class or in neighbouring ones and
    share one of their rarest signatures (the first n - ceil(t n) + 1 by
    corpus frequency), so common signatures open no lists; candidates are
    pruned by length before their sets are compared.
    """
    if threshold < LENGTH_STEP:
        raise ValueError("length classes hold for thresholds of 0.75 or more")
    prints = stored(prints, "spot-prints").where(F.size("signatures") > 0)
    sets = stored(prints.groupBy("signatures").agg(F.min("doc_id").alias("d")), "spot-sets")
    counts = sets.select(F.explode("signatures").alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    listed = sets.select("d", F.size("signatures").alias("size"), length_class("signatures").alias("class"), F.explode("signatures").alias("s")).join(counts, "s")
    rare = F.row_number().over(Window.partitionBy("d").orderBy("n", "s"))
    heads = stored(listed.withColumn("r", rare).where(F.col("r") <= F.col("size") - F.ceil(F.lit(threshold) * F.col("size")) + 1).where("n > 1"), "spot-heads")
    left = heads.select(F.col("d").alias("a"), F.col("size").alias("na"), "s", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class"))
    right = heads.select(F.col("d").alias("b"), F.col("size").alias("nb"), "s", "class")
    near = left.join(right, ["s", "class"]).where("a < b").where(F.least("na", "nb") >= threshold * F.greatest("na", "nb")).select("a", "b").distinct()
    side = lambda c: sets.select(F.col("d").alias(c), F.col("signatures").alias(f"set_{c}"))
    return near.join(side("a"), "a").join(side("b"), "b").select("a", "b", likeness("set_a", "set_b").alias("likeness")).where(F.col("likeness") >= threshold)


def with_next_text(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), next_text: the text of the document that follows.

    Documents look for their successor inside buckets of neighbouring ids, so
    one shuffle of the texts serves all; only the first document of each
    bucket travels to the bucket before.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    span = base.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, high = span["low"] or 0, span["high"] or 0
    width = max(1, -(-(high - low + 1) * BUCKET // max(span["n"], 1)))
    # Null ids follow the last id, in a bucket of their own.
    place = F.coalesce(F.floor((F.col("doc_id") - F.lit(low)) / F.lit(width)), F.lit((high - low) // width + 1)).cast("long")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    rows = base.withColumn("bucket", place)
    inner = rows.withColumn("next_text", F.lead("text").over(Window.partitionBy("bucket").orderBy(*order)))

    buckets = stored(rows.groupBy("bucket").agg(F.min("doc_id").alias("first_id")), "buckets")
    upper = F.floor(F.col("bucket") / TOP)
    after = buckets.withColumn("top", upper).withColumn("after", F.lead("bucket").over(Window.partitionBy("top").orderBy("bucket")))
    tops = buckets.groupBy(upper.alias("top")).agg(F.min("bucket").alias("begins"))
    tops = tops.withColumn("next_top", F.lead("begins").over(Window.orderBy("top"))).withColumn("begin", F.min("begins").over(Window.partitionBy()))
    after = after.join(tops, "top").select("bucket", F.coalesce("after", "next_top", "begin").alias("after"))
    first = rows.join(buckets, "bucket").where(F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("bucket").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("first_text"))
    edge = after.join(first.withColumnRenamed("bucket", "after"), "after").select("bucket", "first_text")
    return inner.join(edge, "bucket").select("doc_id", "text", F.coalesce("next_text", "first_text").alias("next_text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, signatures of every row of ``docs``."""
    return docs.select("doc_id", signature_set("text").alias("signatures"))


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its text with the last half replaced by
    the beginning of the next document, and their likenesses."""
    rows = with_next_text(docs).withColumn("n_chars", F.char_length("text").cast("long")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - F.col("half")), F.substr("next_text", F.lit(1), F.col("half"))))
    rows = rows.withColumns({"own": signature_set("text"), "changed": signature_set("edited"), "following": signature_set("next_text")})
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text("own").alias("fingerprint"),
                       as_text("changed").alias("edited_fingerprint"), likeness("own", "changed").alias("near_edited"),
                       likeness("own", "following").alias("near_next"), length_class("own").alias("length_class"))


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_with_edits(table(spark, sf_dir, "documents"))
