"""Source divergence audit (operator 11): how the vocabulary of each source of a
language departs from the other sources and from the language.

*Counting.* A slice of texts is one byte array. Terms (maximal runs of letters
and of bytes above ASCII, A-Z lower-cased) are packed by length: up to 8 bytes
into one uint64, up to 16 into two, big-endian, so that numbers order as bytes
do; they are radix-sorted by 16-bit digits, with the group as the last digit,
and runs of equal terms are counted, documents too. Longer terms are sorted as
bytes, in buckets of lengths up to 32, 64, 128 and so on. Spark adds up the
counts of slices, by group and term: whatever share of the rows a source holds,
a slice hands on each of its terms once.

*Comparison.* A language keeps the V terms in at least ``MIN_DOCS`` of its
documents. p = 1 + floor(1e9 (count + 2) / (N + 2 V)) of each group and of the
language, in integers throughout. A kept term is one row with the p of the
sources that hold it; a task adds up f for ``TILE`` sources against all others
and hands on its sums, so no pair of rows is ever made. Its memory is TILE times
the number of a language's sources, whose square is the size of the result.

Null text, lang or source is ''. A group without terms has N = 0; a language
that keeps no term has pairs of value 0 and no terms. Repeated rows count each
time, shared or null doc_ids do not matter (a row is a document), ties go to the
smaller item, extra columns are ignored and an empty table gives no rows. Counts
and kept terms are stored tables, so a lost executor costs the tasks it ran.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import in_batches, slices, stored, table

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
TILE = 64  # sources that a task compares with all others at a time
SLICE = 4 << 20  # bytes of text counted in one pass

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 0x41) & (_BYTE <= 0x5A)
IS_TERM = _UPPER | (_BYTE >= 0x61) & (_BYTE <= 0x7A) | (_BYTE >= 0x80)
LOWER = np.where(_UPPER, _BYTE + 32, _BYTE).astype(np.uint8)


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The stable order by ``keys`` (unsigned, the most significant first): one pass for each 16-bit digit that varies."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if digit.size and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_counts(keys: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted ``keys``: where each run begins, its length, and how many distinct (ascending) documents it has."""
    change = np.ones(len(docs), dtype=bool)
    change[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    new_doc = change.copy()
    new_doc[1:] |= docs[1:] != docs[:-1]
    begins = np.flatnonzero(change)
    return begins, np.diff(np.append(begins, len(docs))), np.add.reduceat(new_doc.astype(np.int64), begins)


def count_terms(texts: list[str], groups: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """For each length bucket: group, term, occurrences and documents of every distinct (group, term) of ``texts``."""
    joined = ("\0".join(texts) + "\0" * 16).encode()
    data = np.frombuffer(joined, dtype=np.uint8)
    starts = np.cumsum([0, *(len(t.encode()) + 1 for t in texts[:-1])])
    edges = np.flatnonzero(np.diff(IS_TERM[data], prepend=False))
    at, size = edges[::2], edges[1::2] - edges[::2]
    doc = np.searchsorted(starts, at, "right") - 1
    group = groups[doc].astype(np.uint32)
    lower = LOWER[data]
    word_at = np.ndarray((max(len(lower) - 7, 0),), dtype=">u8", buffer=lower, strides=(1,))

    def words(places, sizes):
        """The ``sizes`` (1 to 8) bytes at ``places``, as numbers that order as the bytes do."""
        rest = (64 - 8 * sizes).astype(np.uint64)
        return word_at[places].astype(np.uint64) >> rest << rest

    def counted(keys, of, terms):
        order = radix_order(keys)
        keys, docs = [k[order] for k in keys], doc[of][order]
        begins, n, n_docs = run_counts(keys, docs)
        return keys[0][begins], terms([k[begins] for k in keys[1:]]), n, n_docs

    short = np.flatnonzero(size <= 8)
    if short.size:
        yield counted([group[short], words(at[short], size[short])], short,
                      lambda k: k[0].astype(">u8").view("S8").tolist())
    middle = np.flatnonzero((size > 8) & (size <= 16))
    if middle.size:
        yield counted([group[middle], words(at[middle], np.full(middle.size, 8)), words(at[middle] + 8, size[middle] - 8)], middle,
                      lambda k: np.stack(k, axis=1).astype(">u8").view("S16").ravel().tolist())
    small = lower.tobytes()
    width = 32
    while (left := np.flatnonzero(size > width // 2)).size:
        of = left[size[left] <= width]
        if of.size:
            terms = np.array([small[a:a + n] for a, n in zip(at[of].tolist(), size[of].tolist(), strict=True)], dtype=f"S{width}")
            order = np.argsort(terms, kind="stable")
            order = order[np.argsort(group[of][order], kind="stable")]
            keys = [group[of][order], terms[order]]
            begins, n, n_docs = run_counts(keys, doc[of][order])
            yield keys[0][begins], keys[1][begins].tolist(), n, n_docs
        width *= 2


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: partial counts, one of each slice."""
    def run(batches):
        for b in slices(batches, limit=SLICE):
            pair = pa.StructArray.from_arrays([b.column("lang"), b.column("source")], ["lang", "source"])
            number: dict[tuple, int] = {}
            groups = np.array([number.setdefault((p["lang"], p["source"]), len(number)) for p in pair.to_pylist()])
            names = [pa.array(x, pa.string()) for x in zip(*number, strict=True)]
            for group, terms, n, n_docs in count_terms(b.column("text").to_pylist(), groups):
                of = pa.array(group.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [names[0].take(of), names[1].take(of), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(n_docs, pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
    return docs.transform(in_batches, run, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column) -> Column:
    """1 + floor(1e9 (count + 2) / total) for count + 2 <= total, three digits at a time, so that
    nothing overflows while a total is below 9e15."""
    value, rest = F.lit(1).cast("long"), count + 2
    for unit in (SCALE // 10**3, SCALE // 10**6, 1):
        value = value + F.call_function("div", rest * 1000, total) * unit
        rest = rest * 1000 % total
    return value


def pair_sums(rows: DataFrame) -> DataFrame:
    """lang, g, h, value: f added up over ``rows`` (lang, tile, p0, places, p), for each source g of a tile and every other one h."""
    def run(batches):
        sums: dict[tuple[str, int], np.ndarray] = {}
        for b in batches:
            for lang, tile, p0, places, p in zip(*(b.column(c) for c in ("lang", "tile", "p0", "places", "p")), strict=True):
                all_p = p0.values.to_numpy().copy()
                all_p[places.values.to_numpy()] = p.values.to_numpy()
                own = all_p[tile.as_py() * TILE:(tile.as_py() + 1) * TILE, None]
                f = (own - all_p) ** 2 // (own + all_p)
                key = lang.as_py(), tile.as_py()
                if key in sums:
                    sums[key] += f
                else:
                    sums[key] = f
        for (lang, tile), total in sums.items():
            g, h = np.indices(total.shape)
            g += tile * TILE
            of = g != h
            yield pa.RecordBatch.from_arrays([pa.array([lang] * int(of.sum()), pa.string()), pa.array(g[of], pa.int64()), pa.array(h[of], pa.int64()), pa.array(total[of], pa.int64())],
                                             ["lang", "g", "h", "value"])
    return rows.select("lang", "tile", "p0", "places", "p").transform(in_batches, run, "lang string, g long, h long, value long").groupBy(
        "lang", "g", "h").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank (see the module's head) of ``docs`` (text, lang, source)."""
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")))
    counts = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # At most one entry a source of the language.
    kept = stored(counts.groupBy("lang", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("of")
    ).where(F.col("docs") >= min_docs).select("lang", "term", "n", "of"), "kept-terms")
    each = kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("of").alias("s")).select("lang", "term", "lang_n", "s.source", "s.n")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = stored(
        docs.select("lang", "source").distinct()
        .join(each.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", F.coalesce("v", F.lit(0)).cast("long").alias("v"),
                (F.coalesce("total", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).cast("long").alias("total"),
                (F.coalesce("lang_total", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).cast("long").alias("lang_total"),
                (F.row_number().over(by_source) - 1).cast("long").alias("place")), "groups")
    shares = each.join(groups, ["lang", "source"]).select(
        "lang", "term", "source", "place", share(F.col("n"), F.col("total")).alias("p"), share(F.col("lang_n"), F.col("lang_total")).alias("q"))

    f = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), f.alias("value")).withColumn(
        "rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    # The p of a term that a source does not hold; 1 for all where the language keeps none, so that every f is 0.
    p0 = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.greatest("total", F.lit(2)))).otherwise(F.lit(1).cast("long"))
    absent = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", p0.alias("p0")))).alias("all"), F.max("v").alias("v")).select(
        "lang", "v", F.col("all.p0").alias("p0"))
    none = F.array().cast("array<long>")
    vectors = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "p")).alias("of")).join(absent, "lang").select(
        "lang", "p0", F.col("of.place").alias("places"), F.col("of.p").alias("p"))
    equal = absent.select("lang", F.transform("p0", lambda _: F.lit(1).cast("long")).alias("p0"), none.alias("places"), none.alias("p"))
    tiles = F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.size("p0") - 1, F.lit(TILE))))
    sums = pair_sums(vectors.unionByName(equal).withColumn("tile", tiles))
    name = groups.select("lang", "source", "place")
    pairs = sums.join(name.withColumnRenamed("place", "g"), ["lang", "g"]).join(
        name.select("lang", F.col("place").alias("h"), F.col("source").alias("item")), ["lang", "h"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(ranked))
    return pairs.unionByName(terms)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
word AS (SELECT d, lang, source, unnest(ts) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
own AS (SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
tally AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
grp AS (SELECT lang, source, coalesce(sum(own.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN own USING (lang, source) GROUP BY ALL),
p AS (SELECT grp.lang, grp.source, kept.term, coalesce(own.n, 0) AS n, 1 + (1000000000 * (coalesce(own.n, 0) + 2)::HUGEINT) // (grp.n + 2 * tally.v)::HUGEINT AS p,
    1 + (1000000000 * (kept.n + 2)::HUGEINT) // (tally.n + 2 * tally.v)::HUGEINT AS q
    FROM grp JOIN tally USING (lang) JOIN kept USING (lang) LEFT JOIN own ON own.lang = grp.lang AND own.source = grp.source AND own.term = kept.term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(f), 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang AS g, x.source AS s1, y.source AS s2, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS f
               FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) ON a.lang = g AND a.source = s1 AND b.source = s2 GROUP BY ALL),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM pair
    UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 10
"""
