"""Benchmark decontamination with DataFrame functions only (operator 2).

The benchmark's windows of 13 words become a hash set. Every document's words
are hashed once, each window of 13 hashes is looked up, and the words of a hit
are compared with the benchmark's own before they count.

The set travels as a literal of the plan while the benchmark has at most
``LITERAL_WINDOWS`` distinct windows (counted first). A larger benchmark is
joined: windows are exploded as two independent hashes and shuffled, and 128
equal bits count as equal words.

Null or empty texts have no words and no hits. Rows are judged one by one, so
rows that repeat a document get the same answer each and null ids one of
their own. Benchmark rows with a null item_id mark words but add no item.
Extra columns are ignored. An empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import by_ids, stored, table

WINDOW = 13
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LITERAL_WINDOWS = 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASK, DROP = 20, 1  # contaminated: ASK * n_hit >= DROP * n_words


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """length, gram (words joined by a blank), items (distinct ids as strings)."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("ws")).where("size(ws) > 0")
    cut = words.select("item", "ws", F.least(F.lit(window), F.size("ws")).alias("length")).select(
        "item", "ws", "length", F.explode(F.sequence(F.lit(1), F.size("ws") - F.col("length") + 1)).alias("at"))
    return cut.groupBy("length", F.array_join(F.slice("ws", F.col("at"), F.col("length")), " ").alias("gram")).agg(F.collect_set("item").alias("items"))


def _window_hash(hashes: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*(F.get(hashes, at + j) for j in range(length)))


def _gram_hash(gram: Column, length: int, salt: int = 0) -> Column:
    hashes = F.transform(F.split(gram, " "), lambda w: _word_hash(w, salt))
    return F.xxhash64(*(F.get(hashes, F.lit(j)) for j in range(length)))


def _word_hash(word: Column, salt: int = 0) -> Column:
    return F.xxhash64(word) if not salt else F.xxhash64(F.lit(salt), word)


def _in(value: str, numbers: set[int]) -> str:
    return f"{value} IN ({', '.join(f'{x}L' for x in sorted(numbers))})"


def _starts(length: int) -> Column:
    n = F.size("ws") - length
    return F.when(n >= 0, F.sequence(F.lit(0), F.greatest(n, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _cut(length: int):
    return lambda i: F.struct(i.alias("at"), F.lit(length).alias("length"), F.array_join(F.slice("ws", i + 1, length), " ").alias("gram"))


def _hits_by_literal(docs: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """rid, doc_id, n_words, at, length, items: verified hits, one row with nulls for a document without."""
    found = []
    for n in lengths:
        mine = grams.where(F.col("length") == n).select("gram", F.split("gram", " ").alias("g"))
        rows = mine.select(_gram_hash(F.col("gram"), n).alias("h"), _word_hash(F.get("g", F.lit(0))).alias("first"), _word_hash(F.get("g", F.lit(n - 1))).alias("last")).collect()
        first, last, whole = ({r[c] for r in rows} for c in ("first", "last", "h"))
        window = f"xxhash64({', '.join(f'get(hs, i + {j})' for j in range(n))})"
        hits = F.expr(f"""filter(IF(size(ws) < {n}, CAST(array() AS ARRAY<INT>), sequence(0, greatest(size(ws) - {n}, 0))),
            i -> {_in('get(hs, i)', first)} AND {_in(f'get(hs, i + {n - 1})', last)} AND {_in(window, whole)})""")
        found.append(F.transform(hits, _cut(n)))
    rows = docs.select("doc_id", words_of(F.col("text")).alias("ws"), F.monotonically_increasing_id().alias("rid"))
    rows = rows.select("rid", "doc_id", "ws", F.transform("ws", lambda w: _word_hash(w)).alias("hs"))
    rows = rows.select("rid", "doc_id", F.size("ws").cast("long").alias("n_words"), F.concat(*found).alias("hits"))
    rows = rows.select("rid", "doc_id", "n_words", F.explode_outer("hits").alias("hit")).select("rid", "doc_id", "n_words", "hit.*")
    # The windows were counted: at most LITERAL_WINDOWS rows.
    return rows.join(F.broadcast(grams.select("gram", "items")), "gram", "left").select("rid", "doc_id", "n_words", "at", "length", "items")


def _hits_by_join(docs: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """The same for a benchmark of any size."""
    rows = docs.select("doc_id", words_of(F.col("text")).alias("ws"), F.monotonically_increasing_id().alias("rid"))
    rows = rows.select("rid", "doc_id", "ws", F.transform("ws", lambda w: _word_hash(w)).alias("hs"), F.transform("ws", lambda w: _word_hash(w, 1)).alias("ks"))
    keys = lambda n: lambda i: F.struct(i.alias("at"), F.lit(n).alias("length"), _window_hash(F.col("hs"), i, n).alias("h"), _window_hash(F.col("ks"), i, n).alias("k"))
    every = F.concat(*(F.transform(_starts(n), keys(n)) for n in lengths))
    windows = rows.select("rid", "doc_id", F.size("ws").cast("long").alias("n_words"), F.explode_outer(every).alias("w")).select("rid", "doc_id", "n_words", "w.*")
    keyed = None
    for n in lengths:
        part = grams.where(F.col("length") == n).select(_gram_hash(F.col("gram"), n).alias("h"), _gram_hash(F.col("gram"), n, 1).alias("k"), "length", "items")
        keyed = part if keyed is None else keyed.unionByName(part)
    hits = windows.join(keyed, ["h", "k", "length"], "left")
    return hits.select("rid", "doc_id", "n_words", F.when(F.col("items").isNotNull(), F.col("at")).alias("at"), "length", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literal_windows: int = LITERAL_WINDOWS) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids as strings), contaminated for every row of ``docs``."""
    grams = stored(benchmark_windows(benchmark, window), "benchmark-windows")
    sizes = {r["length"]: r["n"] for r in grams.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``window`` rows
    if not sizes:
        return docs.select("doc_id", F.size(words_of(F.col("text"))).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                           F.array().cast("array<string>").alias("items"), F.lit(False).alias("contaminated"))
    hits = (_hits_by_literal if sum(sizes.values()) <= literal_windows else _hits_by_join)(docs, grams, sorted(sizes))
    span = F.when(F.col("items").isNotNull(), F.struct("at", "length"))
    rows = hits.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
                                   F.array_sort(F.collect_set(span)).alias("spans"), F.collect_set("items").alias("items"))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda a, s: F.struct(
        F.greatest(a["end"], s["at"] + s["length"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), s["at"] + s["length"] - F.greatest(a["end"], s["at"]))).alias("n")), lambda a: a["n"].cast("long"))
    rows = rows.select("doc_id", "n_words", covered.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (ASK * F.col("n_hit") >= DROP * F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; all columns stay.

    The verdict depends on the text alone, so it goes back to the rows by
    their text's hash: null and shared ids are judged row by row.
    """
    key = "_text_key"
    keyed = docs.withColumn(key, F.unhex(F.sha2("text", 256)))
    judged = contamination(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark)
    gone = stored(judged.where("contaminated").select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return by_ids(keyed, gone, "left_anti", key).select(*docs.columns)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
OP2_SQL = rf"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark),
gram AS (SELECT DISTINCT item, least(len(ws), {WINDOW}) AS n, array_to_string(ws[i:i + least(len(ws), {WINDOW}) - 1], ' ') AS g
         FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) AS i FROM item WHERE len(ws) > 0)),
doc AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
size AS (SELECT DISTINCT n FROM gram),
win AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
        FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM doc, size WHERE len(ws) >= n)),
hit AS (SELECT doc_id, item, win.n, i FROM win JOIN gram ON win.g = gram.g AND win.n = gram.n),
word AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {ASK} * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""
