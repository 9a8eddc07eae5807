"""Cross-tokenizer alignment (operator 12): which ids of a byte-level BPE (A) and
of a SentencePiece model (B) stand for the same stretches of a corpus.

A text, with a blank before it, is encoded by both. Byte offsets where tokens of
both end cut it into groups; all A-B pairs of token occurrences in a group are
links, and the count of a pair of ids is the number of rows that hold it linked.

* *Encoding.* Neither tokenizer joins what follows a character that is no white
  space to a blank or line end after it (for B the vocabulary is asked), so a
  text is cut there and every distinct stretch is encoded and aligned once; a
  group never crosses such a cut.
* *Runs.* Tasks gather pair-document records (pair code, row, links), sort them
  and write them as zstd runs, radix-partitioned by A id, with the number of
  rows of each pair beside them. A pair code is A id * size of B's vocabulary + B
  id, so order of codes is side-major.
* *Counting.* Runs of a partition are merged by k-way heap merges of ``FAN`` runs
  at a time, level by level, until one is left: every pair's count, and while an
  A id's pairs pass by in order, its maximum.
* *Contributions.* Groups of runs meet the counts of their partition (bounded by
  the two vocabularies, whatever the input), and each record streams its count
  and whether it is a best one back to its row.

Runs are cut by rows of input, so an id in every text is spread over as many
runs as there are blocks; nothing is held by key. Rows are known by block and
place, so shared or null doc_ids, repeated rows and ties count as rows of their
own. A null or empty text, and one that either tokenizer does not spell back
byte for byte, has no tokens: zeros and an empty groups_sha256. Extra columns
are ignored; an empty table gives no rows. Each level is a stored table, so a
lost executor costs the tasks it ran.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections import defaultdict
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import in_batches, slices, stored, table
from cadenza.llm.piece_spans import MODEL, SPACE, model_path, piece_model

BYTE_BPE = "byte_bpe_50k.json"
RADIX = 32  # partitions of a run, by A id
FINE = 16 * RADIX  # partitions of merged runs
BLOCK_RECORDS = 1 << 20  # pair-document records of a block of rows, about 20 MB held by a task
FAN = 64  # runs merged at a time
STRETCH = 1 << 15  # codes taken from a run at a time while merging
SLICE = 1 << 20  # bytes of text aligned in one pass
CACHE_CHARS = 1 << 23  # characters of distinct stretches kept by a worker


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    Latin-1 characters are their own byte, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Aligner:
    """Both tokenizers, and what they make of each distinct stretch of text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = piece_model(path_b)
        alphabet = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(map(alphabet.__getitem__, token))
        self.bytes_b = self.b.token_bytes()
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        # A cut needs a character that no piece holds after another one.
        inner = "".join(re.sub(f"^{SPACE}+", "", t) for t, byte in zip(self.b.texts, self.b.is_byte, strict=True) if not byte)
        cuts = "".join(c for c, shown in ((" ", SPACE), ("\n", "\n")) if shown not in inner)
        plain = self.b.normalizer
        if plain.rules or plain.squeeze or plain.kept or not plain.dummy_prefix or plain.blank != SPACE:
            raise ValueError("B must leave the text as it is but for a blank before it")
        if len(self.bytes_a) * len(self.bytes_b) >= 1 << 31:
            raise ValueError("codes of pairs of these vocabularies need more than 31 bits")
        self.stretch = re.compile(rf"(?<=\S)(?=[{cuts}])") if cuts else None
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.chars = 0
        self.groups: list[str | None] = []  # as printed; None where a tokenizer does not spell the stretch
        self.totals = np.zeros((0, 4), dtype=np.int64)  # n_a, n_b, n_groups, n_links
        self.first = np.zeros(1, dtype=np.int64)  # where each stretch's pairs begin, and the end
        self.codes = np.zeros(0, dtype=np.uint32)
        self.links = np.zeros(0, dtype=np.int64)

    def _groups(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple:
        """Of two id sequences that spell the same bytes: the group of each token, and the number of groups."""
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        return np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b), len(ends)

    @staticmethod
    def _distinct(group: np.ndarray, ids: np.ndarray, n: int) -> tuple:
        """Distinct (group, id) in order, how often each occurs, and how many a group has."""
        key, times = np.unique(group.astype(np.int64) << 32 | ids, return_counts=True)
        return key & 0xFFFFFFFF, times, np.bincount(key >> 32, minlength=n)

    def _learn(self, stretches: list[str]) -> None:
        """Encode and align stretches not seen before, all in one pass."""
        ids_a = [e.ids for e in self.a.encode_batch(stretches, add_special_tokens=False)]
        ids_b = self.b.segmenter.encode([s.replace(" ", SPACE) for s in stretches], num_threads=1)
        spelled = [b"".join(map(self.bytes_a.__getitem__, x)) == s.encode() == b"".join(map(self.bytes_b.__getitem__, y))
                   for s, x, y in zip(stretches, ids_a, ids_b, strict=True)]
        ids_a = [x if ok else [] for x, ok in zip(ids_a, spelled, strict=True)]
        ids_b = [y if ok else [] for y, ok in zip(ids_b, spelled, strict=True)]
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b))
        all_a, all_b = (np.fromiter(chain.from_iterable(ids), dtype=np.int64) for ids in (ids_a, ids_b))
        group_a, group_b, n = self._groups(all_a, all_b)
        of_group = np.zeros(n, dtype=np.int64)  # the stretch of each group
        of_group[group_a] = np.repeat(np.arange(len(stretches)), n_a)

        def printed(group, ids):
            words = [""] * n
            at = np.append(0, np.cumsum(np.bincount(group, minlength=n))).tolist()
            names = list(map(str, ids.tolist()))
            for i in range(n):
                words[i] = ",".join(names[at[i]:at[i + 1]])
            return words
        texts = list(map("|".join, zip(printed(group_a, all_a), printed(group_b, all_b), strict=True)))
        n_groups = np.bincount(of_group, minlength=len(stretches))
        at = np.append(0, np.cumsum(n_groups)).tolist()
        self.groups += [";".join(texts[at[i]:at[i + 1]]) if ok else None for i, ok in enumerate(spelled)]
        n_links = np.bincount(group_a, minlength=n) * np.bincount(group_b, minlength=n)
        totals = np.stack([n_a, n_b, n_groups, np.add.reduceat(np.append(n_links, 0), at[:-1]) * (n_groups > 0)], axis=1)
        self.totals = np.concatenate([self.totals, totals])
        # Distinct ids of each side of a group, crossed: place k of a group is pair (k // its B ids, k % its B ids).
        a, times_a, wide_a = self._distinct(group_a, all_a, n)
        b, times_b, wide_b = self._distinct(group_b, all_b, n)
        wide = wide_a * wide_b
        group = np.repeat(np.arange(n), wide)
        k = np.arange(len(group)) - np.repeat(np.cumsum(wide) - wide, wide)
        i = (np.cumsum(wide_a) - wide_a)[group] + k // np.maximum(wide_b[group], 1)
        j = (np.cumsum(wide_b) - wide_b)[group] + k % np.maximum(wide_b[group], 1)
        code, links = a[i] * len(self.bytes_b) + b[j], times_a[i] * times_b[j]
        order = np.lexsort((code, of_group[group]))
        code, links, stretch = code[order], links[order], of_group[group][order]
        new = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (stretch[1:] != stretch[:-1]))) if len(code) else np.zeros(0, dtype=np.int64)
        self.codes = np.concatenate([self.codes, code[new].astype(np.uint32)])
        self.links = np.concatenate([self.links, np.add.reduceat(links, new) if len(new) else links])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.bincount(stretch[new], minlength=len(stretches)))])

    def align(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Per text (n_a, n_b, n_groups, n_links, groups_sha256), and its pair records: codes, place of the text, links."""
        if self.chars > CACHE_CHARS:
            self.clear()
        cut = [[] if not t else self.stretch.split(" " + t) if self.stretch else [" " + t] for t in texts]
        numbers = [list(map(self.numbers.__getitem__, c)) for c in cut]
        new = list(islice(reversed(self.numbers), len(self.numbers) - len(self.groups)))[::-1]
        if new:
            self.chars += sum(map(len, new))
            self._learn(new)
        rows = []
        for i, x in enumerate(numbers):
            groups = [self.groups[k] for k in x]
            if not x or None in groups:
                rows.append((0, 0, 0, 0, ""))
                numbers[i] = []
            else:
                rows.append((*self.totals[x].sum(axis=0).tolist(), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        sizes = [len(x) for x in numbers]
        used, times = np.unique(np.repeat(np.arange(len(texts)), sizes) << 32 | np.fromiter(chain.from_iterable(numbers), np.int64, sum(sizes)), return_counts=True)
        place, number = used >> 32, used & 0xFFFFFFFF
        wide = self.first[number + 1] - self.first[number]
        at = np.repeat(self.first[number] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
        return rows, self.codes[at], np.repeat(place, wide), self.links[at] * np.repeat(times, wide)


@lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def packed(values: np.ndarray, kind: str) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values, dtype=kind).tobytes(), 1)


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), dtype=kind)


def pack_codes(codes: np.ndarray) -> bytes:
    """Ascending codes as their differences."""
    return packed(np.diff(codes.astype(np.int64), prepend=0), "<u4")


def unpack_codes(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, "<u4"), dtype=np.int64)


def summed(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``codes`` in order, each with the sum of its values."""
    order = np.argsort(codes, kind="stable")
    codes, values = codes[order], values[order]
    new = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, dtype=np.int64)
    return codes[new], np.add.reduceat(values, new) if len(new) else values


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """K-way merge of runs of (ascending codes, counts), counts of equal codes added up.

    The heap holds the last code of the stretch of each run that is at hand; up to
    the smallest of them nothing can come from further on, so all codes up to it
    leave together.
    """
    at = [0] * len(runs)
    heap = [(codes[:STRETCH][-1], i) for i, (codes, _) in enumerate(runs) if len(codes)]
    heapq.heapify(heap)
    out = []
    while heap:
        bound, i = heap[0]
        parts = []
        for _, j in heap:
            codes, counts = runs[j]
            end = at[j] + int(np.searchsorted(codes[at[j]:], bound, "right"))
            parts.append((codes[at[j]:end], counts[at[j]:end]))
            at[j] = end
        out.append(summed(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts])))
        if at[i] < len(runs[i][0]):
            heapq.heapreplace(heap, (runs[i][0][at[i]:at[i] + STRETCH][-1], i))
        else:
            heapq.heappop(heap)
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([c for c, _ in out]), np.concatenate([n for _, n in out])


DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                           ("n_links", pa.int64()), ("groups_sha256", pa.string())]))
RUNS = pa.list_(pa.struct([("radix", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary()), ("rows", pa.binary()), ("links", pa.binary())]))
BLOCK = pa.schema([("block", pa.int64()), ("docs", DOCS), ("runs", RUNS)])


def blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per block of documents: its rows with all but the counts, and its runs, one a radix partition."""
    def run(batches):
        tool = aligner(path_a, path_b)
        vocabulary = len(tool.bytes_b)
        held, number, found = 0, 0, []

        def block():
            starts = np.cumsum([0, *(len(docs) for docs, *_ in found)])
            codes = np.concatenate([c for _, c, _, _ in found]).astype(np.int64)
            places = np.concatenate([p + s for (_, _, p, _), s in zip(found, starts, strict=False)])
            keys, links = summed(codes << 32 | places, np.concatenate([x for *_, x in found]))
            codes, places = keys >> 32, keys & 0xFFFFFFFF
            radix = codes // vocabulary % RADIX
            runs = []
            for r in np.unique(radix):
                of = radix == r
                own, counts = np.unique(codes[of], return_counts=True)
                runs.append({"radix": r, "codes": pack_codes(own), "counts": packed(counts, "<i8"),
                             "rows": packed(places[of], "<u4"), "links": packed(links[of], "<i8")})
            return pa.RecordBatch.from_pylist([{"block": part << 32 | number, "docs": [d for docs, *_ in found for d in docs], "runs": runs}], schema=BLOCK)

        for b in slices(batches, limit=SLICE):
            part = b.column("part")[0].as_py()
            rows, codes, places, links = tool.align(b.column("text").to_pylist())
            names = DOCS.value_type.names
            found.append(([dict(zip(names, (d, *r), strict=True)) for d, r in zip(b.column("doc_id").to_pylist(), rows, strict=True)], codes, places, links))
            held += len(codes)
            if held >= BLOCK_RECORDS:
                yield block()
                held, number, found = 0, number + 1, []
        if found:
            yield block()
        tool.clear()  # workers outlive a stage
    fields = "array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>>"
    runs = "array<struct<radix:int,codes:binary,counts:binary,rows:binary,links:binary>>"
    return docs.select("doc_id", "text", F.spark_partition_id().alias("part")).transform(
        in_batches, run, f"block bigint, docs {fields}, runs {runs}")


def pair_counts(runs: DataFrame, n_blocks: int, vocabulary: int) -> DataFrame:
    """Of runs (radix, block, codes, counts): fine, codes, counts, and the highest count of each code's A id.

    A level merges the runs of a partition, ``FAN`` at a time. The first cuts its
    result into finer partitions, so that a level above holds no more than
    ``FAN`` times a 512th of all pairs.
    """
    kinds = "part int, block bigint, codes binary, counts binary, best binary"

    def level(last: bool, fine: int):
        def run(key, table):
            codes, counts = merged([(unpack_codes(c), unpacked(n, "<i8")) for c, n in zip(table["codes"].to_pylist(), table["counts"].to_pylist(), strict=True)])
            a = codes // vocabulary
            rows = []
            for part in np.unique(a % fine):
                of = a % fine == part
                own, n = codes[of], counts[of]
                best = b""
                if last:  # side-major order: the pairs of an A id stand together
                    new = np.flatnonzero(np.append(True, a[of][1:] != a[of][:-1]))
                    best = packed(np.repeat(np.maximum.reduceat(n, new), np.diff(np.append(new, len(n)))), "<i8")
                rows.append({"part": part, "block": key[1].as_py(), "codes": pack_codes(own), "counts": packed(n, "<i8"), "best": best})
            return pa.Table.from_pylist(rows, schema=pa.schema([("part", pa.int32()), ("block", pa.int64()), ("codes", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())]))
        return run

    runs = runs.withColumnRenamed("radix", "part")
    while True:
        n_blocks = -(-n_blocks // FAN)
        grouped = runs.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(n_blocks)).cast("long")).groupBy("part", "block")
        runs = stored(grouped.applyInArrow(level(n_blocks <= 1, FINE), kinds), "pair-counts")
        if n_blocks <= 1:
            return runs


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    path_a, path_b = path_a or model_path(BYTE_BPE), path_b or model_path(MODEL)
    vocabulary = len(piece_model(path_b).texts)
    held = stored(blocks(docs, path_a, path_b), "alignment")
    n_blocks = held.count()
    runs = held.select("block", F.explode("runs").alias("r"))
    counts = pair_counts(runs.select("r.radix", "block", "r.codes", "r.counts"), n_blocks, vocabulary)
    n_groups = max(-(-n_blocks // FAN), 1)

    def contribute(runs, counts):
        known = np.concatenate([unpack_codes(c) for c in counts["codes"].to_pylist()])
        order = np.argsort(known, kind="stable")
        known = known[order]
        n = np.concatenate([unpacked(c, "<i8") for c in counts["counts"].to_pylist()])[order]
        best = np.concatenate([unpacked(c, "<i8") for c in counts["best"].to_pylist()])[order] == n
        out = []
        for r in runs.to_batches(max_chunksize=1):
            block, codes, own, rows, links = (r.column(c)[0].as_py() for c in ("block", "codes", "counts", "rows", "links"))
            at = np.repeat(np.searchsorted(known, unpack_codes(codes)), unpacked(own, "<i8"))
            rows, links = unpacked(rows, "<u4").astype(np.int64), unpacked(links, "<i8")
            place, total = summed(rows, links * n[at])
            out.append(pa.table([np.full(len(place), block), place, total, summed(rows, links * best[at])[1]], ["block", "place", "count_sum", "n_best"]))
        return pa.concat_tables(out)

    left = runs.select("r.radix", F.pmod(F.xxhash64("block"), F.lit(n_groups)).alias("g"), "block", "r.codes", "r.counts", "r.rows", "r.links")
    right = counts.select((F.col("part") % RADIX).alias("radix"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long"))).alias("g"), "codes", "counts", "best")
    gains = left.groupBy("radix", "g").cogroup(right.groupBy("radix", "g")).applyInArrow(
        lambda a, b: contribute(a, b) if a.num_rows else NOTHING, "block bigint, place bigint, count_sum bigint, n_best bigint")
    gains = gains.groupBy("block", "place").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    rows = held.select("block", F.posexplode("docs").alias("place", "d")).select("block", F.col("place").cast("long").alias("place"), "d.*")
    return rows.join(gains, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")), "groups_sha256")


NOTHING = pa.table([pa.array([], pa.int64())] * 4, ["block", "place", "count_sum", "n_best"])


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"))
