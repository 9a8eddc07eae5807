"""Token-ID files (operator 3): canonical length-limited Huffman codes of
token ids, in blocks that decode independently.

Encoding: tokenise every text once and store the ids; count ids over all
documents; build one code (at most ``LIMIT`` bits, package-merge); pack the
documents, in doc_id order, into blocks of about ``BLOCK_IDS`` ids. A file row
is one block: its documents, their lengths, the bit offset of every
``CHECKPOINT``-th id and the packed bits. The code's lengths are a table of
their own, so the folder explains itself.

Decoding: all stretches between checkpoints of a block advance together, one
table lookup per id; a lost executor costs the blocks it was reading.

Null texts are empty and hold only the end id. Rows that share a doc_id (or a
null one, which sorts first) follow each other in an order of their content.
Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import in_batches, slices, stored
from cadenza.llm.token_alignment import byte_alphabet
from cadenza.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
LIMIT = 18
CHECKPOINT = 256
BLOCK_IDS = 1 << 17
TEXT_BYTES = 1 << 23  # text whose words are looked up at once
CACHE_WORDS = 1 << 20  # pieces that a worker keeps (some 150 MB), also for its next task


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def runs(ids: np.ndarray, first: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``numbers`` of ``ids`` one after the other, and their sizes; run k is from ``first[k]`` to ``first[k + 1]``."""
    start = first[numbers]
    sizes = first[numbers + 1] - start
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + sizes, sizes)
    return ids[at], sizes


def starts(sizes: np.ndarray | pa.Array) -> np.ndarray:
    """Where each run begins, and the end of the last."""
    return np.append(0, np.cumsum(sizes, dtype=np.int64))


class Ragged:
    """Numbered keys, each with a run of 16-bit ids; a key not seen before gets the next number."""

    def __init__(self):
        self.numbers: dict[str, int] = defaultdict(count().__next__)
        self.first = np.zeros(1, dtype=np.int64)  # where each key's run begins, and the end
        self.ids = np.zeros(0, dtype="<u2")
        self.used = np.zeros(0, dtype=np.int64)  # how often each key was asked for

    def number(self, keys: pa.StringArray, times: np.ndarray) -> np.ndarray:
        """Numbers of ``keys``, each asked for so many ``times``; each distinct one is looked up once."""
        coded = keys.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.numbers.__getitem__, distinct), dtype=np.int64, count=len(distinct))[coded.indices.to_numpy()]
        used = np.bincount(numbers, weights=times, minlength=len(self.numbers)).astype(np.int64)
        self.used = used + np.pad(self.used, (0, len(self.numbers) - len(self.used)))
        return numbers

    def shrunk(self, most: int) -> Ragged:
        """The ``most`` keys asked for most often, at least twice, with half their uses."""
        kept = np.sort(np.argsort(-self.used, kind="stable")[:most])
        kept = kept[self.used[kept] > 1]
        keys, out = list(self.numbers), Ragged()
        for k in kept:
            out.numbers[keys[k]]  # noqa: B018 (numbers the key)
        out.add(*self.runs(kept))
        out.used = self.used[kept] // 2
        return out

    def unseen(self) -> list[str]:
        """Keys that have a number but no run yet, in the order of their numbers."""
        return list(islice(reversed(self.numbers), len(self.numbers) - len(self.first) + 1))[::-1]

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])

    def runs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return runs(self.ids, self.first, numbers)


class Encoder:
    """Exact ids of whole texts, with the pieces that recur kept in a bounded cache.

    The tokenizer lower-cases, splits a text into pieces and merges inside
    each piece alone. Where a text holds only tab, line ends, printable ASCII
    and Latin-1 letters, and nothing that could be a special token, its pieces
    are found here and only unseen ones go through the library, by a copy of
    the tokenizer that lower-cases and splits no more; any other text goes
    through the whole tokenizer.
    """

    ODD = r"[^\t\n\r\x20-\x7e\x{c0}-\x{ff}]|<\|"  # RE2
    PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+"

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.cache_words = cache_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer, self.merger = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.merger.normalizer, self.merger.pre_tokenizer = None, WhitespaceSplit()
        # The characters that stand for bytes in the vocabulary, and the space between pieces.
        self.alphabet = np.zeros(256, dtype="<u2")
        for char, byte in byte_alphabet().items():
            self.alphabet[byte] = ord(char)
        self.alphabet[ord(" ")] = ord(" ")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a piece
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words = Ragged()

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        # The batch call without offsets: the same ids for less time.
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u2")

    def _merged(self, pieces: list[str]) -> np.ndarray:
        spelt = self.alphabet[np.frombuffer(" ".join(pieces).encode(), dtype=np.uint8)]
        return self._ids(self.merger, spelt.tobytes().decode("utf-16-le"))

    def _learn(self, pieces: list[str]) -> None:
        learnt = []
        for at in range(0, len(pieces), 512):
            part = pieces[at:at + 512]
            texts = [p for p in part if p]
            ids = self._merged(texts)
            last = np.flatnonzero(self.ends[ids])
            sizes = np.diff(last, prepend=-1)
            if len(last) != len(texts) or sizes.sum() != len(ids):  # no single end a piece: one by one
                each = [self._merged([p]) for p in texts]
                ids, sizes = np.concatenate(each), np.array([len(x) for x in each])
            if len(texts) < len(part):  # the empty piece between words
                sizes = np.insert(sizes, part.index(""), 0)
            learnt.append((ids, sizes))
        self.words.add(*map(np.concatenate, zip(*learnt, strict=True)))

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 16-bit integers, without the end id."""
        texts = pa.compute.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        odd = pa.compute.match_substring_regex(texts, self.ODD)
        split = pa.compute.ascii_split_whitespace(pa.compute.utf8_lower(texts.filter(pa.compute.invert(odd))))
        words = split.flatten().dictionary_encode()
        pieces = pa.compute.ascii_split_whitespace(pa.compute.replace_substring_regex(words.dictionary, self.PIECE, r"\0 "))
        if len(self.words.numbers) > self.cache_words:
            self.words = self.words.shrunk(self.cache_words // 2)
        places, n_pieces = words.indices.to_numpy(), pieces.value_lengths().to_numpy()
        numbers = self.words.number(pieces.flatten(), np.repeat(np.bincount(places, minlength=len(n_pieces)), n_pieces))
        if unseen := self.words.unseen():
            self._learn(unseen)
        # Ids of the distinct words from those of their pieces, ids of the texts from those of their words.
        ids, sizes = self.words.runs(numbers)
        ids, sizes = runs(ids, starts(sizes)[starts(n_pieces)], places)
        cuts = starts(sizes)[starts(split.value_lengths())]
        known = (ids[a:b].tobytes() for a, b in pairwise(cuts))
        return [self._ids(self.tokenizer, t.as_py()).tobytes() if o else next(known) for t, o in zip(texts, odd.to_pylist(), strict=True)]


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``batches`` in new ones of about ``limit`` bytes of ``column``."""
    held, size = [], 0
    for b in slices(batches, column, limit):
        n = pa.compute.sum(pa.compute.binary_length(b.column(column))).as_py() or 0
        if held and size + n > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(b)
        size += n
    if held:
        yield pa.concat_batches(held)


@lru_cache(1)
def encoder(path: str, cache_words: int = CACHE_WORDS) -> Encoder:
    return Encoder(path, cache_words)


def tokenised(docs: DataFrame, path: str, cache_words: int = CACHE_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 16-bit, end id appended). Fewer ``cache_words`` take less memory and more time."""
    end = np.array([END_ID], dtype="<u2").tobytes()

    def run(batches):
        e = encoder(path, cache_words)
        for b in gathered(batches, "text", min(8 * cache_words, TEXT_BYTES)):
            ids = [x + end for x in e.encode(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])
    return docs.select("doc_id", "text").transform(in_batches, run, "doc_id long, n_tokens long, ids binary")


def id_counts(tokens: DataFrame) -> DataFrame:
    """id, n over all documents; each task adds up its own first."""
    def run(batches):
        total = np.zeros(1 << 16, dtype=np.int64)
        for b in slices(batches, "ids"):
            total += np.bincount(np.frombuffer(b"".join(b.column("ids").to_pylist()), dtype="<u2"), minlength=1 << 16)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids], pa.int64())], ["id", "n"])
    return tokens.select("ids").transform(in_batches, run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal prefix-code lengths of at most ``limit`` bits (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of this length")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.int64)
    n = len(order)
    # Level by level: leaves merged with the pairs of the level below, by weight.
    levels = []
    weights = leaf
    for _ in range(limit - 1):
        pairs = weights[:len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaf, pairs])
        sort = np.argsort(both, kind="stable")
        levels.append(sort)
        weights = both[sort]
    # The 2n - 2 cheapest of the top level are taken; each taken pair takes two below.
    take = 2 * n - 2
    depth = np.zeros(n, dtype=np.uint8)
    for sort in reversed(levels):
        chosen = sort[:take]
        leaves = chosen[chosen < n]
        depth[leaves] += 1
        take = 2 * (len(chosen) - len(leaves))
    depth[:take] += 1
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Canonical codes: by length, then id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        top = int(lengths[order].max())
        step = np.uint64(1) << (np.uint64(top) - lengths[order].astype(np.uint64))
        start = np.cumsum(step) - step
        codes[order] = start >> (np.uint64(top) - lengths[order].astype(np.uint64))
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ``ids``, most significant first, and the bit offset of every CHECKPOINT-th id."""
    size = lengths[ids].astype(np.int64)
    at = np.cumsum(size) - size
    total = int(at[-1] + size[-1]) if len(ids) else 0
    words = np.zeros(total // 64 + 2, dtype=np.uint64)
    if len(ids):
        code = codes[ids]
        word, left = at >> 6, 64 - (at & 63) - size
        high = np.where(left >= 0, code << np.maximum(left, 0).astype(np.uint64), code >> np.maximum(-left, 0).astype(np.uint64))
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        words[word[first]] = np.bitwise_or.reduceat(high, first)
        over = np.flatnonzero(left < 0)
        words[word[over] + 1] |= code[over] << (64 + left[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[:(total + 7) // 8], at[::CHECKPOINT]


def unpack(payload: bytes, offsets: np.ndarray, n: int, table_id: np.ndarray, table_length: np.ndarray, limit: int) -> np.ndarray:
    """The ``n`` ids of a block: all stretches between checkpoints advance together."""
    data = np.frombuffer(payload + bytes(8), dtype=np.uint8).astype(np.int64)
    window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]  # 32 bits from every byte on
    out = np.zeros((CHECKPOINT, len(offsets)), dtype=np.uint16)
    at = offsets.astype(np.int64)
    spare, mask = 32 - limit, (1 << limit) - 1
    last = n - (len(offsets) - 1) * CHECKPOINT if len(offsets) else 0
    for k in range(CHECKPOINT if len(offsets) > 1 else last):
        live = at if k < last else at[:-1]
        key = window[live >> 3] >> (spare - (live & 7)) & mask
        out[k, :len(live)] = table_id[key]
        live += table_length[key]
    return out.T.reshape(-1)[:n]


def decode_table(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For every ``limit``-bit prefix the id it begins with and the id's code length."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    repeat = 1 << (limit - lengths[order].astype(np.int64))
    ids, sizes = np.repeat(order, repeat), np.repeat(lengths[order], repeat)
    pad = (1 << limit) - len(ids)
    return np.append(ids, np.zeros(pad, int)).astype(np.uint16), np.append(sizes, np.ones(pad, int)).astype(np.uint8)


def _code_of(codebook: DataFrame) -> np.ndarray:
    """Code lengths by id; one small integer per id of the vocabulary (under 65,536)."""
    lengths = np.zeros(1 << 16, dtype=np.uint8)
    for id_, bits in codebook.select("id", "bits").collect():
        lengths[id_] = bits
    return lengths


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, cache_words: int = CACHE_WORDS) -> None:
    """Encode ``docs`` into ``folder``/code and ``folder``/blocks (see the module's head)."""
    spark = docs.sparkSession
    tokens = stored(tokenised(docs, path or tokenizer_path(), cache_words), "tokens", "zstd")
    counts = np.zeros(1 << 16, dtype=np.int64)
    for id_, n in id_counts(tokens).collect():  # at most one row per id of the vocabulary
        counts[id_] = n
    lengths = code_lengths(counts)
    codes = canonical(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, bits int").coalesce(1).write.parquet(f"{folder}/code")
    shared = spark.sparkContext.broadcast((codes, lengths))  # 0.6 MB whatever the input

    def run(batches):
        codes, lengths = shared.value
        ids, sizes, parts, held, number = [], [], [], 0, 0

        def block():
            payload, at = pack(np.concatenate(parts), codes, lengths)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([held], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([at], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                ["part", "block", "n_ids", "doc_ids", "lengths", "checkpoints", "bits"])

        for b in batches:
            for doc, n, x, part in zip(b.column("doc_id").to_pylist(), b.column("n_tokens").to_pylist(), b.column("ids"), b.column("part").to_pylist(), strict=True):
                ids.append(doc)
                sizes.append(n)
                parts.append(np.frombuffer(x.as_buffer(), dtype="<u2"))
                held += n
                if held >= BLOCK_IDS:
                    yield block()
                    ids, sizes, parts, held, number = [], [], [], 0, number + 1
        if ids:
            yield block()

    (tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "n_tokens", "ids").withColumn("part", F.spark_partition_id())
     .transform(in_batches, run, "part int, block int, n_ids long, doc_ids array<long>, lengths array<long>, checkpoints array<long>, bits binary")
     .write.parquet(f"{folder}/blocks"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian 16-bit) from the files alone."""
    return _decoded(spark, folder, lambda ids: pa.array([x.astype("<u2").tobytes() for x in ids], pa.binary()), "ids binary")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as 32-bit integers) from the files alone; the ids stay in the worker."""
    return _decoded(spark, folder, lambda ids: pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), "ids_crc32 long")


def _decoded(spark: SparkSession, folder: str, column: Callable[[list[np.ndarray]], pa.Array], kind: str) -> DataFrame:
    """doc_id, start, n_tokens and what ``column`` makes of the ids of the documents of a block."""
    lengths = _code_of(spark.read.parquet(f"{folder}/code"))
    limit = max(int(lengths.max()), 1)
    blocks = spark.read.parquet(f"{folder}/blocks")
    # One row per file part, then per block of a part: starts without moving any ids.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "before")
    inner = blocks.select("part", "block", "n_ids").withColumn(
        "within", F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids"))
    starts = inner.join(parts, "part").select("part", "block", (F.col("before") + F.col("within")).alias("start"))
    shared = spark.sparkContext.broadcast(lengths)

    def run(batches):
        table_id, table_length = decode_table(shared.value, limit)
        for b in batches:
            for i in range(b.num_rows):  # one block at a time
                r = b.slice(i, 1).to_pylist()[0]
                ids = unpack(r["bits"], np.array(r["checkpoints"], dtype=np.int64), r["n_ids"], table_id, table_length, limit)
                size = np.array(r["lengths"], dtype=np.int64)
                at = np.cumsum(size) - size
                out = column([ids[a:a + n] for a, n in zip(at, size, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(r["doc_ids"], pa.int64()), pa.array(at + r["start"], pa.int64()), pa.array(size, pa.int64()), out], ["doc_id", "start", "n_tokens", kind.split()[0]])
    return blocks.join(starts, ["part", "block"]).select(
        "bits", "checkpoints", "n_ids", "lengths", "doc_ids", "start").transform(in_batches, run, f"doc_id long, start long, n_tokens long, {kind}")


def encode_and_read(docs: DataFrame, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and read them back as digests."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-token-files-{uuid.uuid4().hex}"
    write_token_files(docs, folder, cache_words=cache_words)
    return digests(spark, folder)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read(spark.read.parquet(f"{sf_dir}/documents.parquet"))
