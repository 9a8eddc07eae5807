"""SentencePiece encoding and decoding with source alignment (operator 13).

A model file is read once a worker: its pieces, and its normalizer with the
compiled character map (a double-array trie over byte strings, followed by
their replacements). Normalisation takes at every place the longest prefix that
the map holds, else one character, and records for every byte it writes where
in the source its unit began. The library then segments the normalised text
with the same model, its own normalizer switched off, and each piece, whose
normalised length is known, is projected through the record to the bytes of the
source it stands for. A piece of a character spelled in bytes has an empty span
but for the last one, which has the character's.

Null texts are empty; empty texts have no pieces. Each row is encoded by
itself, so repeated rows, shared or null doc_ids and ties need no care; extra
columns are ignored; an empty table gives no rows. No row is shuffled, so a
lost executor costs the slices it was working on.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cadenza.llm.common import in_batches, slices, table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"  # a blank inside a piece
# Numbers of the model's message fields and piece types (fixed by the format).
PIECES, NORMALIZER = 1, 3
UNKNOWN, USER_DEFINED, BYTE = 2, 4, 6


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def message_fields(data: bytes) -> list[tuple[int, int | bytes]]:
    """(field number, value) of one serialized message, in its order."""
    at, out = 0, []
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at:at + size], at + size
        out.append((key >> 3, value))
    return out


def character_map(blob: bytes) -> dict[str, str]:
    """The replacements of a compiled character map: every key of its trie, walked
    unit by unit, with the text that its leaf points at."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, texts = np.frombuffer(blob[4:4 + size], dtype="<u4").astype(np.int64), blob[4 + size:]
    # A unit: the label in its low byte (bit 31 clear), a mark of a leaf in bit 8,
    # and an offset in bits 10 on, eight bits further left where bit 9 is set.
    offset = (units >> 10) << ((units & 512) >> 6)
    labels = np.arange(1, 256)
    rules, stack = {}, [(0, b"")]
    while stack:
        node, key = stack.pop()
        base = node ^ int(offset[node])
        if key and units[node] >> 8 & 1:
            start = int(units[base] & 0x7FFFFFFF)
            rules[key.decode()] = texts[start:texts.index(b"\0", start)].decode()
        child = base ^ labels
        real = child < len(units)
        real[real] = units[child[real]] & 0x800000FF == labels[real]
        stack.extend((int(c), key + bytes([int(x)])) for c, x in zip(child[real], labels[real], strict=True))
    return rules


class Normalizer:
    """Longest-prefix normalisation that keeps, for each byte written, the source byte its unit began at."""

    def __init__(self, spec: dict, user_defined: list[str]):
        self.rules = character_map(spec.get(2, b""))
        self.dummy_prefix = bool(spec.get(3, 1))
        self.squeeze = bool(spec.get(4, 1))
        self.blank = SPACE if spec.get(5, 1) else " "
        self.longest = max(map(len, self.rules), default=0)
        self.heads = frozenset(k[0] for k in self.rules)
        self.kept = re.compile("|".join(map(re.escape, sorted(user_defined, key=len, reverse=True)))) if user_defined else None

    def _unit(self, text: str, at: int) -> tuple[str, int]:
        """What the place ``at`` is normalised to, and where the next place is."""
        if self.kept and (m := self.kept.match(text, at)):
            return m[0], m.end()
        if text[at] in self.heads:
            for end in range(min(at + self.longest, len(text)), at, -1):
                if (to := self.rules.get(text[at:end])) is not None:
                    return to, end
        return text[at], at + 1

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the source byte where its unit began."""
        if not text:
            return "", np.zeros(1, dtype=np.int64)
        if not self.squeeze and not self.kept and self.heads.isdisjoint(text):
            return self._unchanged(text)
        parts, places, sizes = [], [], []
        at = place = 0
        after_blank = self.squeeze  # also at the start
        while at < len(text):
            to, end = self._unit(text, at)
            if after_blank:
                to = to.lstrip(" ")
            if to:
                parts.append(to)
                places.append(place)
                sizes.append(len(to.replace(" ", self.blank).encode()))
                after_blank = self.squeeze and to.endswith(" ")
            place += len(text[at:end].encode())
            at = end
        if not parts:
            return "", np.zeros(1, dtype=np.int64)
        source = np.append(np.repeat(np.array(places, dtype=np.int64), sizes), place)
        normal, source = self._prefixed("".join(parts).replace(" ", self.blank), source)
        while self.squeeze and normal.endswith(self.blank):  # blanks at the end belong to nothing
            normal = normal[:-1]
            source = source[:-len(self.blank.encode())]
        return normal, source

    def _unchanged(self, text: str) -> tuple[str, np.ndarray]:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        begins = np.maximum.accumulate(np.where(data & 0xC0 == 0x80, 0, np.arange(len(data))))
        source = np.repeat(begins, np.where(data == 32, len(self.blank.encode()), 1))
        return self._prefixed(text.replace(" ", self.blank), np.append(source, len(data)))

    def _prefixed(self, text: str, source: np.ndarray) -> tuple[str, np.ndarray]:
        if not self.dummy_prefix:
            return text, source
        return self.blank + text, np.concatenate([np.full(len(self.blank.encode()), source[0]), source])


class PieceModel:
    """A model file: its pieces, its normalizer and the library's processors."""

    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor
        parts = message_fields(data)
        pieces = [dict(message_fields(v)) for k, v in parts if k == PIECES]
        spec = {}
        for k, v in parts:
            if k == NORMALIZER:
                spec |= dict(message_fields(v))
        self.texts = [p[1].decode() for p in pieces]
        kinds = np.array([p.get(3, 1) for p in pieces])
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        self.is_byte = kinds == BYTE
        self.normalizer = Normalizer(spec, [t for t, k in zip(self.texts, kinds, strict=True) if k == USER_DEFINED])
        # Bytes of normalised text each piece stands for.
        self.sizes = np.where(self.is_byte, 1, [len(t.encode()) for t in self.texts])
        self.processor = SentencePieceProcessor(model_proto=data)
        # Of a message field given twice the later values hold: an empty character
        # map (2), no prefix (3) and blanks kept (4).
        own = b"\x12\x00\x18\x00\x20\x00"
        self.segmenter = SentencePieceProcessor(model_proto=data + bytes([NORMALIZER << 3 | 2, len(own)]) + own)

    def token_bytes(self) -> list[bytes]:
        """What each id spells: the piece with blanks, or its one byte."""
        return [bytes([int(t[3:5], 16)]) if b else t.replace(SPACE, " ").encode() for t, b in zip(self.texts, self.is_byte, strict=True)]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the whole text, and where in its UTF-8 bytes each piece begins and ends."""
        normal, source = self.normalizer.normalise(text or "")
        ids = np.array(self.segmenter.encode(normal), dtype=np.int32)
        sizes = self.sizes[ids]
        if (unknown := np.flatnonzero(ids == self.unknown)).size:
            pieces = self.segmenter.encode(normal, out_type=str)
            sizes[unknown] = [len(pieces[i].encode()) for i in unknown]
        edges = np.append(0, np.cumsum(sizes))
        if edges[-1] != len(source) - 1:
            raise ValueError("the pieces do not spell the normalised text")
        return ids, source[edges[:-1]], source[edges[1:]]

    def decode(self, ids: np.ndarray) -> str:
        return self.processor.decode(ids.tolist())


@lru_cache(2)
def piece_model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel(f.read())


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    edges = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(parts), kind))


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, begins, ends (bytes of the text) of every row of ``docs``."""
    path = path or model_path()

    def run(batches):
        model = piece_model(path)
        for b in slices(batches):
            ids, begins, ends = zip(*(model.encode(t) for t in b.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), _lists(ids, pa.int32()), _lists(begins, pa.int64()), _lists(ends, pa.int64())],
                ["doc_id", "ids", "begins", "ends"])
    return docs.select("doc_id", "text").transform(in_batches, run, "doc_id long, ids array<int>, begins array<long>, ends array<long>")


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text that the ids of each row decode to."""
    path = path or model_path()

    def run(batches):
        model = piece_model(path)
        for b in batches:
            texts = [model.decode(b.column("ids")[i].values.to_numpy(zero_copy_only=False)) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return tokens.select("doc_id", "ids").transform(in_batches, run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 and spans_crc32
    (of all begins, then all ends, as little-endian 64-bit integers); ids, spans and texts stay in the worker."""
    path = path or model_path()

    def row(model: PieceModel, text: str | None) -> tuple:
        ids, begins, ends = model.encode(text)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids.tolist())), model.decode(ids))]
        return len(ids), *sha, zlib.crc32(ends.astype("<i8").tobytes(), zlib.crc32(begins.astype("<i8").tobytes()))

    def run(batches):
        model = piece_model(path)
        for b in slices(batches):
            n, ids, text, spans = zip(*(row(model, t) for t in b.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(text), pa.array(spans, pa.int64())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])
    return docs.select("doc_id", "text").transform(
        in_batches, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")


def op13_sentencepiece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
