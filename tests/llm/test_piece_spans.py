"""SentencePiece spans against the library itself, with the model's own and with a compiled character map."""

import hashlib
import random

import pytest

from cadenza.llm import piece_spans

AWKWARD = ["", " ", "  \n\t", "a", " a", "a ", "x  y   z ", "é日本語🙂", "ﬁne Å　Å ①½ ﷺ", "<s> </s> <unk> <0x41>", "▁ under ▁▁", "tab\tnew\r\nline",
           "é café", " nbsp​zero", "ｱﾞ ガ ㌀ ½ ²", "\x00 nul \x07", "   leading and trailing   ", "¨ ¯ ´"]


def model_with(rule: str | None, **flags) -> bytes:
    """The model's file with another normalizer put in force after its own."""
    from sentencepiece import SentencePieceNormalizer
    with open(piece_spans.model_path(), "rb") as f:
        data = f.read()
    spec = b""
    if rule:
        for k, v in piece_spans.message_fields(SentencePieceNormalizer(rule_name=rule).serialized_model_proto()):
            if k == piece_spans.NORMALIZER:
                blob = dict(piece_spans.message_fields(v))[2]
                n, size = len(blob), b""
                while n > 127:
                    size, n = size + bytes([n & 127 | 128]), n >> 7
                spec += b"\x12" + size + bytes([n]) + blob
    for number, value in flags.items():
        spec += bytes([int(number[1:]) << 3, value])
    n, size = len(spec), b""
    while n > 127:
        size, n = size + bytes([n & 127 | 128]), n >> 7
    return data + bytes([piece_spans.NORMALIZER << 3 | 2]) + size + bytes([n]) + spec


def texts() -> list[str]:
    r = random.Random(3)
    letters = "ab  \n.é日🙂ﬁ①é　▁"
    return AWKWARD + ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(200)] + ["word " * 9000 + "x" * 9000]


@pytest.mark.parametrize("rule,flags", [(None, {}), ("nmt_nfkc", {}), ("nfkc_cf", {"f4": 1}), ("nmt_nfkc", {"f4": 1, "f3": 0}), (None, {"f4": 1})])
def test_spans_equal_the_library(rule, flags):
    model = piece_spans.PieceModel(model_with(rule, **flags))
    for text in texts():
        ids, begins, ends = model.encode(text)
        want = model.processor.encode(text, return_type="proto")
        assert ids.tolist() == [p.id for p in want.pieces], repr(text[:60])
        assert [(int(b), int(e)) for b, e in zip(begins, ends, strict=True)] == [(p.begin, p.end) for p in want.pieces], repr(text[:60])


def test_character_map_is_read_whole():
    model = piece_spans.PieceModel(model_with("nfkc"))
    assert len(model.normalizer.rules) > 4000
    assert model.normalizer.rules["ﬁ"] == "fi" and model.normalizer.rules["é"] == "é"


def test_operator(spark, corpus):
    docs, rows = corpus
    rows = rows + [(1, "shared id", "s"), (None, "null id", "s"), (None, None, "s")]
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t, _ in rows], "doc_id long, text string, ids int, begins string, n_tokens int")
    processor = piece_spans.piece_model(piece_spans.model_path()).processor
    want = []
    for i, t, _ in rows:
        ids = processor.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(processor.decode(ids).encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([tuple(r)[:4] for r in piece_spans.digests(docs).collect()], key=key) == sorted(want, key=key)
    tokens = piece_spans.encoded(docs)
    texts = {r.doc_id: r.text for r in piece_spans.decoded(tokens.where("doc_id > 1")).collect()}
    assert all(texts[i] == (t or "") for i, t, _ in rows if i and i > 1)
    for r in tokens.where("doc_id = 11").collect():
        data = dict((i, t) for i, t, _ in rows)[11].encode()
        assert b"".join(data[b:e] for b, e in zip(r.begins, r.ends, strict=True)) == data
    assert piece_spans.digests(docs.limit(0)).count() == 0
