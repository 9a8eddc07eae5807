"""Token alignment against brute force over whole texts, and its k-way merge."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from cadenza.llm import token_alignment


def brute(rows):
    """Rows of (doc_id, text) to what the operator returns, one text at a time and without cuts."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(token_alignment.model_path(token_alignment.BYTE_BPE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=token_alignment.model_path())
    alphabet = token_alignment.byte_alphabet()
    parts = []
    for _, text in rows:
        pairs, shown = Counter(), []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids
            one = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in ids]
            two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
            if b"".join(x for _, x in one) == (" " + text).encode() == b"".join(x for _, x in two):
                ends = []
                for side in (one, two):
                    n, out = 0, []
                    for _, x in side:
                        n += len(x)
                        out.append(n)
                    ends.append(out)
                cuts = sorted(set(ends[0]) & set(ends[1]))
                start = 0
                for cut in cuts:
                    g = [[i for (i, _), e in zip(side, end, strict=True) if start < e <= cut] for side, end in zip((one, two), ends, strict=True)]
                    shown.append("|".join(",".join(map(str, x)) for x in g))
                    pairs.update((i, j) for i in g[0] for j in g[1])
                    start = cut
            else:
                one = two = []
            parts.append((len(one), len(two), pairs, shown))
        else:
            parts.append((0, 0, pairs, shown))
    count = Counter(p for *_, pairs, _ in parts for p in pairs)
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(d, n_a, n_b, len(shown), sum(pairs.values()), sum(n for p, n in pairs.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in pairs.items()),
             hashlib.sha256(";".join(shown).encode()).hexdigest() if n_a else "") for (d, _), (n_a, n_b, pairs, shown) in zip(rows, parts, strict=True)]


def key(row):
    return row[0] is None, row[0] or 0, row[1:]


def awkward():
    r = random.Random(9)
    letters = "ab  \n\t.é日本🙂'1٣  \x1c①ﬁ́"
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randrange(1, 60)))) for i in range(150)]
    rows += [(200, "literal ▁ blank"), (201, "<|endoftext|> <s> <0x41>"), (202, " leading  and   trailing  "), (203, "\n\nlines\r\n\n  x \n"), (204, "   "), (205, "\n"),
             (206, "日本語テキスト" * 40), (207, "aé" * 3000), (208, "it's we'll I'M don’t"), (209, None), (210, ""), (None, "null id"), (None, None), (1, "shared id"), (1, "shared id"),
             (211, "x" * 20000), (212, "a a a a " * 2000)]
    return rows


def test_alignment(spark, corpus, monkeypatch):
    rows = [(i, t) for i, t, _ in corpus[1]] + awkward()
    docs = spark.createDataFrame([(i, t, "x", -1, "y") for i, t in rows], "doc_id long, text string, block string, place int, radix string").repartition(3)
    want = sorted(brute(rows), key=key)
    assert sum(r[1] > 0 for r in want) > 150 and any(r[1] == 0 and r[0] == 200 for r in want)
    assert sorted(map(tuple, token_alignment.aligned(docs).collect()), key=key) == want


def test_many_levels(spark, monkeypatch):
    """Blocks of few records, merged two at a time, give the same."""
    rows = awkward()
    monkeypatch.setattr(token_alignment, "BLOCK_RECORDS", 1)
    monkeypatch.setattr(token_alignment, "FAN", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    assert sorted(map(tuple, token_alignment.aligned(docs).collect()), key=key) == sorted(brute(rows), key=key)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.aligned(docs).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, token_alignment.aligned(docs).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_merge(monkeypatch):
    monkeypatch.setattr(token_alignment, "STRETCH", 3)
    r = random.Random(1)
    runs, want = [], Counter()
    for _ in range(7):
        codes = np.array(sorted(r.sample(range(60), r.randrange(25))), dtype=np.int64)
        counts = np.array([r.randrange(1, 9) for _ in codes], dtype=np.int64)
        want.update(dict(zip(codes.tolist(), counts.tolist(), strict=True)))
        runs.append((codes, counts))
    codes, counts = token_alignment.merged(runs)
    assert list(zip(codes.tolist(), counts.tolist(), strict=True)) == sorted(want.items())
