"""Source divergence against a statement of its contract in plain Python."""

import random
import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np

from cadenza.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(rows, min_docs=10, top=10):
    """(text, lang, source) rows to result rows, in Python's integers."""
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        ts = terms_of(text)
        count[lang or "", source or ""].update(ts)
        docs[lang or ""].update(set(ts))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = {s: {t: c[t] for t in kept} for (g, s), c in count.items() if g == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def shares(c, kept=kept):
            return {t: 1 + 1000000000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p = {s: shares(c) for s, c in own.items()}
        q = shares(whole)
        for s in own:
            pairs = [(h, sum((p[s][t] - p[h][t]) ** 2 // (p[s][t] + p[h][t]) for t in kept)) for h in own if h != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if own[s][t] > 0 and p[s][t] > q[t]]
            for part, items, n in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:n], 1)]
    return sorted(out)


def rows(n, seed, sources=6):
    r = random.Random(seed)
    words = ["a", "Ab", "abcdefgh", "abcdefghi", "sixteen_letters", "sixteenletterszz", "seventeenletters", "Straße", "日本語テキスト", "é", "it's", "x2y", "[end]",
             "w" * 33, "w" * 64, "w" * 65, "ß" * 200, "Ünï"] + [f"{a}{b}" for a in "klmnop" for b in "qrstuv"]
    out = []
    for _ in range(n):
        source = r.choice([None, "", *(f"s{i}" for i in range(sources))]) if r.random() < 0.66 else "s0"
        text = r.choice([" ", "\n", ", "]).join(r.choices(words, weights=[1 + (i * 7) % 5 for i in range(len(words))], k=r.randrange(30)))
        out.append((text, r.choice(["en", "de", None]), source))
    return out + [(None, "en", "s1"), ("", "en", "no terms"), ("1 2 3", None, "digits"), ("rare words only", "xx", "a"), ("other ones", "xx", "b"), ("b" * 100000 + " x", "en", "s2")]


def check(spark, data, **kw):
    docs = spark.createDataFrame([(t, g, s, 1, 2, "x") for t, g, s in data], "text string, lang string, source string, n int, docs int, term string").repartition(3)
    got = divergence.divergence(docs, **kw)
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    want = brute(data, **kw)
    assert sorted(map(tuple, got.collect())) == want
    return want


def test_divergence(spark):
    data = rows(400, 2)
    want = check(spark, data + data[:50])
    assert {r[2] for r in want} == {"pair", "term"} and any(r[0] == "xx" and r[4] == 0 for r in want) and any(r[5] == 10 for r in want)


def test_tiles_and_slices(spark, monkeypatch):
    """More sources than a tile holds, more texts than a slice."""
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "SLICE", 2000)
    check(spark, rows(300, 4, sources=11), min_docs=2, top=3)


def test_empty(spark):
    assert check(spark, []) == []
    assert check(spark, [(None, None, None)]) == []


def test_counting_by_length():
    texts = [t or "" for t, _, _ in rows(60, 6)]
    groups = np.array([i % 3 for i in range(len(texts))])
    n, docs = Counter(), Counter()
    for t, g in zip(texts, groups.tolist(), strict=True):
        n.update((g, x) for x in terms_of(t))
        docs.update({(g, x) for x in terms_of(t)})
    got = list(chain.from_iterable(zip(g.tolist(), [t.decode() for t in ts], a.tolist(), b.tolist(), strict=True) for g, ts, a, b in divergence.count_terms(texts, groups)))
    assert len({x[:2] for x in got}) == len(got)
    assert {(g, t): (a, b) for g, t, a, b in got} == {k: (n[k], docs[k]) for k in n}


def test_shares_are_exact_for_large_counts(spark):
    from pyspark.sql import functions as F
    r = random.Random(8)
    data = [(r.randrange(10**k), 10**k + r.randrange(5 * 10**14)) for k in (1, 5, 9, 12, 14, 15) for _ in range(20)]
    got = spark.createDataFrame(data, "c long, d long").select("c", "d", divergence.share(F.col("c"), F.col("d") + 2)).collect()
    assert all(p == 1 + 10**9 * (c + 2) // (d + 2) for c, d, p in got)
