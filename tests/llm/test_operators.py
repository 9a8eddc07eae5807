"""Operators against brute force, on a small corpus with every awkward case."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, html_wrapper, licenses, mixing, near_dedup, span_dedup, spotsigs, suffix_dedup, token_files, toxicity

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_near_duplicates(corpus):
    docs, rows = corpus
    sets = {}
    for i, t, _ in rows:
        w = split((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    part = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                n = len(sets[i] & sets[j])
                if n and 100 * n >= 75 * len(sets[i] | sets[j]):
                    part[i] = part[j] = min(part[i], part[j])
    got = by_id(near_dedup.near_duplicates(docs))
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (len(sets[i]), part[i], part[i] == i) for i in sets}
    assert part[4] == 3 and part[14] == 8


def test_near_duplicates_of_crowds(documents):
    """Documents that share a long passage but differ, among many near copies: no link lost or invented."""
    import random
    r = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in r.sample(range(120), r.choice([1, 2, 4, 6])):
            w[at] = f"x{r.randrange(3)}"
        rows.append((i, " ".join(w), "s"))
    got = by_id(near_dedup.near_duplicates(documents(rows)))
    sets = {i: {tuple(t.split()[j:j + 5]) for j in range(116)} for i, t, _ in rows}
    part = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in range(i):
                if part[i] != part[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    low, high = sorted((part[i], part[j]))
                    part = {k: low if v == high else v for k, v in part.items()}
                    changed = True
    assert {i: r["component_id"] for i, r in got.items()} == part


def test_repeated_bytes(corpus):
    docs, rows = corpus
    data = {i: (t or "").encode() for i, t, _ in rows}
    seen = Counter(b[j:j + 200] for b in data.values() for j in range(len(b) - 199))
    got = by_id(suffix_dedup.remove_repeated_bytes(docs))
    for i, b in data.items():
        gone = bytearray(len(b))
        for j in range(len(b) - 199):
            if seen[b[j:j + 200]] > 1:
                gone[j:j + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept)
    assert got[1]["n_removed"] == len(data[1]) and got[15]["n_removed"] == 700


def test_earlier_spans(corpus):
    docs, rows = corpus
    got, seen = by_id(span_dedup.remove_earlier_spans(docs)), set()
    for i, t, _ in rows:
        w = split(t)
        gone = [False] * len(w)
        for j in range(len(w) - 19):
            window = tuple(w[j:j + 20])
            if window in seen:
                gone[j:j + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == (len(w), sum(gone), kept)
    assert got[10]["n_removed"] == 60 and got[1]["n_removed"] == 0


def test_token_files_round_trip(corpus, documents):
    from tokenizers import Tokenizer
    docs, rows = corpus
    rows = [*rows, (16, "<|endoftext|> it's ÀÉ 12 x 中文", "s1")]
    got = by_id(token_files.encode_and_read(documents(rows)))
    tokenizer, start = Tokenizer.from_file(token_files.tokenizer_path()), 0
    for i, t, _ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert tuple(got[i]) == (i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert docs.count() == len(rows) - 1


def test_huffman_code_is_limited_and_complete():
    counts = np.array([1 << i for i in range(40)] + [0])
    lengths = token_files.code_lengths(counts, limit=8)
    assert lengths.max() <= 8 and lengths[-1] == 0
    assert sum(2.0 ** -int(x) for x in lengths[:-1]) <= 1
    plain = token_files.code_lengths(np.array([5, 1, 1, 1]), limit=18)
    assert (plain * np.array([5, 1, 1, 1])).sum() == 5 + 2 + 3 + 3
    ids = np.random.default_rng(0).integers(0, 40, 3000)
    codes = token_files.canonical(lengths)
    bits, at = token_files.pack(ids, codes, lengths)
    assert (token_files.unpack(bits, at, 3000, *token_files.decode_table(lengths, 8), 8) == ids).all()


def test_contamination(corpus, documents, spark):
    docs, rows = corpus
    items = [(1, " ".join(rows[0][1].split()[10:40])), (2, "ONE two"), (3, None), (4, ""), (5, rows[10][1][:400])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    tokens = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    for limit in (decontaminate.LITERAL_WINDOWS, 0):
        got = by_id(decontaminate.contamination(docs, bench, literal_windows=limit))
        for i, t, _ in rows:
            w, hit, found = tokens(t), set(), set()
            for item, text in items:
                v = tokens(text)
                n = min(13, len(v))
                grams = {tuple(v[j:j + n]) for j in range(len(v) - n + 1)} if v else set()
                for j in range(len(w) - n + 1):
                    if tuple(w[j:j + n]) in grams:
                        hit |= set(range(j, j + n))
                        found.add(str(item))
            r = got[i]
            assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))


def test_mix_targets_and_repeats(corpus):
    docs, rows = corpus
    got = mixing.mix(docs, shard_words=500, block_docs=2)
    r = got.select("doc_id", "source", "_mix_size", "_mix_target", mixing.taken_words().alias("taken")).collect()
    assert [x["_mix_size"] for x in sorted(r)] == [len(split(t)) for _, t, _ in rows]
    assert all(x["taken"] <= 2 * x["_mix_size"] for x in r)
    total = sum(x["_mix_size"] for x in r)
    targets = {x["source"]: x["_mix_target"] for x in r}
    for s, t in targets.items():
        own = sum(x["_mix_size"] for x in r if x["source"] == s)
        assert t <= 2 * own and abs(sum(x["taken"] for x in r if x["source"] == s) - t) <= 1
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    again = mixing.mix(docs, shard_words=500, block_docs=2).select("doc_id", mixing.taken_words().alias("taken")).collect()
    assert sorted(again) == sorted((x["doc_id"], x["taken"]) for x in r)


def test_splitting_tree_keeps_quotas(spark):
    draws = spark.range(999).select((F.col("id") % 3).alias("rank"), F.col("id").alias("block"), F.lit(0).alias("pass"))
    dealt = mixing.deal(draws, 8).collect()
    assert sorted(x["block"] for x in dealt) == list(range(999))
    assert all(abs(n - 125) <= 3 for n in Counter(x["shard"] for x in dealt).values())


def test_fingerprints(corpus):
    docs, rows = corpus
    got = by_id(spotsigs.fingerprints_with_edits(docs))
    for k, (i, t, _) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[1]["near_next"] == 1
    assert got[5]["fingerprint"] == got[6]["fingerprint"] == ""
    pairs = spotsigs.similar_pairs(spotsigs.fingerprints(docs.where("doc_id <> 2"))).collect()
    assert (3, 4) in {(p["a"], p["b"]) for p in pairs}


def test_license_phrases_and_expressions(documents):
    rows = [(1, "Licensed under CC-BY 4.0. All rights reserved, cc by", "s"), (2, None, "s"),
            (3, "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nrest", "s")]
    got = by_id(licenses.license_scan(documents(rows)))
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (3, 2, 9, "cc-by,reserved")
    assert tuple(got[2])[1:] == (0, 0, None, None, "", "", 0.0)
    assert got[3]["labels"] == "apache-2.0,gpl-2.0-only with classpath-exception-2.0,mit"
    assert licenses.parse_expression("a or b and c with d trailing") == ["a", "b", "c", "d", "with", "and", "or"]
    assert licenses.evaluate(["a", "b", "or"])[0] == ["a", "b"]


def test_toxicity_learns_and_generalises(documents, spark):
    from tests.llm.conftest import words
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        body = words(1000 + i, 60)
        rows.append((i, f"{body}. You are a zonkface{'s' if i % 8 else ''} and a grumbler. {body}" if toxic else body, "s"))
        labels.append((i, int(toxic)))
    rows += [(1000, None, "s"), (1001, "", "s"), (None, "zonkface you", "s")]
    docs, table = documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = by_id(toxicity.toxicity(docs, table))
    held = [i for i, _ in labels if got[i]["held_out"]]
    assert {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0} == set(held)
    assert all(got[i]["predicted"] == y for i, y in labels if i in held)
    assert got[1000]["score"] == got[1001]["score"] < 0.5 and not got[None]["held_out"]
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, table).select("doc_id").collect()}
    assert kept == {i for i, r in got.items() if not r["predicted"]}


def test_main_text(spark):
    page = '<html><head><title>t</title></head><body><nav><a>Menu</a></nav><div class="ad">Buy</div><article><h1>Head</h1><p>One &amp;\n two<b>!</b><p>Three<script>var t="</p>"</script></p><section class="comments"><p>No</p></section></article><footer>&copy;</footer></body></html>'
    rows = [(i, f"https://h.example/{i}", page.replace("Three", f"Three {i}")) for i in range(4)] + [(9, None, None), (10, "x", "plain text")]
    got = {r["page_id"]: r["text"] for r in html_wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"Head\nOne & two!\nThree {i}" for i in range(4)}, 9: "", 10: "plain text"}
    assert html_wrapper.render(html_wrapper.fold(["ul", "li", "#", "/li", "li", "#", "/li", "/ul"])) == "ul (li # /li)+ /ul"


def test_main_text_keeps_elements_whose_names_only_resemble_adverts():
    body = "<p>One two three</p><p>Four <a class='share'>five</a> <span class='related'>six</span></p>"
    whole = "One two three\nFour five six"
    for page in (f"<body class='has-sidebar'>{body}</body>", f"<body class='sidebar'><article class='social-issues'>{body}</article></body>",
                 f"<body><div id='no-sidebar'>{body}</div></body>", f"<body><main class='with-nav widget'>{body}</main></body>",
                 f"<body><div class='content related'>{body}</div><p></p></body>", f"<body>{body}<div class='box Ads'>Buy</div><div role=banner>Hi</div></body>"):
        assert html_wrapper.extract(page, None) == whole, page


def test_repeats_with_null_and_shared_ids(documents):
    """Rows are told apart although ids are null or shared, also at the ends of matches."""
    from tests.llm.conftest import words
    a, b, c = words(21, 120), words(22, 60), words(23, 50)
    rows = [(None, a, "s"), (1, a, "s"), (2, a, "s"), (3, b, "s"), (3, b, "s"), (None, c + " " + words(24, 70), "s"), (4, words(25, 30) + " " + c + " " + words(26, 30), "s"),
            (5, words(27, 10), "s"), (5, words(28, 9000) + " " + c, "s"), (None, c + " " + words(29, 40), "s"), (None, None, "s"), (None, "", "s"), (6, None, "s")]
    key = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
    ordered = sorted(rows, key=key)

    want, seen = [], set()
    for i, t, _ in ordered:
        w = split(t)
        gone = [False] * len(w)
        for j in range(len(w) - 19):
            window = tuple(w[j:j + 20])
            if window in seen:
                gone[j:j + 20] = [True] * 20
            seen.add(window)
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    got = [tuple(r) for r in span_dedup.remove_earlier_spans(documents(rows)).collect()]
    assert Counter(got) == Counter(want)
    assert sum(r[2] for r in got) == 2 * 120 + 60 + 3 * 50

    data = [(t or "").encode() for _, t, _ in rows]
    counts = Counter(x[j:j + 200] for x in data for j in range(len(x) - 199))
    want = []
    for (i, _, _), x in zip(rows, data, strict=True):
        gone = bytearray(len(x))
        for j in range(len(x) - 199):
            if counts[x[j:j + 200]] > 1:
                gone[j:j + 200] = b"\1" * 200
        want.append((i, len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(y for y, g in zip(x, gone, strict=True) if not g)))
    got = [(*r[:4], bytes(r[4])) for r in suffix_dedup.remove_repeated_bytes(documents(rows)).collect()]
    assert Counter(got) == Counter(want)


def test_contaminated_rows_go_whatever_their_ids(documents, spark):
    from tests.llm.conftest import words
    item, clean = words(31, 30), words(32, 40)
    rows = [(None, item, "s"), (None, clean, "s"), (1, item, "s"), (1, clean, "s"), (2, clean, "s"), (3, item, "s"), (4, None, "s"), (None, "", "s")]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents(rows)
    got = decontaminate.drop_contaminated(docs, bench)
    assert got.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter((i, t) for i, t, _ in rows if t != item)
    none = decontaminate.drop_contaminated(docs, bench.limit(0))
    assert none.count() == len(rows)


def test_container_counts_all_pages_of_a_host(spark):
    """Ten pages keep their text in one container and ninety in another: the host's is the latter, whatever a sample shows."""
    page = "<body><p>Top of all</p><div class='{}'><p>Text {} of the page</p></div><div class='tail'>Tail {}</div></body>"
    first = sorted(range(100), key=lambda i: spark.range(i, i + 1).select(F.xxhash64("id")).first()[0])[:10]
    rows = [(i, "https://h.example/x", page.format("old" if i in first else "new", f"{i} " * 9, i)) for i in range(100)]
    rows += [(None, "https://h.example/x", page.format("new", "x " * 9, "x"))]
    got = html_wrapper.host_containers(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [tuple(r) for r in got] == [("h.example", "div.new")]


def test_wrapper_decides_between_containers_of_one_label(spark):
    """Menu and text lie in a bare div each; only their places in the host's wrapper tell them apart. Half of the pages have no menu."""
    menu = "<div><ul><li>Go {}</li><li>To {}</li></ul></div><h2>Now</h2>"
    page = "<body>{}<div><h3>Text</h3>{}</div></body>"
    rows = [(i, "https://h.example/x", page.format(menu.format(i, -i) if i % 2 else "", "".join(f"<p>Part {j} of {i}" for j in range(1 + i % 3)))) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_wrapper.main_text(pages).collect()}
    assert got == {i: "\n".join(["Text", *(f"Part {j} of {i}" for j in range(1 + i % 3))]) for i in range(40)}


def test_wrapper_of_more_streams_than_one_task_takes(spark):
    """Every page matches its host's wrapper in every label, in whatever order its parts come."""
    heads = [f"h{1 + i % 6}" for i in range(6)]
    bodies = ["".join(f"<{h}>x</{h}>" for h in itertools.islice(itertools.permutations(heads, 3), i, i + 1) for h in h) for i in range(80)]
    rows = [(i, "https://h.example/x", f"<body><div class=a>{b}</div><div class=b>{i}</div></body>") for i, b in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    (found,) = html_wrapper.host_wrappers(pages).collect()
    wrapper = html_wrapper.loads(found["wrapper"])
    assert len({r[2] for r in rows}) > 2 * html_wrapper.FAN and any(optional for _, optional in wrapper)
    for _, _, p in rows:
        _, stream = html_wrapper.texts(p)
        ids = html_wrapper.match(wrapper, *html_wrapper.folded(stream, [[i] for i in range(len(stream))]))
        assert [wrapper[int(ids[i])][0] for i in sorted(ids)] == [stream[i] for i in sorted(ids)]
        assert ids[stream.index("div.a")] == str([x for x, _ in wrapper].index("div.a"))


def test_empty_tables(documents, spark):
    docs = documents([])
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for out in (near_dedup.near_duplicates(docs), suffix_dedup.remove_repeated_bytes(docs), span_dedup.remove_earlier_spans(docs), token_files.encode_and_read(docs),
                decontaminate.contamination(docs, bench), mixing.mix(docs), mixing.mixed_documents(docs), spotsigs.fingerprints_with_edits(docs), licenses.license_scan(docs), toxicity.toxicity(docs, labels),
                html_wrapper.main_text(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert out.count() == 0


def test_encoder_cache_keeps_ids_right():
    """A cache far too small for the words: recurring ones are kept, all ids stay the library's."""
    from tokenizers import Tokenizer

    from tests.llm.conftest import words
    path = token_files.tokenizer_path()
    tokenizer, e = Tokenizer.from_file(path), token_files.Encoder(path, cache_words=50)
    common = "the and it's of 12 x-y\n"
    for i in range(12):
        texts = [common * 3 + words(500 + 2 * i + j, 40) for j in range(2)] + [None, "", "中文 <|endoftext|>"]
        got = [np.frombuffer(x, dtype="<u2").tolist() for x in e.encode(texts)]
        assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert "the" in e.words.shrunk(25).numbers and len(e.words.shrunk(25).numbers) <= 25


def test_encoder_learns_each_piece_once(monkeypatch):
    """Texts of an Arrow column: a piece met in any case, word or call goes through the library once, without the steps that split texts."""
    from tokenizers import Tokenizer
    path = token_files.tokenizer_path()
    tokenizer, e = Tokenizer.from_file(path), token_files.Encoder(path)
    learnt, merged = [], e._merged
    monkeypatch.setattr(e, "_merged", lambda pieces: [learnt.extend(pieces), merged(pieces)][1])
    latin = "".join(map(chr, range(0xc0, 0x100)))
    texts = [f" It's the THE, don't''s x1y22 {latin} ×÷", "\r\n", None, "the\tÉÉ-the", latin.lower() + "'LL 'Re\n\n''tt", "\u0130 the\x0bcafe\u0301", "".join(map(chr, range(32, 127)))]
    for _ in range(2):
        got = [np.frombuffer(x, dtype="<u2").tolist() for x in e.encode(pa.array(texts, pa.string()))]
        assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert e.merger.normalizer is None and len(learnt) == len(set(learnt)) and {"the", "'s", "'ll", "éé"} <= set(learnt)


def test_batches_are_gathered_by_bytes():
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": ["ab" * (i % 5) if i % 7 else None for i in range(40)]})
    out = list(token_files.gathered((rows.slice(i, 3) for i in range(0, 40, 3)), "text", 20))
    assert pa.Table.from_batches(out) == pa.Table.from_batches([rows]) and len(out) < 14
    assert all(sum(len(t or "") for t in b.column("text").to_pylist()) <= 20 for b in out)
    assert [b.num_rows for b in token_files.gathered((rows.slice(i, 3) for i in range(0, 40, 3)), "text", 1000)] == [40]
    assert list(token_files.gathered(iter([]), "text", 20)) == []
