"""Near-duplicates by row: shared and null ids, clashing columns, the stage that drops rows."""

import random

from cadenza.llm import near_dedup
from tests.llm.conftest import words

SCHEMA = "doc_id long, text string, row_id string, row_id_ int, component long, v int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], SCHEMA).repartition(3)


def sets_of(text):
    w = (text or "").lower().split()
    return {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())


def groups(rows):
    """Indices of rows, by group of linked rows."""
    sets = [sets_of(t) for _, t in rows]
    part = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and part[i] != part[j]:
                old, new = part[i], part[j]
                part = [new if x == old else x for x in part]
    out = {}
    for i, p in enumerate(part):
        out.setdefault(p, []).append(i)
    return list(out.values())


def check(spark, rows):
    got = near_dedup.near_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for g in groups(rows):
        ids = [rows[i][0] for i in g]
        first = min((i for i in ids if i is not None), default=None)
        want += [(rows[i][0], len(sets_of(rows[i][1])), first) for i in g]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=key) == sorted(want, key=key)
    assert sum(r.kept for r in got) == len(groups(rows))
    left = near_dedup.drop_near_duplicates(table(spark, rows))
    assert left.columns == ["doc_id", "text", "row_id", "row_id_", "component", "v"]
    left = [(r.doc_id, r.text) for r in left.collect()]
    assert len(left) == len(groups(rows))
    for g in groups(rows):  # one row of each group, of its smallest id
        own = [rows[i] for i in g]
        ids = [i for i, _ in own if i is not None]
        assert sum(r in left and (not ids or r[0] == min(ids)) for r in set(own)) >= 1


def test_shared_and_null_ids(spark):
    a, b, near = words(1, 60), words(2, 60), words(1, 60) + " more"
    check(spark, [(1, a), (1, b), (2, a), (2, b), (None, a), (3, near)])
    check(spark, [(1, a), (5, b), (9, a), (9, words(3, 60))])
    check(spark, [(None, a), (None, near), (None, b), (None, None), (4, None), (4, ""), (4, "")])
    check(spark, [(7, a), (7, a), (7, a)])


def test_unique_text_survives(spark):
    a, unique = words(1, 60), words(8, 60)
    left = near_dedup.drop_near_duplicates(table(spark, [(1, a), (5, words(2, 60)), (9, a), (9, unique)]))
    assert sorted(r.text for r in left.collect()) == sorted([a, words(2, 60), unique])


def test_many_copies_and_passages(spark):
    """A shared passage in many rows, groups of near copies, ids shared at random."""
    r = random.Random(7)
    passage = words(50, 40)
    rows = []
    for g in range(12):
        base = words(100 + g, 80).split()
        for _ in range(r.choice([1, 2, 6, 25])):
            w = list(base)
            for at in r.sample(range(80), r.choice([0, 1, 2, 3])):
                w[at] = f"x{r.randrange(5)}"
            rows.append((r.choice([None, r.randrange(30), r.randrange(30)]), (passage + " " if g % 2 else "") + " ".join(w)))
    check(spark, rows)


def test_empty(spark):
    docs = table(spark, [(1, "a b")]).limit(0)
    assert near_dedup.near_duplicates(docs).collect() == [] == near_dedup.drop_near_duplicates(docs).collect()
