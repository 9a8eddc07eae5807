"""Connected components."""

import random

from cadenza.llm import common, graph


def _brute(links):
    up = {x: x for link in links for x in link}
    for _ in up:
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    return up


def _links():
    pick = random.Random(5)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    pick.shuffle(chain)
    return chain + [(pick.randrange(150), pick.randrange(150)) for _ in range(90)] + [(2000, 2000 + i) for i in range(1, 40)] + [(7, 8), (8, 7)]


def _found(spark, monkeypatch, parts):
    calls = []
    monkeypatch.setattr(graph, "stored", lambda *a: calls.append(a) or common.stored(*a))
    links = [x for x in _links() if x[0] != x[1]]
    df = spark.createDataFrame(links + [(3000, 3000)], "a long, b long").repartition(parts)
    got = graph.components(df).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["component"] for r in got} == _brute(links)
    return len(calls)


def test_few_links_take_no_rounds(spark, monkeypatch):
    assert _found(spark, monkeypatch, 8) == 1


def test_components_across_tasks(spark, monkeypatch):
    monkeypatch.setattr(graph, "LOCAL_LINKS", 16)
    assert _found(spark, monkeypatch, 8) > 1
    monkeypatch.setattr(graph, "BROADCAST_ROWS", 0)
    assert _found(spark, monkeypatch, 8) > 1
