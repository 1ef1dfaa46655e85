import random

from filmlake.llm.graph import components


def test_against_brute_force(spark):
    draw = random.Random(2)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    edges += [(k, k + 1) for k in range(400, 480)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {k: k for e in edges for k in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {k for a, b in edges if a != b for k in (a, b)}
    assert got == {k: r for k, r in root.items() if k in linked}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
