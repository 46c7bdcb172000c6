import random

import pytest

from annotspark.llm.components import components, stars


def brute(edges):
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for e in edges if e[0] != e[1] for x in e}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "loops"])
def test_components(spark, kind):
    rng = random.Random(3)
    if kind == "random":
        edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    elif kind == "chain":
        names = rng.sample(range(1000), 120)
        edges = list(zip(names, names[1:])) + [(2000, 2001), (2001, 2000)]
    elif kind == "star":
        edges = [(500, k) for k in range(100)] + [(600, 700)]
    else:
        edges = [(5, 5), (6, 6)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    want = brute(edges)
    assert {r["node"]: r["label"] for r in got.collect()} == want
    again = components(stars(got)) if want else got
    assert {r["node"]: r["label"] for r in again.collect()} == want


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []
