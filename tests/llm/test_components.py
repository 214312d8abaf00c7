import random

import pytest

from formline.llm.components import component_roots


def brute(edges):
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {(x, root(x)) for x in parent if root(x) != x}


@pytest.mark.parametrize("kind", ["path", "star", "random", "none", "loops"])
def test_roots(spark, kind):
    rnd = random.Random(4)
    edges = {
        "path": [(i, i + 1) for i in rnd.sample(range(40), 40)],
        "star": [(0, i) for i in range(1, 60)] + [(7, 99)],
        "random": [(rnd.randrange(-90, 90), rnd.randrange(-90, 90)) for _ in range(80)],
        "none": [],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[kind]
    got = component_roots(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute([e for e in edges if e[0] != e[1]])
