import random

import pytest

from publicspend.llm.components import components


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(40)]  # a chain
    links += [(100, 200 + i) for i in range(30)] + [(300 + i, 399) for i in range(30)]  # stars
    links += [(400 + rng.randrange(60), 400 + rng.randrange(60)) for _ in range(45)]
    names = list(range(500))
    rng.shuffle(names)
    links = [(names[a], names[b]) for a, b in links]
    above = {}

    def root(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in links:
        if a != b:
            above[root(a)] = root(b)
    rows = components(spark.createDataFrame(links, "a int, b int")).collect()
    groups, expected = {}, {}
    for node, label in rows:
        groups.setdefault(label, set()).add(node)
    for node in above:
        expected.setdefault(root(node), set()).add(node)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    assert all(label in group for label, group in groups.items())
    assert len(rows) == len(above)
