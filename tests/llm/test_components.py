import random

from layerwright.llm.components import components


def test_components_of_random_and_long_graphs(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)]
    edges += [(1000 + i, 1001 + i) for i in range(70)]  # a path
    edges += [(3000, 3001 + i) for i in range(200)]  # a star
    edges += [(5, 5), edges[0], edges[0][::-1], (None, 3), (4, None)]
    root = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    for a, b in edges:
        if a in root and b in root and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if v == high else v for k, v in root.items()}
    out = components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert len(out) == len(root) and {r.node: r.component for r in out} == root


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "src long, dst long")).collect() == []
