import random

from tabspark.llm.components import connected_components


def plain(edges):
    label = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            if a in label and b in label and None not in (a, b) and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                moved = True
    return label


def test_components_of_chains_hubs_and_noise(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (None, 3)]
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(90)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == plain(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0
