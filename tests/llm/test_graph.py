import random

from govlake.llm import graph


def expected(edges):
    label = {v: v for e in edges for v in e if e[0] != e[1]}
    again = True
    while again:
        again = False
        for a, b in edges:
            if a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                again = True
    return label


def test_components(spark):
    rnd = random.Random(4)
    path = list(range(1000, 1200))
    shuffled = rnd.sample(range(2000, 2200), 200)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(150)]
    edges += list(zip(path, path[1:])) + list(zip(shuffled, shuffled[1:])) + [(5000, 5000 + i) for i in range(300)] + [(7, 7), (9000, 9000)]
    got = {r.id: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == expected(edges)


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0
