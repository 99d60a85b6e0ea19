import random

from tabloom.llm.components import components, joined_classes


def test_components_of_many_shapes(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(300)]  # a path
    edges += [(1000, i) for i in range(1001, 1400)]  # a star
    edges += [(2000 + draw.randrange(60), 2000 + draw.randrange(60)) for _ in range(70)]
    edges += [(5, 5), (3001, 3000), (3000, 3001)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    found = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_further_edges_join_classes(spark):
    table = lambda edges: spark.createDataFrame(edges, "a long, b long")
    first = [(1, 2), (3, 4), (5, 6), (9, 8)]
    # Two classes joined by other vertices than their smallest, an edge inside a class, new vertices with and without a class.
    further = [(4, 2), (6, 5), (20, 21), (0, 9)]
    classes = components(table(first))
    for more in (further, []):
        found = {r.vertex: r.component for r in joined_classes(classes, table(more)).collect()}
        assert found == {r.vertex: r.component for r in components(table(first + more)).collect()}
