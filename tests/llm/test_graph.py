import random

from tarmac.llm.graph import components


def test_chains_stars_and_loops(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(400, 450)] + [(7, 7), (None, 3)]
    edges += [(draw.randrange(1000, 1400), draw.randrange(1000, 1400)) for _ in range(200)]
    edges += [(b, a) for a, b in edges[:30]]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    while True:
        changed = False
        for a, b in edges:
            if a in label and b in label and a != b:
                low = min(label[a], label[b])
                changed |= label[a] != low or label[b] != low
                label[a] = label[b] = low
        if not changed:
            break
    assert got == label


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
