import random

from tidemart.llm import common


def test_components_of_chains_stars_and_random_edges(spark, monkeypatch):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)]
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(90)] + [(-5, 7000), (7000, 7000), (8, 7)]
    forest = common.Forest()
    for a, b in edges:
        forest.join(a, b)
    wanted = {n: forest.root(n) for e in edges if e[0] != e[1] for n in e}
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    for block in (common.BLOCK_EDGES, 40):
        monkeypatch.setattr(common, "BLOCK_EDGES", block)
        rows = common.components(frame).collect()
        assert {r.node: r.component for r in rows} == wanted and len(rows) == len(wanted)
    assert common.components(frame.limit(0)).count() == 0
