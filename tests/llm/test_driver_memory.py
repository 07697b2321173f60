"""What the pipeline's near-dedup asks of the driver: memory given back, and no more rounds than the links need."""

import random

from corvidex.llm import _graph
from corvidex.llm._spark import give_back_driver_memory


def test_the_driver_gives_back_native_memory(spark):
    assert give_back_driver_memory(spark)


def test_components_end_with_stars_and_stars_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(_graph, "stored", lambda df, tag, own=_graph.stored: written.append(tag) or own(df, tag))
    found = lambda edges: {r["node"]: r["root"] for r in _graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found([(5, 1), (1, 7), (7, 1), (3, 3), (2, 9)]) == {5: 1, 7: 1, 9: 2}
    assert len(written) == 1
    assert found([]) == {}
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(draw.randrange(300, 400), draw.randrange(300, 400)) for _ in range(60)] + [(draw.randrange(-50, 0), -50) for _ in range(30)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert found(edges) == {n: r for n, r in root.items() if n != r}
