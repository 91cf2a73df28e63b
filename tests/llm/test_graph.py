import numpy as np

from harvestline.llm import graph


def test_components_of_a_chain_a_star_and_a_ring(spark):
    chain = [(i, i + 1) for i in range(100, 130)]
    star = [(50, i) for i in range(1000, 1200)]
    ring = [(7, 9), (9, 8), (8, 7), (7, 7), (9, 7)]
    void = [(None, 3), (4, None)]
    edges = spark.createDataFrame(chain + star + ring + void, "a long, b long")
    found = {r.node: r.component for r in graph.components(edges).collect()}
    want = {i: 100 for i in range(101, 131)} | {i: 50 for i in range(1000, 1200)} | {8: 7, 9: 7}
    assert found == want


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_keeps_what_is_linked():
    forest = graph.Forest(6)
    forest.link(np.array([4, 2]), np.array([2, 0]))
    forest.link(np.array([5]), np.array([3]))
    assert forest.label.tolist() == [0, 1, 0, 3, 0, 3]
    node, root = forest.edges()
    assert sorted(zip(node.tolist(), root.tolist(), strict=True)) == [(2, 0), (4, 0), (5, 3)]
