import numpy as np
import pytest

from tidegauge.operators import graph

# Fixed example: eleven nodes, node 1 dangling, nodes 5 and node 6 with multiple links.
LINES = ["2\t{'3': 1}", "3\t{'2': 1}", "4\t{'1': 1, '2': 1}", "5\t{'4': 3, '2': 1, '6': 1}", "6\t{'2': 1, '5': 2}",
         "7\t{'2': 1, '5': 1}", "8\t{'2': 1, '5': 1}", "9\t{'2': 1, '5': 1}", "10\t{'5': 1}", "11\t{'5': 1}"]
RANKS = {2: 0.3620640495978871, 3: 0.333992700474142, 5: 0.08506399429624555, 4: 0.06030963508473455, 1: 0.04255740809817991,
         6: 0.03138662354831139, 8: 0.01692511778009981, 10: 0.01692511778009981, 7: 0.01692511778009981, 9: 0.01692511778009981,
         11: 0.01692511778009981}


@pytest.fixture(scope="module")
def edges(spark):
    return graph.parse_adjacency(spark.createDataFrame([(x,) for x in LINES], "value string"))


def test_parse(edges):
    assert edges.count() == 17
    assert edges.filter("src = 5 and dst = 4").first().mult == 3


def test_parse_node_without_links(spark):
    assert graph.parse_adjacency(spark.createDataFrame([("1\t{}",)], "value string")).count() == 0


def test_counts(edges):
    assert tuple(graph.node_counts(edges).first()) == (11, 10, 1)
    assert [r.id for r in graph.dangling_nodes(edges).collect()] == [1]
    assert {r.id: r.out_degree for r in graph.out_degrees(edges).collect()}[5] == 5
    assert {round(r["rank"], 12) for r in graph.init_graph(edges).collect()} == {round(1 / 11, 12)}


def test_known_ranks(edges):
    got = {r.id: r["rank"] for r in graph.pagerank(edges, 0.15, 20).collect()}
    assert sum(got.values()) == pytest.approx(1)
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in RANKS.items()}


@pytest.mark.parametrize("weighted", [True, False])
@pytest.mark.parametrize("per_salt", [1, 1_000_000])
def test_against_matrix(spark, monkeypatch, weighted, per_salt):
    """Dangling, destination-only and self-linked nodes; with and without splitting hubs."""
    monkeypatch.setattr(graph, "EDGES_PER_SALT", per_salt)
    rows = [(1, 2, 1), (1, 3, 4), (2, 2, 1), (2, 4, 2), (3, 1, 1)]
    got = {r.id: r["rank"] for r in graph.pagerank(spark.createDataFrame(rows, "src long, dst long, mult int"), 0.2, 7, weighted).collect()}
    m = np.zeros((4, 4))
    for s, d, w in rows:
        m[s - 1, d - 1] = w if weighted else 1
    out = m.sum(1, keepdims=True)
    p = np.divide(m, out, out=np.zeros_like(m), where=out > 0)
    x = np.full(4, 0.25)
    for _ in range(7):
        x = 0.2 / 4 + 0.8 * (x @ p + x[out[:, 0] == 0].sum() / 4)
    assert [got[i + 1] for i in range(4)] == pytest.approx(list(x))


def test_hubs(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 11)], "id int, rank double")
    assert {r.id for r in graph.hub_flags(df).collect() if r.is_hub} == {9, 10}


def test_empty_graph(spark):
    empty = spark.createDataFrame([], "src long, dst long, mult int")
    assert graph.node_counts(empty).first().n_nodes == 0
    assert graph.pagerank(empty, 0.15, 2).count() == 0
