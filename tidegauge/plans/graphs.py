"""Graphs from order lines: supplier to part, and nation to nation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph, ranking
from ..operators.skew import attach
from ..session import cut_lineage
from .enrichment import route_rows
from .registry import Tables, query

EDGES_SQL = "edges AS (SELECT l_suppkey AS src, l_partkey AS dst, count(*) AS mult FROM lineitem GROUP BY ALL)"
NODES_SQL = "nodes AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges)"


def edges(t: Tables) -> DataFrame:
    """Supplier and part numbers share one id space, so some nodes are both and many are dangling."""
    return graph.weighted_edges(t.lineitem, "l_suppkey", "l_partkey")


def rank_sql(source: str, rounds: int, alpha: float = 0.15, weighted: bool = True) -> str:
    """The rounds written out one after another; ``source`` defines edges(src, dst, mult)."""
    w = "mult" if weighted else "1.0"
    steps = [f"""{source}, {NODES_SQL}, n AS (SELECT count(*) AS n FROM nodes),
     link AS MATERIALIZED (SELECT src, dst, {w} * 1.0 / sum({w}) OVER (PARTITION BY src) AS p FROM edges),
     r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / n AS rank FROM nodes, n)"""]
    for i in range(rounds):
        steps.append(f"""r{i + 1} AS MATERIALIZED (SELECT r.id, {alpha} / n + {1 - alpha} * (coalesce(inc, 0) + dm / n) AS rank
       FROM r{i} r CROSS JOIN n CROSS JOIN (SELECT coalesce(sum(rank), 0) AS dm FROM r{i} WHERE id NOT IN (SELECT src FROM link)) d
       LEFT JOIN (SELECT dst, sum(rank * p) AS inc FROM r{i} JOIN link ON src = id GROUP BY dst) s ON s.dst = r.id)""")
    return ",\n     ".join(steps)


@query("g1_parse_adjacency", f"WITH {EDGES_SQL} SELECT src, dst, CAST(mult AS INTEGER) AS mult FROM edges")
def g1_parse_adjacency(t: Tables) -> DataFrame:
    """Edges written as adjacency lines of bounded length and parsed back."""
    e = edges(t)
    entry = F.concat(F.lit("'"), F.col("dst").cast("string"), F.lit("': "), F.col("mult").cast("string"))
    chunk = F.floor(F.col("dst") / 100)  # at most 100 links per line, so a hub has many lines
    lines = e.groupBy("src", chunk).agg(F.array_join(F.collect_list(entry), ", ").alias("links")).select(
        F.concat(F.col("src").cast("string"), F.lit("\t{"), F.col("links"), F.lit("}")).alias("value"))
    return graph.parse_adjacency(lines)


@query("g2_node_counts", f"""WITH {EDGES_SQL}, {NODES_SQL}
SELECT count(*) AS n_nodes, count(*) FILTER (id IN (SELECT src FROM edges)) AS n_sources, count(*) FILTER (id NOT IN (SELECT src FROM edges)) AS n_dangling FROM nodes""")
def g2_node_counts(t: Tables) -> DataFrame:
    return graph.node_counts(edges(t))


@query("g3_dangling_nodes", f"WITH {EDGES_SQL}, {NODES_SQL} SELECT id FROM nodes WHERE id NOT IN (SELECT src FROM edges)")
def g3_dangling_nodes(t: Tables) -> DataFrame:
    return graph.dangling_nodes(edges(t))


DEGREE_SQL = f"{EDGES_SQL}, {NODES_SQL}, degree AS (SELECT id, CAST(coalesce(sum(mult), 0) AS BIGINT) AS out_degree FROM nodes LEFT JOIN edges ON src = id GROUP BY id)"


@query("g4_out_degree", f"WITH {DEGREE_SQL} SELECT id, out_degree FROM degree")
def g4_out_degree(t: Tables) -> DataFrame:
    return graph.out_degrees(edges(t))


@query("g4_top_out_degree", f"WITH {DEGREE_SQL} SELECT id, out_degree, round(avg(out_degree) OVER (), 9) AS mean_degree FROM degree ORDER BY out_degree DESC, id LIMIT 10")
def g4_top_out_degree(t: Tables) -> DataFrame:
    degrees = graph.out_degrees(edges(t))
    mean = degrees.agg(F.round(F.avg("out_degree"), 9).alias("m")).scalar()
    return ranking.top_n(degrees, "out_degree", 10, "id").withColumn("mean_degree", mean)


@query("g5_init_graph", f"WITH {DEGREE_SQL} SELECT id, round(1.0 / (SELECT count(*) FROM nodes), 12) AS rank, out_degree FROM degree")
def g5_init_graph(t: Tables) -> DataFrame:
    return graph.init_graph(edges(t)).withColumn("rank", F.round("rank", 12))


@query("j12_rank_edge_step", f"""
WITH {EDGES_SQL}, {NODES_SQL}, total AS (SELECT src, sum(mult) AS t FROM edges GROUP BY src), n AS (SELECT count(*) AS n FROM nodes)
SELECT dst AS id, round(sum(1.0 / n * mult / t), 12) AS received FROM edges JOIN total USING (src), n GROUP BY dst""")
def j12_rank_edge_step(t: Tables) -> DataFrame:
    """One message step: rank joined to links, contributions added by destination."""
    e = edges(t)
    ranks = graph.init_graph(e).select(F.col("id").alias("src"), "rank", "out_degree")
    sent = attach(e, ranks, ["src"]).select("dst", (F.col("rank") * F.col("mult") / F.col("out_degree")).alias("part"))
    return sent.groupBy(F.col("dst").alias("id")).agg(F.round(F.sum("part"), 12).alias("received"))


@query("g6_pagerank", f"WITH {rank_sql(EDGES_SQL, 10)} SELECT id, round(rank, 12) AS rank FROM r10")
def g6_pagerank(t: Tables) -> DataFrame:
    return graph.pagerank(edges(t), 0.15, 10).withColumn("rank", F.round("rank", 12))


ROUTES_SQL = """edges AS (SELECT s_nationkey AS src, c_nationkey AS dst, count(*) AS mult FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
     JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY ALL)"""


def routes(t: Tables) -> DataFrame:
    return graph.weighted_edges(route_rows(t), "s_nationkey", "c_nationkey")


@query("g7_rank_on_facts", f"""WITH {rank_sql(ROUTES_SQL, 5)}
SELECT l_orderkey, l_linenumber, s_nationkey, c_nationkey, round(a.rank, 12) AS source_rank, round(b.rank, 12) AS target_rank
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
LEFT JOIN r5 a ON a.id = s_nationkey LEFT JOIN r5 b ON b.id = c_nationkey""")
def g7_rank_on_facts(t: Tables) -> DataFrame:
    """Ranks of both ends of a route in the trade graph, attached to every line."""
    ranks = cut_lineage(graph.pagerank(routes(t), 0.15, 5).select("id", F.round("rank", 12).alias("rank")))
    out = route_rows(t).select("l_orderkey", "l_linenumber", "s_nationkey", "c_nationkey")
    for key, name in (("s_nationkey", "source_rank"), ("c_nationkey", "target_rank")):
        out = attach(out, ranks.withColumnsRenamed({"id": key, "rank": name}), [key])
    return out


@query("g8_hub_flag", f"""WITH {rank_sql(ROUTES_SQL, 5)}
SELECT id, round(rank, 12) AS rank, CASE WHEN round(rank, 12) >= (SELECT quantile_disc(round(rank, 12), 0.9) FROM r5) THEN 1 ELSE 0 END AS is_hub FROM r5""")
def g8_hub_flag(t: Tables) -> DataFrame:
    return graph.hub_flags(graph.pagerank(routes(t), 0.15, 5).withColumn("rank", F.round("rank", 12)))


@query("g9_route_edges", f"WITH {ROUTES_SQL} SELECT src, dst, mult FROM edges")
def g9_route_edges(t: Tables) -> DataFrame:
    return routes(t)
