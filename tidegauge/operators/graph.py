"""Edge tables, degrees and PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.numeric import ratio
from ..session import cut_lineage
from .quantiles import exact_quantiles
from .sets import all_ids
from .skew import attach

EDGES_PER_SALT = 1_000_000


def parse_adjacency(lines: DataFrame, line: str = "value") -> DataFrame:
    """``node <tab> {dst: count}`` text to (src, dst, mult); nodes without links give no row."""
    parts = F.split(F.col(line), "\t", 2)
    links = F.from_json(parts.getItem(1), "map<string,int>", {"allowSingleQuotes": "true"})
    return lines.select(parts.getItem(0).cast("long").alias("src"), F.explode(links).alias("_d", "mult")).select(
        "src", F.col("_d").cast("long").alias("dst"), "mult")


def weighted_edges(df: DataFrame, src: str, dst: str) -> DataFrame:
    """One edge per pair with the number of rows behind it."""
    return df.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(F.count(F.lit(1)).alias("mult"))


def vertices(edges: DataFrame) -> DataFrame:
    return all_ids(edges, "src", "dst")


def node_counts(edges: DataFrame) -> DataFrame:
    """Nodes, nodes with links and dangling nodes from one grouping."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("out")), F.struct(F.col("dst").alias("id"), F.lit(0).alias("out")))))
    per_node = ends.groupBy("id").agg(F.max("out").alias("out"))
    return per_node.agg(F.count(F.lit(1)).alias("n_nodes"), F.sum("out").alias("n_sources"),
                        F.sum(1 - F.col("out")).alias("n_dangling"))


def dangling_nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("id")).distinct().join(
        edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti")


def out_degrees(edges: DataFrame) -> DataFrame:
    """Links per node counted with multiplicity; dangling nodes have 0."""
    rows = edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.col("mult").cast("long").alias("m")),
        F.struct(F.col("dst").alias("id"), F.lit(0).cast("long").alias("m")))))
    return rows.groupBy("id").agg(F.sum("m").alias("out_degree"))


def init_graph(edges: DataFrame) -> DataFrame:
    """Every node with rank 1/N and its link weight (0 when dangling)."""
    degrees = out_degrees(edges)
    n = vertices(edges).agg(F.count(F.lit(1)).alias("n")).scalar()
    return degrees.select("id", ratio(F.lit(1.0), n).alias("rank"), "out_degree")


def pagerank(edges: DataFrame, alpha: float = 0.15, rounds: int = 10, weighted: bool = True) -> DataFrame:
    """Ranks that sum to 1 after a fixed number of rounds: (id, rank).

    ``alpha`` is the teleport share; the rank of dangling nodes is spread over all nodes.
    Edges are laid out once by (source, salt), with one salt per million links of the
    source, so a hub is spread over several tasks. Each round shuffles only ranks and
    combined contributions, and its result is written to the checkpoint folder.
    """
    weight = F.col("mult").cast("double") if weighted else F.lit(1.0)
    plain = edges.select("src", "dst", weight.alias("w"))
    out = plain.groupBy("src").agg(F.sum("w").alias("_t"), F.count(F.lit(1)).alias("_n"))
    salts = F.ceil(F.col("_n") / F.lit(EDGES_PER_SALT)).cast("int")
    nodes = cut_lineage(vertices(edges).join(out.select(F.col("src").alias("id"), salts.alias("salts")), "id", "left"))
    n = nodes.count()
    if n == 0:
        return nodes.select("id", F.lit(0.0).alias("rank"))
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = (
        attach(plain, out, ["src"])
        .select("src", F.pmod(F.xxhash64("dst"), salts.cast("long")).cast("int").alias("salt"), "dst",
                (F.col("w") / F.col("_t")).alias("p"))
        .repartition(parts, "src", "salt").persist(StorageLevel.MEMORY_AND_DISK)
    )
    ranks = nodes.withColumn("rank", F.lit(1.0 / n))
    for _ in range(rounds):
        dangling = ranks.agg(F.sum(F.when(F.col("salts").isNull(), F.col("rank")))).first()[0] or 0.0
        sent = (
            ranks.filter(F.col("salts").isNotNull())
            .select(F.col("id").alias("src"), "rank", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
            .join(links, ["src", "salt"])
            .groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("p")).alias("inc"))
        )
        kept = ranks.select("id", "salts").join(sent, "id", "left")
        new = F.lit(alpha / n) + F.lit(1 - alpha) * (F.coalesce("inc", F.lit(0.0)) + F.lit(dangling / n))
        ranks = cut_lineage(kept.select("id", "salts", new.alias("rank")))
    links.unpersist()
    return ranks.select("id", "rank")


def hub_flags(ranks: DataFrame, quantile: float = 0.9) -> DataFrame:
    """Nodes at or above the given quantile of rank."""
    limit = exact_quantiles(ranks, {"limit": ("rank", quantile)})["limit"]
    return ranks.withColumn("is_hub", (F.col("rank") >= F.lit(limit)).cast("int"))
