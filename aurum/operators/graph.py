"""Match graphs without all-pairs: key groups, one-hop labels, connected components.

A match relation that is an equality of a key (same national id, same
phone digits, same e-mail, same canonical name ...) is a clique on the rows
sharing the key. Such a group is never expanded into its pairs: the one-hop
label of a node is the minimum of each of its groups, and for connected
components a star (every member -> group minimum) carries the same
connectivity in O(members) edges. A group holding a third of all rows is
therefore one aggregation (partially combined map-side) and one star, not a
quadratic pair list.

Connected components use the alternating large-star / small-star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014),
cutting lineage with a reliable ``checkpoint()`` every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aurum.operators.partners import two_smallest
from aurum.session import written


def group_minima(members: DataFrame) -> DataFrame:
    """members(gid, node) -> (gid, min1, min2): the two smallest distinct nodes, written so that joins with it can be split."""
    return written(two_smallest(members))


def star_edges(members: DataFrame) -> DataFrame:
    """Star edges (node, group minimum) for every non-minimum member."""
    m = members.select("gid", "node").distinct()
    # a written table on the other side lets AQE split the join where one group is hot
    mins = written(m.groupBy("gid").agg(F.min("node").alias("root")))
    return m.join(mins, "gid").where(F.col("node") != F.col("root")).select(F.col("node").alias("src"), F.col("root").alias("dst"))


def _undirected(e: DataFrame) -> DataFrame:
    return e.select("src", "dst").unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) \
        .where(F.col("src") != F.col("dst")).distinct()


def _large_star(e: DataFrame) -> DataFrame:
    u = _undirected(e)
    u = written(u)
    m = written(u.groupBy("src").agg(F.min("dst").alias("m")).withColumn("m", F.least("m", "src")))
    return u.join(m, "src").where(F.col("dst") > F.col("src")) \
        .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    # orient every edge high -> low, star each node's lower neighbourhood on its minimum
    o = e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where(F.col("src") != F.col("dst")).distinct()
    o = written(o)
    m = written(o.groupBy("src").agg(F.min("dst").alias("m")))
    spokes = o.join(m, "src").where(F.col("dst") != F.col("m")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    hub = m.select("src", F.col("m").alias("dst"))
    return spokes.unionByName(hub).distinct()


def _is_star_forest(e: DataFrame) -> bool:
    """Converged when every edge points high -> low to a root: each source has
    one target and no target is itself a source (one job, two aggregations)."""
    multi = e.groupBy("src").agg(F.count("*").alias("n")).where(F.col("n") > 1).select(F.lit(1).alias("x"))
    chained = e.select(F.col("dst").alias("src")).distinct().join(e.select("src").distinct(), "src").select(F.lit(1).alias("x"))
    return multi.unionByName(chained).limit(1).count() == 0


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """nodes(node), edges(src, dst) -> (node, component = smallest node of its component)."""
    e = edges.select("src", "dst").where(F.col("src") != F.col("dst"))
    e = written(e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    for _ in range(max_rounds):
        if _is_star_forest(e):
            break
        e = written(_small_star(_large_star(e)))
    # converged: every edge is (member, root)
    lab = e.groupBy("src").agg(F.min("dst").alias("component")).withColumnRenamed("src", "node")
    return nodes.select("node").distinct().join(lab, "node", "left") \
        .select("node", F.least(F.coalesce("component", "node"), F.col("node")).alias("component"))


def dense_number(df: DataFrame, order_cols: list[str], partition_cols: list[str] | None = None,
                 out: str = "n", buckets: int | None = None) -> DataFrame:
    """Dense rank over (partition_cols, order_cols) without a single-task sort.

    Distinct keys are range-partitioned, counted per partition, and every
    partition numbers its keys from the running total of the partitions
    before it. Only the per-partition counts (one row per partition) meet in
    one place.
    """
    keys = df.select(*(partition_cols or []), *order_cols).distinct()
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rp = keys.repartitionByRange(n, *(partition_cols or []), *order_cols).withColumn("_pid", F.spark_partition_id())
    rp = written(rp)
    counts = rp.groupBy(*(partition_cols or []), "_pid").agg(F.count("*").alias("_cnt"))
    wc = Window.partitionBy(*(partition_cols or [])).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(wc), F.lit(0)))
    wl = Window.partitionBy(*(partition_cols or []), "_pid").orderBy(*order_cols)
    numbered = rp.join(F.broadcast(offs.select(*(partition_cols or []), "_pid", "_off")), [*(partition_cols or []), "_pid"]) \
        .withColumn(out, (F.row_number().over(wl) + F.col("_off")).cast("long")).drop("_pid", "_off")
    return df.join(numbered.hint("merge"), [*(partition_cols or []), *order_cols])
