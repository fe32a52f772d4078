"""Best partner of every record without a pair list.

Records that share a key and a profile (the attributes that a score looks at)
score alike against everybody else. So scores are stated per *holder* (a key
with one of its profiles) and *cell* (a set of records): an entry (holder, cell,
total, label) says that every record of the holder reaches at least that total
with every other record of the cell, and for the best pairs entries are exact.

Per cell only the two smallest records are kept, per holder the two best
candidates with different records: a record takes the first that is not itself
(a leave-one-out maximum). Rows grow with holders and entries; a key that holds
a third of all records is two rows of one aggregate. Records with banned
partners look at the ``k`` smallest of the cells their own entries name, k being
the most bans of a record plus two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aurum.session import written


def k_smallest(members: DataFrame, key: str, k: int) -> DataFrame:
    """(key, node, rank): the k smallest nodes of each key.

    The rank limit cuts every partition to k rows a key before the shuffle, so
    no task meets a whole hot key.
    """
    w = Window.partitionBy(key).orderBy("node")
    return members.select(key, "node").distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def two_smallest(members: DataFrame, key: str = "gid") -> DataFrame:
    """(key, min1, min2): the two smallest distinct nodes of each key (min2 null if there is one)."""
    return k_smallest(members, key, 2).groupBy(key).agg(
        F.min("node").alias("min1"), F.max(F.when(F.col("rank") == 2, F.col("node"))).alias("min2"))


def _order(total: Column, label: Column, other: Column) -> Column:
    """Smallest = best: high total, then small label, then small node."""
    return F.struct((-total).alias("t"), label.alias("l"), other.alias("o"))


def _result(df: DataFrame) -> DataFrame:
    return df.select("node", F.col("b.o").alias("other"), (-F.col("b.t")).alias("total"), F.col("b.l").alias("label"))


def best_partners(members: DataFrame, holders: DataFrame, entries: DataFrame) -> DataFrame:
    """(node, other, total, label): the best partner of every node that has one.

    ``members``: (cell, node); ``holders``: (holder, node); ``entries``:
    (holder, cell, total, label). Ties go to the smaller label, then node.
    """
    ends = written(two_smallest(members, "cell"))
    # cells and holders meet written tables, so a hot one of either can be split
    found = entries.join(ends, "cell").select("holder", "total", "label", F.explode(F.array("min1", "min2")).alias("other")).where(F.col("other").isNotNull())
    ranked = written(found.select("holder", _order(F.col("total"), F.col("label"), F.col("other")).alias("c")))
    first = ranked.groupBy("holder").agg(F.min("c").alias("c1"))
    second = ranked.join(first, "holder").where(F.col("c.o") != F.col("c1.o")).groupBy("holder").agg(F.min("c").alias("c2"))
    best = written(first.join(second, "holder", "left"))
    own = F.when(F.col("c1.o") != F.col("node"), F.col("c1")).otherwise(F.col("c2"))
    return _result(holders.join(best, "holder").select("node", own.alias("c")).where(F.col("c").isNotNull()).groupBy("node").agg(F.min("c").alias("b")))


def best_allowed(members: DataFrame, holders: DataFrame, entries: DataFrame, banned: DataFrame, k: int) -> DataFrame:
    """As :func:`best_partners` for the nodes of ``holders``, without the pairs of ``banned`` (node, other).

    ``k`` is the most bans of a node plus two, so a cell's k smallest nodes hold
    an allowed one if the cell does.
    """
    asked = written(holders.join(entries, "holder").select("node", "cell", "total", "label").distinct())
    near = k_smallest(members.join(asked.select("cell").distinct(), "cell", "left_semi"), "cell", k).withColumnRenamed("node", "other").drop("rank")
    pairs = asked.join(near, "cell").where(F.col("node") != F.col("other")).join(banned, ["node", "other"], "left_anti")
    return _result(pairs.groupBy("node").agg(F.min(_order(F.col("total"), F.col("label"), F.col("other"))).alias("b")))
